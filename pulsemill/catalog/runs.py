"""Queries that go through whole runs: failed sets and their cascade, replays, the stream, own stages.

Blocks of events stand for users. The files of a block form the set of a day of its own.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill import fields as fl
from pulsemill.catalog.base import PACKED_EVENTS_SQL, Tables, millis, packed_events, query
from pulsemill.functions.names import activity_file_name, standard_file_name
from pulsemill.operators import wellness
from pulsemill.operators.documents import ORIGIN, Decoded
from pulsemill.plans.run import DECODERS, RunConfig, run_batch
from pulsemill.session import scratch_path
from pulsemill.sources import mailbox
from pulsemill.sources.store import Store
from pulsemill.streaming.mailbox import stream_mailbox as drain_mailbox

# Events of one file; event ids are unique, so this bounds a document.
BLOCK = 256
DAY_ONE = "2024-01-01"
STARTED = "2026-01-01 00:00:00"


def _config(run: str, **stages) -> RunConfig:
    return RunConfig("wearables", run, STARTED, **stages)


def _store(t: Tables) -> Store:
    return Store(t.spark, scratch_path(t.spark, "store"))


def _raw(rows: DataFrame, name: Column, content: Column, length: Column | None = None) -> DataFrame:
    return rows.select(
        name.alias("file_name"),
        F.concat(F.lit("/in/"), name).alias("path"),
        F.lit(STARTED).cast("timestamp").alias("mtime"),
        (F.length(content) if length is None else length).cast("bigint").alias("length"),
        content.alias("content"),
    )


def event_sets(t: Tables) -> DataFrame:
    """Raw files. Every block has readings; some have a broken reading (block % 5 = 1) or a file nobody
    knows (% 7 = 2), which fails their set; some list an activity (% 3 = 0), whose own file comes a day
    later in the set of the next block, which fails if the list did."""
    block, day = F.col("block"), F.date_add(F.lit(DAY_ONE).cast("date"), F.col("block").cast("int"))
    pair = F.array(millis("ts"), F.floor("value").cast("bigint"))
    blocks = t.events.groupBy(F.floor(F.col("event_id") / BLOCK).cast("bigint").alias("block")).agg(
        F.array_sort(F.collect_list(pair)).alias("heartRateValues")
    )
    broken = F.concat("heartRateValues", F.array(F.array(F.lit(1).cast("bigint"))))
    readings = F.struct(F.when(block % 5 == 1, broken).otherwise(F.col("heartRateValues")).alias("heartRateValues"))
    item = F.struct(
        block.alias("activityId"),
        F.struct(F.lit(1).alias("typeId"), F.lit("walking").alias("typeKey")).alias("activityType"),
        F.struct(F.lit(9).alias("typeId"), F.lit("other").alias("typeKey")).alias("eventType"),
        F.lit("2024-01-01 06:00:00").alias("startTimeGMT"),
        F.lit("2024-01-01T08:00:00.0").alias("startTimeLocal"),
        F.lit("2024-01-01 07:00:00").alias("endTimeGMT"),
        F.lit(3600.5).alias("duration"),
        *[F.lit(False).alias(f.json) for f in fl.ACTIVITY_REQUIRED],
    )
    parts = [
        _raw(blocks, standard_file_name(block, "HEART_RATE", day), F.to_json(readings)),
        _raw(blocks.filter(block % 7 == 2), standard_file_name(block, "BATTERY", day), F.lit("{}")),
        _raw(blocks.filter(block % 3 == 0), standard_file_name(block, "ACTIVITIES_LIST", day), F.to_json(F.array(item))),
        _raw(blocks.filter(block % 3 == 0), activity_file_name(block + 1, block, F.date_add(day, 1)), F.lit("")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


_NAME = "'_' || strftime(cast(date '2024-01-01' + cast({b} as integer) as timestamp), '%Y-%m-%d') || 'T12:00:00Z'"
_SETS_SQL = f"""
blocks as (select distinct event_id // {BLOCK} as b from events),
files as (
  select b, b || '_HEART_RATE' || {_NAME.format(b="b")} || '.json' as file_name from blocks
  union all select b, b || '_BATTERY' || {_NAME.format(b="b")} || '.json' from blocks where b % 7 = 2
  union all select b, b || '_ACTIVITIES_LIST' || {_NAME.format(b="b")} || '.json' from blocks where b % 3 = 0
  union all select b + 1, (b + 1) || '_ACTIVITY_' || b || {_NAME.format(b="b + 1")} || '.fit' from blocks where b % 3 = 0
),
rules as (
  select b, case when b % 5 = 1 and b in (select b from blocks) then 'bad heart rate reading'
    when b % 3 = 1 and ((b - 1) % 7 = 2 or (b - 1) % 5 = 1) then 'activity not found'
    when b % 7 = 2 and b in (select b from blocks) then 'no file type matches' end as error_type
  from (select distinct b from files)
)
"""


@query(f"""
with {_SETS_SQL}, readings as (
  select event_id // {BLOCK} as b, count(distinct epoch_us(ts) // 1000) as n from events group by all
)
select f.file_name, case when error_type is null then 'store' else 'quarantine' end as state,
  error_type is null as success, error_type,
  case when error_type is null and f.file_name like '%HEART_RATE%' then r.n end as n_rows
from files f join rules using (b) left join readings r using (b)
""")
def run_file_sets(t: Tables) -> DataFrame:
    """One run over all files: the outcome of each, and how many readings it has stored."""
    store = _store(t)
    outcome = run_batch(t.spark, event_sets(t), store, _config("run"))
    owner = F.regexp_extract("file_name", r"^(\d+)_HEART_RATE_", 1).try_cast("bigint")
    stored = store.read("heart_rate").groupBy(F.col("user_id").alias("owner")).agg(F.count(F.lit(1)).alias("n_rows"))
    return outcome.withColumn("owner", owner).join(stored, "owner", "left").drop("owner")


@query(f"""
with {_SETS_SQL}, good as (select b from rules where error_type is null),
readings as (select distinct event_id // {BLOCK} as b, epoch_us(ts) // 1000 as ms from events)
select 'heart_rate' as table_name, count(*) as n_rows, true as unchanged from readings where b in (select b from good)
union all select 'activity', count(*), true from good where b % 3 = 0 and b in (select b from blocks)
union all select 'user', count(*), true from good
union all select 'etl_result', count(*), true from files
""")
def idempotent_replay(t: Tables) -> DataFrame:
    """The same run twice: rows of every table, and whether its digest is the same after the second."""
    store, raw = _store(t), event_sets(t)
    states = []
    for turn in range(2):
        run_batch(t.spark, raw, store, _config("replayed"))
        path = scratch_path(t.spark, "digest")
        store.state_digest().write.parquet(path)
        states.append(t.spark.read.parquet(path).withColumn("turn", F.lit(turn)))
    both = states[0].unionByName(states[1]).groupBy("table_name", "chunk").agg(
        F.max_by("n_rows", "turn").alias("n_rows"),
        ((F.count(F.lit(1)) == 2) & (F.count_distinct("digest", "n_rows") == 1)).alias("unchanged"),
    )
    table = both.groupBy("table_name").agg(F.sum("n_rows").alias("n_rows"), F.bool_and("unchanged").alias("unchanged"))
    return table.filter("n_rows > 0")


@query(f"with rows as ({PACKED_EVENTS_SQL}) select user_id, ts_ms, min(value) as value from rows group by all")
def stream_mailbox(t: Tables) -> DataFrame:
    """The mailbox in micro-batches that cut sets anywhere; equal times of a user keep the first reading."""
    folder, store = scratch_path(t.spark, "mailbox"), _store(t)
    mailbox.land_documents(packed_events(t), folder)
    drain_mailbox(t.spark, folder, store, scratch_path(t.spark, "taken"), _config("stream"), files_per_batch=8)
    return store.read("heart_rate").select("user_id", millis("timestamp").alias("ts_ms"), "value")


# Extension points.


def _calm_readings(docs: DataFrame) -> Decoded:
    """A decoder a user might put in place of the registered one: low readings only, and users with an id
    divisible by eleven are refused."""
    decoded = wellness.decode_heart_rate(docs.filter("user_id % 11 <> 0"))
    refused = docs.filter("user_id % 11 = 0").select(*ORIGIN, F.lit("user is refused").alias("rule"))
    return Decoded({k: rows.filter("value < 50") for k, rows in decoded.rows.items()}, [*decoded.failures, refused])


@query(f"""
with rows as (select event_id // {BLOCK} as user_id, epoch_us(ts) // 1000 as ts_ms, min(cast(floor(value) as integer)) as value
  from events where cast(floor(value) as integer) < 50 group by all)
select user_id, count(*) as n_rows, null::varchar as error_type from rows where user_id % 11 <> 0 and user_id % 5 <> 1 group by all
union all select distinct event_id // {BLOCK}, null, case when event_id // {BLOCK} % 11 = 0 then 'user is refused'
  else 'bad heart rate reading' end from events where event_id // {BLOCK} % 11 = 0 or event_id // {BLOCK} % 5 = 1
""")
def custom_processor(t: Tables) -> DataFrame:
    """A run with an own decoder of one type."""
    store = _store(t)
    raw = event_sets(t).filter(F.col("file_name").contains("_HEART_RATE_"))
    outcome = run_batch(t.spark, raw, store, _config("own", decoders={**DECODERS, "HEART_RATE": _calm_readings}))
    owner = F.regexp_extract("file_name", r"^(\d+)_", 1).cast("bigint").alias("user_id")
    failed = outcome.filter("not success").select(owner, F.lit(None).cast("bigint").alias("n_rows"), "error_type")
    stored = store.read("heart_rate").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return stored.withColumn("error_type", F.lit(None).cast("string")).unionByName(failed)


def _large_unread(files: DataFrame, limit: int) -> DataFrame:
    """An ingest stage: large files are stored unread."""
    return files.withColumn("state", F.when(F.col("length") > limit, "store").otherwise("process"))


def _without_note(files: DataFrame) -> DataFrame:
    """A prepare stage: the note in front of a document is dropped."""
    return files.withColumn("content", F.regexp_replace("content", "^note:", ""))


def _to_archive(outcome: DataFrame) -> DataFrame:
    """A store stage: stored files go to the archive."""
    return outcome.replace("store", "archive", subset=["state"])


@query("""
select doc_id, case when coalesce(n_chars, 0) > 800 or doc_id % 9 <> 0 then 'archive' else 'quarantine' end as state
from documents
""")
def custom_stage_callables(t: Tables) -> DataFrame:
    """A run with own ingest, prepare and store stages over one file per document; a ninth of the files hold a
    broken reading, which costs nothing where the file is large and so is not read."""
    key = F.col("doc_id")
    second = F.date_format(F.timestamp_seconds(F.lit(1_704_110_400) + key), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    name = F.concat(key.cast("string"), F.lit("_HEART_RATE_"), second, F.lit(".json"))
    values = F.when(key % 9 == 0, F.lit("[[1]]")).otherwise(F.lit("[]"))
    content = F.concat(F.lit('note:{"heartRateValues": '), values, F.lit("}"))
    raw = _raw(t.documents, name, content, F.col("n_chars"))
    stages = {"ingest": partial(_large_unread, limit=800), "prepare": _without_note, "store": _to_archive}
    outcome = run_batch(t.spark, raw, _store(t), _config("stages", **stages))
    return outcome.select(F.regexp_extract("file_name", r"^(\d+)_", 1).cast("bigint").alias("doc_id"), "state")
