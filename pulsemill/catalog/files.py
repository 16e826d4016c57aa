"""Queries: scanning, naming, grouping and routing files, and their outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.catalog.base import (
    EVENT_FILES_SQL,
    EVENT_KIND_SQL,
    PACKED_EVENTS_SQL,
    Tables,
    event_files,
    millis,
    ntz,
    packed_events,
    query,
)
from pulsemill.functions import names
from pulsemill.operators import merge, wellness
from pulsemill.plans.numbering import number_rows
from pulsemill.plans.once import with_columns_once
from pulsemill.registry import DATA_TYPES, PROCESS_ORDER, type_rank
from pulsemill.session import scratch_path
from pulsemill.sources import chunks, ledger, mailbox

_SUMMARY_FORMATS = ("^src(1|2)$", "^src[3-9]$")


@query(PACKED_EVENTS_SQL)
def scan_raw_documents(t: Tables) -> DataFrame:
    folder = scratch_path(t.spark, "mailbox")
    mailbox.land_documents(packed_events(t), folder)
    docs = mailbox.with_origin(mailbox.scan_raw_documents(t.spark, folder))
    rows = wellness.explode_heart_rate(docs)
    return rows.select("user_id", millis("timestamp").alias("ts_ms"), "value")


@query(f"""
with {EVENT_FILES_SQL}
select event_id, kind <> 'SLEEP' as valid,
  case when kind <> 'SLEEP' then user_id end as user_id,
  case when kind <> 'SLEEP' then kind end as data_type,
  case when kind <> 'SLEEP' then strftime(ts, '%Y-%m-%d') || 'T12:00:00Z' end as file_time,
  case when kind = 'ACTIVITY' then 'fit' when kind <> 'SLEEP' then 'json' end as file_extension
from files
""")
def parse_filename(t: Tables) -> DataFrame:
    name = F.col("file_name")
    spoiled = F.when(F.col("event_type") == "signup", F.concat(F.lit("x"), name)).otherwise(name)
    files = event_files(t).select("event_id", spoiled.alias("file_name"))
    parts = names.parse_filename(F.col("file_name"))
    return files.select(
        "event_id",
        parts["user_id"].isNotNull().alias("valid"),
        *[column.alias(part) for part, column in parts.items()],
    )


@query("""
select o_orderkey, case when o_orderstatus <> 'P' then o_orderkey end as activity_id from orders
""")
def parse_activity_filename(t: Tables) -> DataFrame:
    good = names.activity_file_name(F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderdate"))
    name = F.when(F.col("o_orderstatus") == "P", F.replace(good, F.lit(".fit"), F.lit(".json"))).otherwise(good)
    return t.orders.select("o_orderkey", names.parse_activity_filename(name).alias("activity_id"))


@query(f"""
with {EVENT_FILES_SQL}
select event_id, file_type, case when kind = 'HEART_RATE' then
  case when starts_with(file_name, '1') then 'FIRST' else 'ANY' end end as own_type
from files
""")
def classify_file_type(t: Tables) -> DataFrame:
    name = F.col("file_name")
    by_pattern = names.classify_file_type(name, {"FIRST": "^1.*_HEART_RATE_", "ANY": "_HEART_RATE_"})
    return event_files(t).select(
        "event_id", names.registered_type(name).alias("file_type"), by_pattern.alias("own_type")
    )


@query("""
select o_orderkey, o_orderdate + case o_orderstatus when 'O' then interval 12 hour when 'F' then interval 8 hour
  else interval 0 hour end as file_second
from orders
""")
def extract_file_timestamp(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    name = (
        F.when(F.col("o_orderstatus") == "O", F.concat(F.lit("1_DATA_"), day, F.lit("T12:00:00Z.csv")))
        .when(F.col("o_orderstatus") == "F", F.concat(day, F.lit("T10:00:00.250+02:00_data.csv")))
        .otherwise(F.lit("data.csv"))
    )
    path = F.concat(F.lit("/in/"), F.col("o_orderkey").cast("string"))
    stamp = names.extract_file_timestamp(name, F.col("o_orderdate").cast("timestamp"), path)
    return t.orders.select("o_orderkey", ntz(F.date_trunc("second", stamp)).alias("file_second"))


@query(f"""
select doc_id, case when regexp_matches(source, '{_SUMMARY_FORMATS[0]}') then 'store'
  when regexp_matches(source, '{_SUMMARY_FORMATS[1]}') then 'process' else 'ingest' end as state
from documents
""")
def route_ingest(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", ledger.route_ingest(F.col("source"), *_SUMMARY_FORMATS).alias("state"))


def _set_files(t: Tables) -> DataFrame:
    """Event files with their type and set time."""
    name = F.col("file_name")
    return with_columns_once(
        event_files(t),
        {
            "file_type": names.registered_type(name),
            "file_set_ts": names.extract_file_timestamp(name, F.col("mtime"), F.col("path")),
        },
    )


@query(f"""
with {EVENT_FILES_SQL}
select file_set_ts, file_type, count(*) as n_files, cast(sum(length) as bigint) as total_bytes,
  min(file_name) as first_name, max(file_name) as last_name
from files where file_type is not null group by all
""")
def group_file_sets(t: Tables) -> DataFrame:
    sets = ledger.group_file_sets(_set_files(t).filter("file_type is not null"))
    return sets.withColumn("file_set_ts", ntz(F.col("file_set_ts")))


@query(f"""
with {EVENT_FILES_SQL}
select file_set_ts, file_name, count(*) over (partition by file_set_ts) as n_unmatched
from files where file_type is null
""")
def detect_unmatched_files(t: Tables) -> DataFrame:
    return ledger.unmatched_files(_set_files(t)).withColumn("file_set_ts", ntz(F.col("file_set_ts")))


@query("""
with sets as (select distinct ts as file_set_ts from events),
numbered as (select file_set_ts, row_number() over (order by file_set_ts) as set_no, count(*) over () as n from sets)
select file_set_ts, set_no, cast(case when set_no - 1 < least(n // 300, 8) * 300 then (set_no - 1) // 300
  else (set_no - 1 - least(n // 300, 8) * 300) % least(n // 300, 8) end as bigint) as batch_id
from numbered
""")
def assign_batches(t: Tables) -> DataFrame:
    sets = t.events.select(F.col("ts").cast("timestamp").alias("file_set_ts")).distinct()
    return ledger.assign_batches(sets, 300, 8).withColumn("file_set_ts", ntz(F.col("file_set_ts")))


_KNOWN = [name for name in DATA_TYPES if name != "ACTIVITY"]


@query(f"""
with {EVENT_FILES_SQL}
select file_set_ts, file_type, path from named where file_type is not null and file_type <> 'ACTIVITY'
""")
def file_set_roundtrip(t: Tables) -> DataFrame:
    pages = ledger.file_set_pages(_set_files(t))
    text = pages.select("file_set_ts", ledger.to_serializable(F.col("files")).alias("text"))
    back = text.select("file_set_ts", ledger.from_serializable(F.col("text"), _KNOWN).alias("files"))
    typed = back.select("file_set_ts", F.explode("files").alias("file_type", "paths"))
    return typed.select(ntz(F.col("file_set_ts")).alias("file_set_ts"), "file_type", F.explode("paths").alias("path"))


@query(f"""
with {EVENT_FILES_SQL}
select file_set_ts, cast(coalesce(sum(case when length >= 50 then length end), 0) as bigint) as total_bytes
from files group by all
""")
def file_set_size(t: Tables) -> DataFrame:
    found = _set_files(t).withColumn("length", F.when(F.col("length") >= 50, F.col("length")))
    return ledger.file_set_size(found).withColumn("file_set_ts", ntz(F.col("file_set_ts")))


@query(f"""
with {EVENT_FILES_SQL}
select 'any' as asked, path from named where file_type is not null
union all select 'ACTIVITY' as asked, path from named where file_type = 'ACTIVITY'
""")
def file_set_get_files(t: Tables) -> DataFrame:
    pages = ledger.file_set_pages(_set_files(t))
    lists = F.array(
        F.struct(F.lit("any").alias("asked"), ledger.all_paths(F.col("files")).alias("paths")),
        F.struct(F.lit("ACTIVITY").alias("asked"), ledger.paths_of_type(F.col("files"), "ACTIVITY").alias("paths")),
    )
    return pages.select(F.inline(lists)).select("asked", F.explode("paths").alias("path"))


def _results(t: Tables) -> DataFrame:
    return t.labels.select(F.col("doc_id").cast("string").alias("file_name"), (F.col("toxic") == 0).alias("success"))


def _documents(t: Tables) -> DataFrame:
    return t.documents.select(F.col("doc_id").cast("string").alias("file_name"))


@query("""
select cast(d.doc_id as varchar) as file_name,
  case when l.toxic = 1 then 'quarantine' else 'store' end as state
from documents d left join labels l using (doc_id)
""")
def route_store(t: Tables) -> DataFrame:
    return ledger.route_store(_documents(t), _results(t))


_MANIFEST_TYPES = ", ".join(
    f"('{name}', '{param}')" for name, param in DATA_TYPES.items() if name != "ACTIVITY"
)


@query(f"""
with types(data_type, time_param) as (values {_MANIFEST_TYPES}),
spans as (select user_id, min(cast(ts as date)) as a, max(cast(ts as date)) as b from events group by all),
days as (select user_id, cast(unnest(generate_series(a, b, interval 1 day)) as date) as day, b from spans)
select user_id, cast(day as varchar) as day, data_type, time_param, 'json' as extension
from days join types on time_param <> 'no_date' or day = b
""")
def extraction_manifest(t: Tables) -> DataFrame:
    day = F.col("ts").cast("date")
    spans = t.events.groupBy("user_id").agg(F.min(day).alias("start_day"), F.max(day).alias("end_day"))
    return ledger.extraction_manifest(spans).withColumn("day", F.col("day").cast("string"))


@query("""
select l_orderkey, l_linenumber, cast(cast(l_shipdate as date) as varchar) as first_day,
  cast(cast(case when l_linenumber > 3 then l_shipdate + to_days(l_linenumber - 4)
    else l_shipdate + to_days(l_linenumber - 3) end as date) as varchar) as last_day
from lineitem
""")
def resolve_date_interval(t: Tables) -> DataFrame:
    start = F.col("l_shipdate").cast("date")
    first, last = ledger.resolve_date_interval(start, F.date_add(start, F.col("l_linenumber") - 3))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", first.cast("string").alias("first_day"), last.cast("string").alias("last_day")
    )


@query(f"""
with requests as (select event_id, {EVENT_KIND_SQL} as data_type from events)
select event_id, data_type, true as known from requests where data_type in ('HEART_RATE', 'SLEEP')
union all select distinct null, data_type, false from requests where data_type = 'BATTERY'
""")
def select_data_types(t: Tables) -> DataFrame:
    requests = t.events.select("event_id", F.expr(EVENT_KIND_SQL).alias("data_type"))
    chosen = ledger.select_data_types(requests, ["HEART_RATE", "SLEEP"]).withColumn("known", F.lit(True))
    wrong = ledger.invalid_data_types(requests, list(DATA_TYPES)).select(
        F.lit(None).cast("bigint").alias("event_id"), "data_type", F.lit(False).alias("known")
    )
    return chosen.unionByName(wrong)


@query(f"""
select user_id || '_' || {EVENT_KIND_SQL} || '_' || strftime(ts, '%Y-%m-%d') || 'T12:00:00Z.json' as file_name
from events
union all
select o_custkey || '_ACTIVITY_' || o_orderkey || '_' || strftime(o_orderdate, '%Y-%m-%d') || 'T12:00:00Z.fit'
from orders
""")
def standard_file_name(t: Tables) -> DataFrame:
    day = F.col("ts").cast("timestamp")
    documents = t.events.select(names.standard_file_name(F.col("user_id"), F.expr(EVENT_KIND_SQL), day).alias("file_name"))
    activities = t.orders.select(
        names.activity_file_name(F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderdate")).alias("file_name")
    )
    return documents.unionByName(activities)


CHUNK_SQL = "strftime(date '1970-01-01' + to_days(cast(7 * (date_diff('day', date '1970-01-01', cast(ts as date)) // 7) as integer)), '%Y-%m-%d')"


def chunked_events(t: Tables) -> str:
    """Events written in time chunks; returns the folder."""
    folder = scratch_path(t.spark, "chunks")
    rows = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    chunks.write_time_chunks(rows, folder, "ts", ["user_id"])
    return folder


@query(f"select event_id, {CHUNK_SQL} as chunk from events")
def write_time_chunks(t: Tables) -> DataFrame:
    stored = t.spark.read.parquet(chunked_events(t))
    return stored.select("event_id", F.col("chunk").cast("string").alias("chunk"))


_RESULT_KEYS = ["dag_id", "dag_run_id", "dag_start_date", "file_name"]


def _run_rows(rows: DataFrame, stamp: str) -> DataFrame:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    named = rows.select(
        F.lit("wearables").alias("dag_id"),
        F.lit("run-1").alias("dag_run_id"),
        start.alias("dag_start_date"),
        "file_name",
        "success",
        "error_type",
    )
    return merge.stamp_audit_columns(named, F.lit(stamp).cast("timestamp"))


@query("""
select cast(d.doc_id as varchar) as file_name, d.n_chars > 500 as success,
  case when d.n_chars <= 500 then 'too short' end as error_type,
  case when l.doc_id is null then '2024-01-03' else '2024-01-02' end as created, '2024-01-03' as updated
from documents d left join labels l using (doc_id)
""")
def write_etl_result(t: Tables) -> DataFrame:
    stored = _run_rows(_results(t).withColumn("error_type", F.lit(None).cast("string")), "2024-01-02 00:00:00")
    long = F.col("n_chars") > 500
    retried = t.documents.select(
        F.col("doc_id").cast("string").alias("file_name"),
        long.alias("success"),
        F.when(~long, F.lit("too short")).alias("error_type"),
    )
    merged = merge.upsert(
        stored, _run_rows(retried, "2024-01-03 00:00:00"), _RESULT_KEYS, ["file_name"], preserve=["create_ts"]
    )
    return merged.select(
        "file_name",
        "success",
        "error_type",
        F.date_format("create_ts", "yyyy-MM-dd").alias("created"),
        F.date_format("update_ts", "yyyy-MM-dd").alias("updated"),
    )


@query("""
select o_orderkey from orders
where o_orderstatus = 'F' and o_orderpriority = '3-MEDIUM' and o_orderdate = timestamp '1998-10-03'
""")
def read_etl_result(t: Tables) -> DataFrame:
    results = t.orders.withColumnsRenamed(
        {"o_orderstatus": "dag_id", "o_orderpriority": "dag_run_id", "o_orderdate": "dag_start_date"}
    )
    start = F.expr("timestamp_ntz'1998-10-03 00:00:00'")
    return ledger.read_etl_result(results, "F", "3-MEDIUM", start).select("o_orderkey")


# Outcomes of files and sets.


@query("""
with files as (
  select d.doc_id, d.doc_id // 10 as set_no, coalesce(l.toxic, 0) = 0 as success
  from documents d left join labels l using (doc_id))
select doc_id, bool_and(success) over (partition by set_no) as set_ok from files
""")
def file_set_status(t: Tables) -> DataFrame:
    reported = t.documents.join(t.labels, "doc_id", "left")
    files = reported.select(
        F.col("doc_id").alias("file_name"),
        F.floor(F.col("doc_id") / 10).alias("file_set_ts"),
        (F.coalesce("toxic", F.lit(0)) == 0).alias("success"),
    )
    return ledger.file_set_status(files).select(F.col("file_name").alias("doc_id"), "set_ok")


@query("""
select count(*) filter (toxic = 0) as n_success, count(*) filter (toxic <> 0) as n_error, count(*) as n_total,
  (count(*) filter (toxic = 0)) || '/' || count(*) as summary
from labels
""")
def result_summary(t: Tables) -> DataFrame:
    return ledger.result_summary(_results(t))


@query("select event_type, count(*) as n_rows from events group by all")
def target_row_counts(t: Tables) -> DataFrame:
    return ledger.target_row_counts(t.events, "event_type")


@query(f"""
with routed as (select cast(doc_id as varchar) as file_name,
  case when regexp_matches(source, '{_SUMMARY_FORMATS[0]}') then 'store'
  when regexp_matches(source, '{_SUMMARY_FORMATS[1]}') then 'process' else 'ingest' end as state from documents)
select state, count(*) over (partition by state) as n_files, file_name from routed
""")
def ingest_summary(t: Tables) -> DataFrame:
    state = ledger.route_ingest(F.col("source"), *_SUMMARY_FORMATS)
    return ledger.state_summary(
        t.documents.select(F.col("doc_id").cast("string").alias("file_name"), state.alias("state"))
    )


@query("""
select cast(d.doc_id as varchar) as file_name, coalesce(l.toxic = 0, false) as success
from documents d left join labels l using (doc_id)
""")
def init_results(t: Tables) -> DataFrame:
    return ledger.init_results(_documents(t), _results(t))


@query("""
with a as (select count(*) as n from (select doc_id, toxic from labels except all select doc_id, quality from labels)),
b as (select count(*) as n from (select doc_id, quality from labels except all select doc_id, toxic from labels))
select a.n as only_left, b.n as only_right, a.n = 0 and b.n = 0 as equal from a, b
""")
def compare_results(t: Tables) -> DataFrame:
    left = t.labels.select("doc_id", F.col("toxic").alias("outcome"))
    right = t.labels.select("doc_id", F.col("quality").alias("outcome"))
    return ledger.compare_results(left, right)


@query("""
with sets as (select distinct o_orderdate as file_set_ts from orders)
select file_set_ts, row_number() over (order by file_set_ts) as set_no from sets
""")
def order_file_sets(t: Tables) -> DataFrame:
    sets = t.orders.select(F.col("o_orderdate").cast("timestamp").alias("file_set_ts")).distinct()
    return ledger.order_file_sets(sets).withColumn("file_set_ts", ntz(F.col("file_set_ts")))


_RANK_SQL = (
    "case file_type "
    + " ".join(f"when '{name}' then {i}" for i, name in enumerate(PROCESS_ORDER, 1))
    + f" else {len(PROCESS_ORDER) + 1} end"
)


@query(f"""
with {EVENT_FILES_SQL}
select event_id, {_RANK_SQL} as type_rank,
  row_number() over (partition by file_set_ts order by {_RANK_SQL}, event_id) as place
from files
""")
def order_by_type_rank(t: Tables) -> DataFrame:
    files = _set_files(t).withColumn("type_rank", type_rank(F.col("file_type")))
    levels = [F.col("type_rank"), F.floor(F.col("event_id") / 65_536)]
    placed = number_rows(files, "place", ["type_rank", "event_id"], levels, ["file_set_ts"])
    return placed.select("event_id", "type_rank", "place")


@query("""
select o_custkey, o_orderkey, o_totalprice from orders
qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1
""")
def first_row(t: Tables) -> DataFrame:
    first = merge.first_per_key(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return first.select("o_custkey", "o_orderkey", "o_totalprice")


@query(f"""
with {EVENT_FILES_SQL}
select distinct file_type from files where file_type is not null and file_type not in ('SLEEP', 'STEPS')
""")
def unprocessed_types(t: Tables) -> DataFrame:
    return ledger.unprocessed_types(_set_files(t), ["SLEEP", "STEPS"])


@query("""
select o_custkey, o_orderkey, o_totalprice as balance, null::varchar as status from orders where o_orderstatus = 'F'
union all select o_custkey, o_orderkey, null, o_orderpriority from orders where o_orderstatus <> 'F'
""")
def union_writers(t: Tables) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    balance = t.orders.filter(done).select("o_custkey", "o_orderkey", F.col("o_totalprice").alias("balance"))
    status = t.orders.filter(~done).select("o_custkey", "o_orderkey", F.col("o_orderpriority").alias("status"))
    return merge.union_writers(balance, status)
