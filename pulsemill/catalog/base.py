"""Registry of the queries and their SQL twins, and the inputs they share.

The inputs turn the given tables into the shapes the operators read: file names, raw documents and
frames. Each document is made from one row, or from a block of rows whose size is bounded by a unique
id, so no input gathers an unbounded group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.fields import Field
from pulsemill.functions.names import activity_file_name, standard_file_name
from pulsemill.plans.once import with_columns_once
from pulsemill.session import prepare_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Events per packed document; event ids are unique, so this bounds a document.
BLOCK = 4096


class Tables:
    """The given tables of one folder, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of the tables under its own name, with its SQL twin if there is one."""

    def register(make: Callable[[Tables], DataFrame]):
        @wraps(make)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return make(Tables(prepare_session(spark), folder))

        QUERIES[make.__name__] = run
        if sql is not None:
            ORACLES[make.__name__] = sql
        return make

    return register


def ntz(ts: Column) -> Column:
    """Instants leave the queries as UTC wall clock, as the given tables hold them."""
    return ts.cast("timestamp_ntz")


def millis(ts: str | Column) -> Column:
    return F.unix_millis((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


# File type each event type stands for; BATTERY is a type nobody registered.
EVENT_KINDS = {
    "click": "HEART_RATE",
    "view": "STEPS",
    "purchase": "ACTIVITY",
    "signup": "SLEEP",
    "error": "BATTERY",
}
EVENT_KIND_SQL = "case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in EVENT_KINDS.items()) + " end"


def event_files(t: Tables) -> DataFrame:
    """Every event as a file of its user's day."""
    kind = F.expr(EVENT_KIND_SQL)
    day = F.col("ts").cast("timestamp")
    name = F.when(kind == "ACTIVITY", activity_file_name(F.col("user_id"), F.col("event_id"), day)).otherwise(
        standard_file_name(F.col("user_id"), kind, day)
    )
    named = with_columns_once(over_all_cores(t.events), {"file_name": name})
    return named.select(
        "event_id",
        "user_id",
        "event_type",
        "file_name",
        F.concat(F.lit("/in/"), F.col("event_id").cast("string"), F.lit("/"), "file_name").alias("path"),
        day.alias("mtime"),
        F.floor("value").cast("bigint").alias("length"),
    )


EVENT_FILES_SQL = f"""
files as (
  select event_id, user_id, event_type, {EVENT_KIND_SQL} as kind,
    case when event_type = 'error' then null else {EVENT_KIND_SQL} end as file_type,
    cast(date_trunc('day', ts) as timestamp) + interval 12 hour as file_set_ts,
    case when event_type = 'purchase'
      then user_id || '_ACTIVITY_' || event_id || '_' || strftime(ts, '%Y-%m-%d') || 'T12:00:00Z.fit'
      else user_id || '_' || {EVENT_KIND_SQL} || '_' || strftime(ts, '%Y-%m-%d') || 'T12:00:00Z.json' end as file_name,
    cast(floor(value) as bigint) as length, ts
  from events
),
named as (select *, '/in/' || event_id || '/' || file_name as path from files)
"""


def over_all_cores(rows: DataFrame) -> DataFrame:
    """Spread a scan that has fewer tasks than there are cores, as the one-file tables do here; large
    tables have many tasks and are left alone. Building and parsing documents is all CPU."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() >= cores:
        return rows
    return rows.repartition(cores, *rows.columns[:2])


def as_docs(rows: DataFrame, content: Column, user: str, *keep: str) -> DataFrame:
    """Documents of one row each, at a fixed set time."""
    return over_all_cores(rows).select(
        F.lit("2024-01-01 12:00:00").cast("timestamp").alias("file_set_ts"),
        F.lit(1).alias("type_rank"),
        F.lit("document").alias("file_name"),
        content.alias("content"),
        F.col(user).cast("bigint").alias("user_id"),
        *keep,
    )


def filled(fields: Sequence[Field], number: Column, key: Column, text: Column) -> list[Column]:
    """A document value for every field: another one per field, and none in every seventh."""
    values = {
        "double": lambda n: number + n,
        "bigint": lambda n: key + n,
        "int": lambda n: key % 1000 + n,
        "boolean": lambda n: (key + n) % 2 == 0,
        "string": lambda n: F.concat(text, F.lit(f" {n}")),
    }
    return [F.when((key + n) % 7 != 0, values[f.kind](n)).alias(f.json) for n, f in enumerate(fields)]


def filled_sql(fields: Sequence[Field], number: str, key: str, text: str) -> str:
    """The columns that the values of `filled` are stored in."""
    values = {
        "double": "cast({number} + {n} as double)",
        "bigint": "cast({key} + {n} as bigint)",
        "int": "cast({key} % 1000 + {n} as integer)",
        "boolean": "({key} + {n}) % 2 = 0",
        "string": "{text} || ' {n}'",
    }
    return ", ".join(
        f"case when ({key} + {n}) % 7 <> 0 then {values[f.kind].format(number=number, key=key, text=text, n=n)} end"
        f' as "{f.column}"'
        for n, f in enumerate(fields)
    )


def packed_events(t: Tables) -> DataFrame:
    """Heart-rate documents of at most BLOCK events; the block stands for the user of the file."""
    block = F.floor(F.col("event_id") / BLOCK).cast("bigint")
    pair = F.array(millis("ts"), F.floor("value").cast("bigint"))
    packed = t.events.groupBy(block.alias("block")).agg(F.array_sort(F.collect_list(pair)).alias("heartRateValues"))
    return packed.select(
        standard_file_name(F.col("block"), "HEART_RATE", F.lit("2024-01-01").cast("date")).alias("file_name"),
        F.to_json(F.struct("heartRateValues")).alias("content"),
    )


PACKED_EVENTS_SQL = f"""
select event_id // {BLOCK} as user_id, epoch_us(ts) // 1000 as ts_ms, cast(floor(value) as integer) as value from events
"""
