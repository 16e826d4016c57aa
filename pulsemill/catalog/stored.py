"""Queries: time chunks on disk, roll-ups and daily averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.catalog.base import (
    Tables,
    ntz,
    packed_events,
    query,
)
from pulsemill.catalog.files import CHUNK_SQL, chunked_events
from pulsemill.operators import merge, wellness
from pulsemill.operators.documents import ORDER
from pulsemill.session import scratch_path
from pulsemill.sources import chunks, mailbox

NOW = "2024-02-20"


@query("select event_id, user_id from events where ts >= timestamp '2024-01-11' and ts < timestamp '2024-01-18'")
def chunk_pruned_scan(t: Tables) -> DataFrame:
    stored = t.spark.read.parquet(chunked_events(t))
    return chunks.time_range(stored, "ts", "2024-01-11", "2024-01-18").select("event_id", "user_id")


@query(f"select {CHUNK_SQL} as chunk, user_id, count(*) as n_rows from events group by all")
def cluster_chunks(t: Tables) -> DataFrame:
    rows = t.events.withColumn("chunk", chunks.chunk_of(F.col("ts")))
    clustered = chunks.cluster_chunks(rows.select("chunk", "user_id", "ts"), ["user_id"], ["ts"])
    return clustered.groupBy(F.col("chunk").cast("string").alias("chunk"), "user_id").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query(f"""
select event_id, {CHUNK_SQL} as chunk, date '1970-01-01' + to_days(cast(7 * (date_diff('day', date '1970-01-01',
  cast(ts as date)) // 7) + 7 as integer)) <= date '{NOW}' - interval 30 day as compacted
from events
""")
def compact_old_chunks(t: Tables) -> DataFrame:
    source, target = chunked_events(t), scratch_path(t.spark, "compacted")
    now = F.lit(NOW).cast("timestamp")
    chunks.compact_old_chunks(t.spark, source, target, "ts", ["user_id"], now)
    fresh = chunks.drop_expired_chunks(t.spark.read.parquet(source), now, chunks.COMPACT_AFTER_DAYS)
    compacted = t.spark.read.parquet(target).withColumn("compacted", F.lit(True))
    both = compacted.unionByName(fresh.withColumn("compacted", F.lit(False)))
    return both.select("event_id", F.col("chunk").cast("string").alias("chunk"), "compacted")


@query("select event_id from events where ts >= timestamp '2024-01-11 06:00:00' and ts < timestamp '2024-01-11 12:00:00'")
def min_max_skip(t: Tables) -> DataFrame:
    folder = scratch_path(t.spark, "sorted")
    t.events.select("event_id", "ts").repartitionByRange("ts").sortWithinPartitions("ts").write.parquet(folder)
    low, high = (F.expr(f"timestamp_ntz'2024-01-11 {hour}:00:00'") for hour in ("06", "12"))
    stored = t.spark.read.parquet(folder)
    return stored.filter((F.col("ts") >= low) & (F.col("ts") < high)).select("event_id")


@query("""
select date_trunc('hour', ts)::timestamp as bucket, event_type, count(*) as n, sum(cast(round(value * 100) as bigint))::bigint as total,
  min(cast(round(value * 100) as bigint)) as low, max(cast(round(value * 100) as bigint)) as high
from events group by all
""")
def time_bucket_rollup(t: Tables) -> DataFrame:
    rows = t.events.select("ts", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    rollup = chunks.time_bucket_rollup(rows, "ts", "1 hour", ["event_type"], "cents")
    return rollup.withColumn("bucket", ntz(F.col("bucket")))


@query(f"select event_id from events where {CHUNK_SQL} >= '2024-01-18'")
def drop_expired_chunks(t: Tables) -> DataFrame:
    stored = t.spark.read.parquet(chunked_events(t))
    kept = chunks.drop_expired_chunks(stored, F.lit("2024-01-30").cast("timestamp"), 7)
    return kept.select("event_id")


@query("""
with readings as (select event_id // 4096 as user_id, epoch_us(ts) // 1000 as ms, min(cast(floor(value) as integer)) as value
  from events group by all)
select user_id, cast(make_timestamp(ms * 1000) as date) as day, count(*) as n_readings,
  round(sum(value)::double / count(*), 4) as average_rate
from readings group by all
""")
def daily_heart_rate(t: Tables) -> DataFrame:
    """Flagship: documents -> readings -> keyed table -> average heart rate per user and day."""
    docs = packed_events(t).withColumn("path", F.col("file_name")).withColumn("mtime", F.lit(None).cast("timestamp"))
    rows = wellness.explode_heart_rate(mailbox.with_origin(docs))
    table = merge.first_per_key(rows, ["user_id", "timestamp"], ["value", *ORDER])
    return table.groupBy("user_id", F.col("timestamp").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n_readings"),
        F.round(F.sum("value") / F.count(F.lit(1)), 4).alias("average_rate"),
    )
