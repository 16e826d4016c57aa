"""Time series as Parquet folders, one per 7-day chunk.

Inside a chunk the rows are clustered by segment (the owner of the series) and time. The write is
range-partitioned on (chunk, segment, time): a hot chunk or a hot owner is cut into several tasks,
every file covers a narrow range, and its min/max statistics let later scans skip it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_DAYS = 7
COMPACT_AFTER_DAYS = 30
ID_RANGE = 10_000_000


def chunk_of(ts: Column) -> Column:
    """First day of the 7-day window; windows are counted from 1970-01-01."""
    day = F.unix_date(ts.cast("date"))
    return F.date_from_unix_date(day - F.pmod(day, F.lit(CHUNK_DAYS)))


def id_chunk_of(key: Column) -> Column:
    """Range of an id; ids grow with time, so a run touches few ranges."""
    return F.floor(key / F.lit(ID_RANGE)).cast("bigint")


def cluster_chunks(df: DataFrame, segment: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by (chunk, segment, order)."""
    keys = ["chunk", *segment, *order]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def write_time_chunks(
    df: DataFrame,
    path: str,
    ts: str,
    segment: Sequence[str],
    mode: str = "append",
    codec: str = "snappy",
    chunk: Column | None = None,
) -> None:
    """`append` adds files; `overwrite` replaces only the chunks the rows fall into."""
    chunked = df.withColumn("chunk", chunk_of(F.col(ts)) if chunk is None else chunk)
    (
        cluster_chunks(chunked, segment, [ts])
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", codec)
        .partitionBy("chunk")
        .parquet(path)
    )


def time_range(df: DataFrame, ts: str, low, high) -> DataFrame:
    """Rows with low <= ts < high. The same range on `chunk` prunes folders, which a predicate on the
    time alone would not do."""
    low, high = F.lit(low).cast("timestamp"), F.lit(high).cast("timestamp")
    inside = (F.col(ts) >= low) & (F.col(ts) < high)
    return df.filter((F.col("chunk") >= chunk_of(low)) & (F.col("chunk") <= chunk_of(high)) & inside)


def old_chunks(now: Column, days: int) -> Column:
    """Chunks that end at least `days` days before `now`."""
    return F.date_add("chunk", CHUNK_DAYS) <= F.date_sub(now.cast("date"), days)


def compact_old_chunks(
    spark: SparkSession,
    source: str,
    target: str,
    ts: str,
    segment: Sequence[str],
    now: Column,
    days: int = COMPACT_AFTER_DAYS,
) -> None:
    """Rewrite the chunks older than `days` as few, sorted, zstd files in a new folder. The caller
    switches readers to it; the source stays whole until then, so a lost job loses nothing."""
    old = spark.read.parquet(source).filter(old_chunks(now, days))
    write_time_chunks(old, target, ts, segment, codec="zstd", chunk=F.col("chunk"))


def drop_expired_chunks(df: DataFrame, now: Column, days: int) -> DataFrame:
    """Rows of chunks that are not older than `days`; expired folders are never read."""
    return df.filter(~old_chunks(now, days))


def time_bucket_rollup(df: DataFrame, ts: str, width: str, keys: Sequence[str], value: str) -> DataFrame:
    """Count, sum, min and max of a value per time bucket and key, combined before the shuffle."""
    bucket = F.window(F.col(ts), width)["start"].alias("bucket")
    return df.groupBy(bucket, *keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(value).alias("total"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )


def refresh_rollup(
    spark: SparkSession, source: DataFrame, touched: Sequence, path: str, ts: str, width: str, keys: Sequence[str], value: str
) -> None:
    """Recompute the buckets of the touched chunks only and replace their folders. The width must
    divide a chunk, so that no bucket spans two chunks."""
    part = source.filter(F.col("chunk").isin(*touched))
    rollup = time_bucket_rollup(part, ts, width, keys, value)
    write_time_chunks(rollup, path, "bucket", list(keys), mode="overwrite")
