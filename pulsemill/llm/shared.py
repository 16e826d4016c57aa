"""Helpers of several operators: written stages, keys of documents and checked lookups."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.plans.skew import skew_join
from pulsemill.session import prepare_session, scratch_path

# Rows up to which a counted lookup is broadcast.
BROADCAST_ROWS = 10_000


def ready(spark: SparkSession) -> SparkSession:
    """Session settings, and this package on the path of Python workers that share the driver's disk; a
    cluster gets the package with --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))
    return prepare_session(spark)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(*names: str) -> list[str]:
    """Column names that clash with no column of a caller."""
    tail = uuid.uuid4().hex[:8]
    return [f"_{name}_{tail}" for name in names]


def lookup_join(left: DataFrame, lookup: DataFrame, key: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """Left join with a lookup of one row per non-NULL key: broadcast if it is counted to be small, else
    shuffled with its hot keys apart."""
    if lookup.limit(most + 1).count() <= most:
        return left.join(F.broadcast(lookup), key, "left")
    return skew_join(left, lookup, [key], "left")


def tables(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def whole_text(text: str = "text") -> Column:
    """A null text is an empty one."""
    return F.coalesce(F.col(text), F.lit(""))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out to at least the configured number of tasks, for costly work on few rows."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
