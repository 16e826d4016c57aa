"""Constraint checks. Each returns the offending rows or keys; empty means the data holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.plans.skew import orphan_rows, skew_join


def foreign_key_violations(
    child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str]
) -> DataFrame:
    """Child rows whose key names no parent; a NULL key names nothing and is allowed."""
    return orphan_rows(child, parent, child_keys, parent_keys)


def unique_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1)


def unique_latest_violations(df: DataFrame, keys: Sequence[str], flag: str = "latest") -> DataFrame:
    """Keys with more than one flagged row."""
    counted = df.filter(F.col(flag)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_latest"))
    return counted.filter(F.col("n_latest") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_null) of every required column, in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns]
    )
    return counted.select(F.inline(pairs))


def cascade_delete(child: DataFrame, deleted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows that remain after their parents were deleted."""
    return skew_join(child, deleted.select(*keys).distinct(), keys, "left_anti")
