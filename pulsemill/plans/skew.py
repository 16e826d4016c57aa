"""Joins that stay balanced when a few keys hold most of the rows.

A key is hot when it holds more than 1/HOT_SHARE of all rows. By counting, fewer than HOT_SHARE keys
can be hot however large the table is, and the looked-up side has one row per key, so both the list of
hot keys and the rows they look up may be broadcast. Hot rows are joined where they are read, also
when they are exact copies of each other, and are never shuffled; every other key holds at most
1/HOT_SHARE of the rows and takes the usual join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 200


def hot_keys(df: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys of `df` that hold more than 1/share of its rows: fewer than `share` rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.filter(F.col("_n") * F.lit(share) > total).select(*keys)


def skew_join(
    left: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner", null_safe: bool = False
) -> DataFrame:
    """Equi-join a large `left`, whose keys may be skewed, with a `lookup` of one row per key.

    `how` is inner, left, left_semi or left_anti. With `null_safe`, NULL keys match each other.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    hot = F.broadcast(hot_keys(left, keys))
    busy = _join(left, hot, keys, "left_semi", True)
    rest = _join(left, hot, keys, "left_anti", True)
    few = F.broadcast(_join(lookup, hot, keys, "left_semi", True))
    return _join(busy, few, keys, how, null_safe).unionByName(_join(rest, lookup, keys, how, null_safe))


def _join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, list(keys), how)
    names = {key: f"_r_{key}" for key in keys}
    return left.join(right.withColumnsRenamed(names), _matches(names), how).drop(*names.values())


def _matches(names: dict[str, str]) -> Column:
    condition = F.lit(True)
    for key, other in names.items():
        condition = condition & F.col(key).eqNullSafe(F.col(other))
    return condition


def orphan_rows(
    child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_keys: Sequence[str]
) -> DataFrame:
    """Child rows whose complete, non-NULL key has no parent row."""
    known = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_keys, child_keys)]).distinct()
    complete = F.lit(True)
    for key in child_keys:
        complete = complete & F.col(key).isNotNull()
    return skew_join(child.filter(complete), known, child_keys, "left_anti")
