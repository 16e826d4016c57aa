"""Exact row numbers without putting a whole group into one task.

A plain `row_number()` sorts a complete window partition in one task. Here the order is cut into
levels, coarse to fine, each a function that never decreases along the order. Row numbers are taken
inside the finest level only; counts per level, which are pre-aggregated before the shuffle, give
the offset of every level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_rows(
    df: DataFrame,
    name: str,
    order: Sequence[str],
    levels: Sequence[Column],
    within: Sequence[str] = (),
) -> DataFrame:
    """Add `name`: the 1-based position of each row in `order` inside each `within` group.

    `levels` must be monotone in `order`. The finest level bounds the rows one task sorts; the
    number of distinct values of a level inside its parent bounds the rows one task sums over.
    """
    within = list(within)
    marks = [f"_level{i}" for i in range(len(levels))]
    tagged = df.select("*", *[level.alias(mark) for level, mark in zip(levels, marks)])

    counts = tagged.groupBy(*within, *marks).agg(F.count(F.lit(1)).alias("_n"))
    offsets = None
    for depth in range(len(marks)):
        parent, key = marks[:depth], marks[depth]
        sizes = counts.groupBy(*within, *parent, key).agg(F.sum("_n").alias("_n"))
        before = (
            Window.partitionBy(*within, *parent)
            .orderBy(key)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        here = sizes.select(
            *within, *parent, key, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(f"_before{depth}")
        )
        offsets = here if offsets is None else _attach(here, offsets, [*within, *parent])
    start = sum((F.col(f"_before{d}") for d in range(1, len(marks))), F.col("_before0"))

    # The offset of a group travels as one more row, sorted first, so that numbering and adding the
    # offset take one shuffle and one sort of the data and no join.
    heads = offsets.select(*within, *marks, start.alias("_start"))
    rows = tagged.withColumn("_start", F.lit(None).cast("bigint")).unionByName(heads, allowMissingColumns=True)
    inside = Window.partitionBy(*within, *marks).orderBy(F.col("_start").desc_nulls_last(), *order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumns(
        {"_rank": F.row_number().over(inside), "_offset": F.max("_start").over(so_far)}
    )
    return (
        placed.filter(F.col("_start").isNull())
        .withColumn(name, F.col("_offset") + F.col("_rank") - 1)
        .drop("_start", "_rank", "_offset", *marks)
    )


def _attach(df: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join one lookup row per key; NULL keys match."""
    names = {key: f"_k_{key}" for key in keys}
    condition = F.lit(True)
    for key, other in names.items():
        condition = condition & F.col(key).eqNullSafe(F.col(other))
    return df.join(lookup.withColumnsRenamed(names), condition).drop(*names.values())


def time_levels(ts: str) -> list[Column]:
    """Day, then second: at most 86,400 seconds per day and one million microseconds per second."""
    second = F.date_trunc("second", F.col(ts))
    return [F.to_date(F.col(ts)), second]
