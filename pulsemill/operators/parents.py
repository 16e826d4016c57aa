"""Rules about parent rows: personal records and frames need their activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from pulsemill.plans.skew import skew_join


def filter_existing_parent(rows: DataFrame, parents: DataFrame, key: str, exempt: Column) -> DataFrame:
    """Rows whose parent is stored, and the exempt ones; the others are expected gaps of a backfill."""
    known = parents.select(key).distinct()
    bound = skew_join(rows.filter(~exempt), known, [key], "left_semi")
    return bound.unionByName(rows.filter(exempt))
