"""Columns that are computed exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns as the output of a one-row generator. The optimizer copies an expression
    into every filter it pushes below a projection, but pushes nothing below a generator."""
    packed = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(packed)))
