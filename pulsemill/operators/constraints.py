"""The constraints a table declares, as rules that submitted rows can break.

Keys and required columns must not be NULL, a plain insert must not repeat a key, and a row must have its
parent. Each function returns (origin columns, rule), once per origin and rule; the origin is the file, and
one broken rule costs the file its whole set.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.operators.documents import ORIGIN
from pulsemill.operators.merge import duplicate_source_keys
from pulsemill.plans.skew import orphan_rows
from pulsemill.schema import Table


def null_findings(rows: DataFrame, table: Table, origin: Sequence[str] = ORIGIN) -> DataFrame | None:
    """Rows without a key or required column, all columns in one pass; None if the rows carry none of them."""
    needed = [c for c in dict.fromkeys((*table.keys, *table.required)) if c in rows.columns]
    if not needed:
        return None
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(f"{table.name}.{c} is missing")) for c in needed]))
    return rows.select(*origin, F.explode(missing).alias("rule")).distinct()


def repeated_findings(rows: DataFrame, table: Table, origin: Sequence[str] = ORIGIN) -> DataFrame:
    """Files that submit a key more than once to a table that inserts plainly."""
    repeated = duplicate_source_keys(rows, table.keys, origin)
    return repeated.select(*origin, F.lit(f"{table.name} key is repeated").alias("rule")).distinct()


def orphan_findings(rows: DataFrame, parents: DataFrame, table: Table, origin: Sequence[str] = ORIGIN) -> DataFrame:
    """Rows whose parent is neither stored nor submitted (`parents` holds both); a NULL names none."""
    name, column = table.parent
    orphans = orphan_rows(rows.select(*origin, column), parents, [column], [column])
    return orphans.select(*origin, F.lit(f"{table.name} has no {name}").alias("rule")).distinct()


def findings(
    rows: DataFrame,
    table: Table,
    parents: DataFrame | None = None,
    plain: bool = False,
    origin: Sequence[str] = ORIGIN,
) -> DataFrame:
    """All broken rules of rows submitted to a table."""
    found = [null_findings(rows, table, origin)]
    if plain and table.keys:
        found.append(repeated_findings(rows, table, origin))
    if parents is not None and table.parent:
        found.append(orphan_findings(rows, parents, table, origin))
    return reduce(DataFrame.unionByName, [f for f in found if f is not None])
