"""What all document decoders share: the document frame, JSON parsing, failures."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.fields import Field
from pulsemill.functions.scalars import assign_sql, unfit_sql

# Where a row comes from, and with `pos` the total order in which writes take effect.
ORIGIN = ["file_set_ts", "type_rank", "file_name"]
ORDER = [*ORIGIN, "pos"]

CORRUPT = "_unreadable"


@dataclass
class Decoded:
    """Rows per table and the files that must fail, each with the rule it broke."""

    rows: dict[str, DataFrame] = field(default_factory=dict)
    failures: list[DataFrame] = field(default_factory=list)


def parse(docs: DataFrame, ddl: str, source: str = "content", name: str = "doc") -> DataFrame:
    """Add `doc`, the content read with a schema. Leaves are read as text, so that a value of the
    wrong kind is noticed by `unfit` and does not silently become NULL.

    The parse is the input of a one-element explode: filters on its fields cannot be pushed below a
    generator, so each document is parsed once. Every caller names only the fields it needs.
    """
    options = {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"}
    parsed = F.from_json(source, f"{ddl}, {CORRUPT} string", options)
    return docs.select("*", F.explode(F.array(parsed)).alias(name))


def struct_ddl(fields: Iterable[Field | str]) -> str:
    """Text-leaved schema of the named fields."""
    names = [f if isinstance(f, str) else f.json for f in fields]
    return ", ".join(f"`{name}` string" for name in names)


def columns_of(path: str, fields: Iterable[Field]) -> list[Column]:
    """The fields below `path`, a struct or a map of raw texts, as typed columns."""
    return [F.expr(assign_sql(f"{path}.`{f.json}`", f.kind)).alias(f.column) for f in fields]


def unfit_text(path: str, fields: Iterable[Field]) -> str:
    tests = [unfit_sql(f"{path}.`{f.json}`", f.kind) for f in fields if f.kind != "string"]
    return "(" + " or ".join(tests or ["false"]) + ")"


def any_unfit(path: str, fields: Iterable[Field]) -> Column:
    return F.expr(unfit_text(path, fields))


def any_of(conditions: Iterable[Column]) -> Column:
    """NULL counts as false."""
    checked = [F.coalesce(c, F.lit(False)) for c in conditions]
    return reduce(lambda a, b: a | b, checked, F.lit(False))


def unreadable(docs: DataFrame) -> Column:
    return F.col(f"doc.{CORRUPT}").isNotNull()


def states_key(key: str) -> Column:
    """The document states this key at its top level, be it NULL."""
    return F.coalesce(F.array_contains(F.json_object_keys("content"), key), F.lit(False))


def failures(docs: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per broken rule of a document: origin, rule."""
    broken = F.array_compact(
        F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(rule)) for rule, cond in rules.items()])
    )
    return docs.select(*ORIGIN, F.explode(broken).alias("rule"))


def spread(docs: DataFrame, items: Column, name: str = "item") -> DataFrame:
    """One row per array element with its position; a NULL or empty array gives no row."""
    return docs.select(*ORIGIN, "user_id", F.posexplode(items).alias("pos", name))


def exists(items: Column, test: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.exists(items, lambda x: F.coalesce(test(x), F.lit(False))), F.lit(False))
