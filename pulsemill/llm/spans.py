"""Places of pattern matches in a text, by built-in functions.

Matches alternate with the parts of a split at the same pattern, so the lengths of both give every
position. Positions are code points, ends are exclusive. Patterns must not match the empty string.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,kind:int,value:string>>"


def no_spans() -> Column:
    return F.array().cast(SPAN)


def find_spans(
    text: str, pattern: str, kind: int, keep: Callable[[Column], Column], group: int = 0
) -> Column:
    """Leftmost non-overlapping matches whose `group` passes `keep`: (start, end, kind, value of the group)."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.transform(F.split(text, pattern, -1), lambda piece: F.length(piece))
    sizes = F.transform(whole, lambda match: F.length(match))
    # Lengths of a part and the match behind it; the last part has no match.
    steps = F.zip_with(between, sizes, lambda gap, size: F.struct(gap.alias("gap"), size.alias("size")))

    def place(done: Column, step: Column) -> Column:
        start = done["at"] + step["gap"]
        end = start + F.coalesce(step["size"], F.lit(0))
        return F.struct(end.alias("at"), F.concat(done["starts"], F.array(start)).alias("starts"))

    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate(steps, begun, place, lambda done: done["starts"])
    joined = F.arrays_zip(
        F.slice(starts, F.lit(1), F.size(whole)).alias("s"), sizes.alias("n"), part.alias("v")
    )
    rows = F.transform(
        joined,
        lambda m: F.struct(
            m["s"].alias("start"), (m["s"] + m["n"]).alias("end"), F.lit(kind).alias("kind"), m["v"].alias("value")
        ),
    )
    return F.when(F.rlike(F.col(text), F.lit(pattern)), F.filter(rows, lambda r: keep(r["value"]))).otherwise(no_spans())


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (o["end"] > span["start"]))


def listed(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end, joined by commas, in the order of the array."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count_of(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def masked(text: Column, spans: Column, labels: list[str]) -> Column:
    """The text with each span replaced by its label; overlapping spans merge under the first one's."""
    names = F.array(*map(F.lit, labels))

    def step(done: Column, span: Column) -> Column:
        inside = span["start"] < done["at"]
        gap = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        put = F.concat(done["parts"], F.array(gap, F.element_at(names, span["kind"] + 1)))
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"), F.when(inside, done["parts"]).otherwise(put).alias("parts")
        )

    begun = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    ordered = F.array_sort(spans)
    return F.aggregate(
        ordered,
        begun,
        step,
        lambda done: F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text))),
    )
