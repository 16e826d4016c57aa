"""Row predicates of the decoders. `keep_*` say which rows stay, `bad_*` which rows fail the file."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def keep_measured(value: Column) -> Column:
    """Negative readings mark unmeasurable periods."""
    return value >= 0


def bad_reading(value: Column) -> Column:
    """Stress, respiration and intensity readings must not be NULL."""
    return value.isNull()


def keep_reading(ms: Column, value: Column) -> Column:
    """Heart rate: a real time and a value."""
    return keep_timed(ms) & value.isNotNull()


def keep_interval(end: Column, count: Column) -> Column:
    """Steps: an end time and a count; zero steps count."""
    return keep_timed_text(end) & count.isNotNull()


def keep_timed(ms: Column) -> Column:
    return F.coalesce(ms != 0, F.lit(False))


def keep_timed_text(text: Column) -> Column:
    return F.coalesce(text != "", F.lit(False))


def keep_long_enough(values: Column, length: int) -> Column:
    return F.coalesce(F.size(values) >= length, F.lit(False))


def bad_length(values: Column, length: int) -> Column:
    """Heart-rate tuples must have exactly this length."""
    return F.coalesce(F.size(values) != length, F.lit(True))


def keep_known_name(name: Column) -> Column:
    return F.coalesce(~F.lower(name).contains("unknown"), F.lit(False))


def keep_unlisted(name: Column, names: Iterable[str] = (), parts: Iterable[str] = ()) -> Column:
    """Drop fields by exact name or by a part of the name."""
    names = list(names)
    keep = ~name.isin(*names) if names else F.lit(True)
    for part in parts:
        keep = keep & ~name.contains(part)
    return keep


def keep_flat(variant: Column) -> Column:
    """Objects and lists have no place in the name/value tables."""
    kind = F.schema_of_variant(variant)
    return ~(kind.startswith("OBJECT") | kind.startswith("ARRAY"))


def is_array_text(content: Column) -> Column:
    return F.coalesce(content.rlike(r"^\s*\["), F.lit(False))


def has_keys(content: Column, keys: Iterable[str]) -> Column:
    """TRUE when the JSON object states every key; a stated NULL counts as stated."""
    stated = F.json_object_keys(content)
    wanted = F.array(*[F.lit(k) for k in keys])
    return F.coalesce(F.size(F.array_except(wanted, stated)) == 0, F.lit(False))


def missing_keys(content: Column, keys: Iterable[str]) -> Column:
    wanted = F.array(*[F.lit(k) for k in keys])
    return F.array_except(wanted, F.coalesce(F.json_object_keys(content), F.array().cast("array<string>")))


def sport_branch(type_key: Column) -> Column:
    """running by name, cycling or biking and swimming by part of the name; the first match counts."""
    key = F.lower(type_key)
    return (
        F.when(key == "running", F.lit("running"))
        .when(key.contains("cycling") | key.contains("biking"), F.lit("cycling"))
        .when(key.contains("swimming"), F.lit("swimming"))
        .otherwise(F.lit("other"))
    )
