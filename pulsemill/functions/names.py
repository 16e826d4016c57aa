"""File names: parsing, classification, time stamps, and building them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsemill.functions.scalars import iso_to_instant
from pulsemill.registry import DATA_TYPES, extension

# The formats of file names and of the time inside a name.
NAME_PATTERN = r"^(\d+)_([A-Z_]+)(?:_\d+)?_([0-9T:\-Z\.]+)\.(json|fit)$"
ACTIVITY_NAME_PATTERN = r"^(\d+)_ACTIVITY_(\d+)_([0-9T:\-Z\.]+)\.fit$"
TIME_PATTERN = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?(?:[+-]\d{2}:\d{2}|Z)?"


def parse_filename(name: Column) -> dict[str, Column]:
    """user_id, data_type, file_time and file_extension; all NULL when the name does not fit."""
    fits = name.rlike(NAME_PATTERN)

    def part(group: int) -> Column:
        return F.when(fits, F.regexp_extract(name, NAME_PATTERN, group))

    return {
        "user_id": part(1).try_cast("bigint"),
        "data_type": part(2),
        "file_time": part(3),
        "file_extension": part(4),
    }


def parse_activity_filename(name: Column) -> Column:
    """Activity id of an activity file name, else NULL."""
    return F.when(
        name.rlike(ACTIVITY_NAME_PATTERN), F.regexp_extract(name, ACTIVITY_NAME_PATTERN, 2).try_cast("bigint")
    )


def classify_file_type(name: Column, patterns: Mapping[str, str]) -> Column:
    """First type whose pattern is found in the name, else NULL."""
    kind = F.lit(None).cast("string")
    for type_name in reversed(patterns):
        kind = F.when(name.rlike(patterns[type_name]), F.lit(type_name)).otherwise(kind)
    return kind


def registered_type(name: Column) -> Column:
    """`classify_file_type` for the registered types: their pattern is a part of the name and its
    ending, and searching for two plain texts is far cheaper than searching for a pattern."""
    kind = F.lit(None).cast("string")
    for type_name in reversed(DATA_TYPES):
        found = name.contains(f"_{type_name}_") & name.endswith(f".{extension(type_name)}")
        kind = F.when(found, F.lit(type_name)).otherwise(kind)
    return kind


def extract_file_timestamp(name: Column, mtime: Column, path: Column) -> Column:
    """Time stated in the name, else the modification time plus up to a second taken from a hash of
    the path, so that unrelated files do not share a set and a retry gives the same answer."""
    stated = F.regexp_extract(name, TIME_PATTERN, 0)
    jitter = F.pmod(F.xxhash64(path), F.lit(1_000_000))
    return F.coalesce(
        F.when(stated != "", iso_to_instant(stated)), F.timestamp_micros(F.unix_micros(mtime) + jitter)
    )


def standard_file_name(user_id: Column, data_type: str | Column, day: Column) -> Column:
    """{user}_{TYPE}_{day}T12:00:00Z.json"""
    kind = F.lit(data_type) if isinstance(data_type, str) else data_type
    return F.concat_ws("_", user_id.cast("string"), kind, _noon(day, "json"))


def activity_file_name(user_id: Column, activity_id: Column, local_day: Column) -> Column:
    """{user}_ACTIVITY_{id}_{local start day}T12:00:00Z.fit"""
    return F.concat_ws(
        "_", user_id.cast("string"), F.lit("ACTIVITY"), activity_id.cast("string"), _noon(local_day, "fit")
    )


def _noon(day: Column, extension: str) -> Column:
    return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(f"T12:00:00Z.{extension}"))
