"""Decoded frames of activity files: record, split and lap frames -> name/value metrics.

A frame is (activity_id, frame_seq, frame_name, fields); a field has a name, its value as text, the
elements of a list value, the kind of the value and its units. `frame_seq` is the place of the frame
in its file and is unique inside the activity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.functions import checks
from pulsemill.functions.scalars import cast_or_skip, empty_to_null, iso_to_utc_timestamp
from pulsemill.operators.audit import foreign_key_violations
from pulsemill.plans.numbering import number_rows
from pulsemill.plans.skew import skew_join

FIELD = "struct<name: string, value: string, items: array<string>, kind: string, units: string>"
FRAMES = f"activity_id bigint, frame_seq bigint, frame_name string, fields array<{FIELD}>"
NUMERIC_KINDS = ["int", "float", "bool"]
# Frames of one activity that one task numbers; longer files are numbered block by block.
FRAME_BLOCK = 65_536


def running_frame_index(frames: DataFrame, name: str, keys: Sequence[str] = ("activity_id", "frame_name")) -> DataFrame:
    """1-based count of the frames of a kind, in file order."""
    block = F.floor(F.col("frame_seq") / F.lit(FRAME_BLOCK))
    return number_rows(frames, name, ["frame_seq"], [block], keys)


def _number(kind: Column, value: Column) -> Column:
    as_bool = F.when(F.lower(value) == "true", F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(kind == "bool", as_bool).otherwise(value.try_cast("double"))


def record_time() -> Column:
    """The first stated time of a record frame."""
    stated = F.filter("fields", lambda f: (f["name"] == "timestamp") & (f["value"] != ""))
    return iso_to_utc_timestamp(F.get(stated, F.lit(0))["value"])


def has_series() -> Column:
    """The frame gives at least one row of the time series."""
    stored = F.exists(
        "fields",
        lambda f: F.coalesce(
            checks.keep_known_name(f["name"])
            & (f["name"] != "timestamp")
            & f["kind"].isin(*NUMERIC_KINDS)
            & f["value"].isNotNull(),
            F.lit(False),
        ),
    )
    return F.coalesce((F.col("frame_name") == "record") & record_time().isNotNull() & stored, F.lit(False))


def unpivot_record_frames(frames: DataFrame, keep: Sequence[str] = ("activity_id",)) -> DataFrame:
    """(activity, timestamp, name, value, units) of the numeric fields of timed record frames."""
    field = F.col("field")
    return (
        frames.filter(F.col("frame_name") == "record")
        .select("*", F.explode(F.array(record_time())).alias("timestamp"))
        .filter(F.col("timestamp").isNotNull())
        .select(*keep, "timestamp", F.explode("fields").alias("field"))
        .filter(checks.keep_known_name(field["name"]) & (field["name"] != "timestamp"))
        .filter(field["kind"].isin(*NUMERIC_KINDS) & field["value"].isNotNull())
        .select(
            *keep,
            "timestamp",
            field["name"].alias("name"),
            _number(field["kind"], field["value"]).alias("value"),
            empty_to_null(field["units"]).alias("units"),
        )
    )


def _readable_values(field: Column) -> Column:
    """(name, value) entries of a field. A list gives name_1, name_2, ...; NULL elements are counted
    but not stored, and reading stops at the first element that is not a number."""
    entries = F.transform(
        field["items"],
        lambda item, i: F.struct(
            F.concat(field["name"], F.lit("_"), (i + 1).cast("string")).alias("name"), item.alias("value")
        ),
    )
    wrong = F.transform(entries, lambda e: e["value"].isNotNull() & cast_or_skip(e["value"]).isNull())
    first_wrong = F.array_position(wrong, True)
    good = F.when(first_wrong == 0, entries).otherwise(F.slice(entries, F.lit(1), first_wrong.cast("int") - 1))
    single = F.array(F.struct(field["name"].alias("name"), field["value"].alias("value")))
    return F.when(field["items"].isNotNull(), good).otherwise(single)


def split_type() -> Column:
    stated = F.filter("fields", lambda f: (f["name"] == "split_type") & f["value"].isNotNull())
    return F.get(stated, F.lit(0))["value"]


def repeats_a_metric() -> Column:
    """A split or lap frame names one metric twice; its file fails."""
    known = F.filter(
        "fields",
        lambda f: checks.keep_known_name(f["name"])
        & ~((F.col("frame_name") == "split") & (f["name"] == "split_type")),
    )
    entries = F.flatten(F.transform(known, _readable_values))
    names = F.transform(F.filter(entries, lambda e: cast_or_skip(e["value"]).isNotNull()), lambda e: e["name"])
    repeated = F.size(names) != F.size(F.array_distinct(names))
    return F.coalesce(F.col("frame_name").isin("split", "lap") & repeated, F.lit(False))


def _unpivot_indexed(frames: DataFrame, kind: str, index: str, keep: Sequence[str]) -> DataFrame:
    field, entry = F.col("field"), F.col("entry")
    counted = running_frame_index(frames.filter(F.col("frame_name") == kind), index, [*keep, "frame_name"])
    return (
        counted.withColumn("split_type", split_type())
        .select(*keep, F.col(index).cast("int").alias(index), "split_type", F.explode("fields").alias("field"))
        .filter(checks.keep_known_name(field["name"]))
        .select("*", F.explode(_readable_values(field)).alias("entry"))
        .withColumn("number", cast_or_skip(entry["value"]))
        .filter(F.col("number").isNotNull())
        .select(
            *keep,
            index,
            "split_type",
            field["name"].alias("field_name"),
            entry["name"].alias("name"),
            F.col("number").alias("value"),
            empty_to_null(field["units"]).alias("units"),
        )
    )


def unpivot_split_frames(frames: DataFrame, keep: Sequence[str] = ("activity_id",)) -> DataFrame:
    """Metrics of split frames; every row carries the type of its split."""
    rows = _unpivot_indexed(frames, "split", "split_idx", keep)
    return rows.filter(F.col("field_name") != "split_type").drop("field_name")


def unpivot_lap_frames(frames: DataFrame, keep: Sequence[str] = ("activity_id",)) -> DataFrame:
    return _unpivot_indexed(frames, "lap", "lap_idx", keep).drop("field_name", "split_type")


def require_parent_or_fail(frames: DataFrame, activities: DataFrame) -> DataFrame:
    """Frames whose activity is not stored; their file set fails."""
    return foreign_key_violations(frames, activities, ["activity_id"], ["activity_id"])


def skip_already_loaded(frames: DataFrame, activities: DataFrame) -> DataFrame:
    """Frames of activities whose series are not stored yet."""
    loaded = activities.filter(F.col("ts_data_available")).select("activity_id").distinct()
    return skew_join(frames, loaded, ["activity_id"], "left_anti")
