"""Daily wellness documents: arrays of tuples or objects -> one row per reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.fields import Field
from pulsemill.functions import checks
from pulsemill.functions.scalars import (
    assign_boolean,
    assign_double,
    assign_int,
    empty_to_null,
    epoch_ms_to_timestamp,
    iso_to_instant,
    iso_to_utc_timestamp,
    null_safe_difference,
    parse_date_or_null,
    unfit,
)
from pulsemill.operators.documents import (
    ORDER,
    ORIGIN,
    Decoded,
    any_of,
    any_unfit,
    exists,
    failures,
    parse,
    spread,
    states_key,
    unreadable,
)

TUPLES = "array<array<string>>"
TOTALS = (
    "calendarDate string, moderateMinutes string, vigorousMinutes string, startDayMinutes string, "
    "endDayMinutes string"
)
STEPS = (
    "array<struct<endGMT: string, steps: string, primaryActivityLevel: string, activityLevelConstant: string>>"
)


def _at(values: Column, index: int) -> Column:
    return F.get(values, F.lit(index))


def _bad_ms(ms: Column) -> Column:
    return epoch_ms_to_timestamp(ms).isNull()


def _tuples(docs: DataFrame, *fields: str, more: str = "") -> DataFrame:
    return parse(docs, ", ".join([f"{field} {TUPLES}" for field in fields] + ([more] if more else [])))


def _readings(docs: DataFrame, field: str, length: int, value: Column, keep: Column | None = None) -> DataFrame:
    """Rows (owner, time, value) of tuples of at least `length` elements whose first one is epoch ms."""
    item = F.col("item")
    rows = spread(_tuples(docs, field), F.col(f"doc.{field}")).filter(checks.keep_long_enough(item, length))
    if keep is not None:
        rows = rows.filter(keep)
    return rows.select(
        *ORDER, "user_id", epoch_ms_to_timestamp(_at(item, 0)).alias("timestamp"), value.alias("value")
    )


def _measured_rules(docs: DataFrame, field: str, kind: str, name: str) -> dict[str, Column]:
    """Pairs whose value must be a number; from zero on the time must be readable too."""

    def bad(pair: Column) -> Column:
        long = checks.keep_long_enough(pair, 2)
        value, number = _at(pair, 1), assign_double(_at(pair, 1))
        kept = checks.keep_measured(number)
        return pair.isNull() | (
            long & (number.isNull() | (kept & (_bad_ms(_at(pair, 0)) | unfit(value, kind))))
        )

    return {
        "unreadable document": unreadable(docs),
        f"bad {name} reading": exists(F.col(f"doc.{field}"), bad),
    }


def explode_heart_rate(docs: DataFrame) -> DataFrame:
    """[ms, value] pairs; pairs without a time or a value are dropped."""
    item = F.col("item")
    keep = checks.keep_reading(assign_double(_at(item, 0)), _at(item, 1))
    return _readings(docs, "heartRateValues", 2, assign_int(_at(item, 1)), keep)


def heart_rate_failures(docs: DataFrame) -> DataFrame:
    docs = _tuples(docs, "heartRateValues")

    def bad(pair: Column) -> Column:
        kept = checks.keep_reading(assign_double(_at(pair, 0)), _at(pair, 1))
        return checks.bad_length(pair, 2) | unfit(_at(pair, 0), "double") | (
            kept & (_bad_ms(_at(pair, 0)) | unfit(_at(pair, 1), "int"))
        )

    return failures(
        docs,
        {
            "unreadable document": unreadable(docs),
            "bad heart rate reading": exists(F.col("doc.heartRateValues"), bad),
        },
    )


def explode_stress(docs: DataFrame) -> DataFrame:
    item = F.col("item")
    keep = checks.keep_measured(assign_double(_at(item, 1)))
    return _readings(docs, "stressValuesArray", 2, assign_int(_at(item, 1)), keep)


def explode_body_battery(docs: DataFrame) -> DataFrame:
    """[ms, status, level] triples; a NULL level is a row."""
    return _readings(docs, "bodyBatteryValuesArray", 3, assign_int(_at(F.col("item"), 2)))


def stress_failures(docs: DataFrame) -> DataFrame:
    def bad_level(triple: Column) -> Column:
        long = checks.keep_long_enough(triple, 3)
        return triple.isNull() | (long & (_bad_ms(_at(triple, 0)) | unfit(_at(triple, 2), "int")))

    docs = _tuples(docs, "stressValuesArray", "bodyBatteryValuesArray")
    rules = _measured_rules(docs, "stressValuesArray", "int", "stress")
    rules["bad body battery reading"] = exists(F.col("doc.bodyBatteryValuesArray"), bad_level)
    for field in ("stressValuesArray", "bodyBatteryValuesArray"):
        rules[f"{field} is null"] = F.col(f"doc.{field}").isNull() & states_key(field)
    return failures(docs, rules)


def explode_respiration(docs: DataFrame) -> DataFrame:
    value = assign_double(_at(F.col("item"), 1))
    return _readings(docs, "respirationValuesArray", 2, value, checks.keep_measured(value))


def respiration_failures(docs: DataFrame) -> DataFrame:
    docs = _tuples(docs, "respirationValuesArray")
    return failures(docs, _measured_rules(docs, "respirationValuesArray", "double", "respiration"))


def explode_intensity_minutes(docs: DataFrame) -> DataFrame:
    value = assign_double(_at(F.col("item"), 1))
    return _readings(docs, "imValuesArray", 2, value, checks.keep_measured(value))


def project_intensity_totals(docs: DataFrame) -> DataFrame:
    """Daily minutes of a dated document, if any of them is known."""
    doc = F.col("doc")
    total = null_safe_difference(assign_int(doc["endDayMinutes"]), assign_int(doc["startDayMinutes"]))
    return (
        parse(docs, TOTALS)
        .filter(empty_to_null(doc["calendarDate"]).isNotNull())
        .select(
            *ORIGIN,
            F.lit(0).alias("pos"),
            "user_id",
            parse_date_or_null(doc["calendarDate"]).alias("date"),
            assign_int(doc["moderateMinutes"]).alias("moderate_minutes"),
            assign_int(doc["vigorousMinutes"]).alias("vigorous_minutes"),
            total.alias("total_intensity_minutes"),
        )
        .filter("coalesce(moderate_minutes, vigorous_minutes, total_intensity_minutes) is not null")
    )


_DAY_MINUTES = [
    Field(name, name, "int") for name in ("moderateMinutes", "vigorousMinutes", "startDayMinutes", "endDayMinutes")
]


def intensity_failures(docs: DataFrame) -> DataFrame:
    docs = _tuples(docs, "imValuesArray", more=TOTALS)
    rules = _measured_rules(docs, "imValuesArray", "double", "intensity")
    doc = F.col("doc")
    dated = empty_to_null(doc["calendarDate"]).isNotNull()
    rules["bad intensity date"] = dated & parse_date_or_null(doc["calendarDate"]).isNull()
    rules["bad intensity minutes"] = dated & any_unfit("doc", _DAY_MINUTES)
    return failures(docs, rules)


def explode_floors(docs: DataFrame) -> DataFrame:
    """[start, end, up, down] with ISO times; the end is the time of the row."""
    item = F.col("item")
    rows = spread(_tuples(docs, "floorValuesArray"), F.col("doc.floorValuesArray")).filter(checks.keep_long_enough(item, 4))
    return rows.select(
        *ORDER,
        "user_id",
        iso_to_instant(_at(item, 1)).alias("timestamp"),
        assign_int(_at(item, 2)).alias("ascended"),
        assign_int(_at(item, 3)).alias("descended"),
    )


def floors_failures(docs: DataFrame) -> DataFrame:
    docs = _tuples(docs, "floorValuesArray")

    def bad(values: Column) -> Column:
        long = checks.keep_long_enough(values, 4)
        return values.isNull() | (
            long
            & (iso_to_instant(_at(values, 1)).isNull() | unfit(_at(values, 2), "int") | unfit(_at(values, 3), "int"))
        )

    return failures(
        docs,
        {
            "unreadable document": unreadable(docs),
            "bad floors reading": exists(F.col("doc.floorValuesArray"), bad),
        },
    )


def _step_items(docs: DataFrame) -> DataFrame:
    return docs.withColumn("items", F.from_json("content", STEPS))


def explode_steps(docs: DataFrame) -> DataFrame:
    """Interval objects; those without an end or a count are dropped."""
    item = F.col("item")
    rows = spread(_step_items(docs), F.col("items")).filter(checks.keep_interval(item["endGMT"], item["steps"]))
    return rows.select(
        *ORDER,
        "user_id",
        iso_to_utc_timestamp(item["endGMT"]).alias("timestamp"),
        assign_int(item["steps"]).alias("value"),
        item["primaryActivityLevel"].alias("activity_level"),
        assign_boolean(item["activityLevelConstant"]).alias("activity_level_constant"),
    )


def steps_failures(docs: DataFrame) -> DataFrame:
    docs = _step_items(docs)

    def bad(item: Column) -> Column:
        kept = checks.keep_interval(item["endGMT"], item["steps"])
        return item.isNull() | (
            kept
            & any_of(
                [
                    iso_to_utc_timestamp(item["endGMT"]).isNull(),
                    unfit(item["steps"], "int"),
                    unfit(item["activityLevelConstant"], "boolean"),
                ]
            )
        )

    empty = F.trim(F.col("content")).isin("null", "[]", "{}")
    return failures(
        docs,
        {
            "unreadable document": F.col("items").isNull() & ~empty,
            "bad steps reading": exists(F.col("items"), bad),
        },
    )


def decode_heart_rate(docs: DataFrame) -> Decoded:
    return Decoded({"heart_rate": explode_heart_rate(docs)}, [heart_rate_failures(docs)])


def decode_stress(docs: DataFrame) -> Decoded:
    rows = {"stress": explode_stress(docs), "body_battery": explode_body_battery(docs)}
    return Decoded(rows, [stress_failures(docs)])


def decode_respiration(docs: DataFrame) -> Decoded:
    return Decoded({"respiration": explode_respiration(docs)}, [respiration_failures(docs)])


def decode_intensity(docs: DataFrame) -> Decoded:
    rows = {
        "intensity_minutes": explode_intensity_minutes(docs),
        "training_load.intensity": project_intensity_totals(docs),
    }
    return Decoded(rows, [intensity_failures(docs)])


def decode_floors(docs: DataFrame) -> Decoded:
    return Decoded({"floors": explode_floors(docs)}, [floors_failures(docs)])


def decode_steps(docs: DataFrame) -> Decoded:
    return Decoded({"steps": explode_steps(docs)}, [steps_failures(docs)])
