"""Training documents: VO2 max, acclimation, load, readiness, personal records, race predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill import fields as fl
from pulsemill.functions import checks
from pulsemill.functions.scalars import (
    assign,
    conditional_null_reference,
    empty_to_null,
    epoch_ms_to_timestamp,
    first_map_entry,
    iso_to_utc_timestamp,
    lookup_label,
    parse_date_or_null,
    timezone_offset_hours,
    unfit,
)
from pulsemill.operators.documents import (
    ORDER,
    ORIGIN,
    Decoded,
    any_of,
    any_unfit,
    columns_of,
    exists,
    failures,
    parse,
    spread,
    struct_ddl,
    unfit_text,
    unreadable,
)
from pulsemill.registry import RECORD_LABELS, RECORDS_WITHOUT_ACTIVITY


def _struct(fields: list, *extra: str) -> str:
    inside = ", ".join([f"{f.json}: string" for f in fields] + list(extra))
    return f"struct<{inside}>"


_VO2 = "struct<calendarDate: string, vo2MaxPreciseValue: string>"
_BALANCE = _struct(fl.LOAD_BALANCE, "calendarDate: string")
_STATUS = _struct(fl.LOAD_STATUS, "calendarDate: string", f"acuteTrainingLoadDTO: {_struct(fl.LOAD_RATIO)}")
_ACCLIMATION = _struct(fl.ACCLIMATION, "calendarDate: string")
_BALANCES = f"mostRecentTrainingLoadBalance struct<metricsTrainingLoadBalanceDTOMap: map<string, {_BALANCE}>>"
_STATUSES = f"mostRecentTrainingStatus struct<latestTrainingStatusData: map<string, {_STATUS}>>"
STATUS = (
    f"mostRecentVO2Max struct<generic: {_VO2}, cycling: {_VO2}, heatAltitudeAcclimation: {_ACCLIMATION}>, "
    f"{_BALANCES}, {_STATUSES}"
)
RACE = f"calendarDate string, {struct_ddl(fl.RACE_TIMES)}"


def _dated(docs: DataFrame, holder: Column, columns: list[Column]) -> DataFrame:
    """One row of a section that states its own date; other documents give none."""
    stated = empty_to_null(holder["calendarDate"])
    return docs.filter(stated.isNotNull()).select(
        *ORIGIN, F.lit(0).alias("pos"), "user_id", parse_date_or_null(stated).alias("date"), *columns
    )


def project_vo2_max(docs: DataFrame, kind: str) -> DataFrame:
    """`kind` is generic or cycling; each has its own date and its own column."""
    docs = parse(docs, f"mostRecentVO2Max struct<{kind}: {_VO2}>")
    holder = F.col(f"doc.mostRecentVO2Max.{kind}")
    value = assign(holder["vo2MaxPreciseValue"], "double").alias(f"vo2_max_{kind}")
    return _dated(docs, holder, [value])


def project_acclimation(docs: DataFrame) -> DataFrame:
    docs = parse(docs, f"mostRecentVO2Max struct<heatAltitudeAcclimation: {_ACCLIMATION}>")
    path = "doc.mostRecentVO2Max.heatAltitudeAcclimation"
    return _dated(docs, F.col(path), columns_of(path, fl.ACCLIMATION))


def _balance() -> Column:
    return first_map_entry(F.col("doc.mostRecentTrainingLoadBalance.metricsTrainingLoadBalanceDTOMap"))


def _status() -> Column:
    return first_map_entry(F.col("doc.mostRecentTrainingStatus.latestTrainingStatusData"))


def project_training_load(docs: DataFrame, group: str) -> DataFrame:
    """`group` is balance or status, both of the first device the document lists."""
    if group == "balance":
        staged = parse(docs, _BALANCES).withColumn("device", _balance())
        return _dated(staged, F.col("device"), columns_of("device", fl.LOAD_BALANCE))
    staged = parse(docs, _STATUSES).withColumn("device", _status())
    ratio = columns_of("device.acuteTrainingLoadDTO", fl.LOAD_RATIO)
    return _dated(staged, F.col("device"), [*ratio, *columns_of("device", fl.LOAD_STATUS)])


def status_failures(docs: DataFrame) -> DataFrame:
    docs = parse(docs, STATUS).withColumns({"balance": _balance(), "status": _status()})
    vo2, balance, status = F.col("doc.mostRecentVO2Max"), F.col("balance"), F.col("status")

    def bad_date(holder: Column) -> Column:
        stated = empty_to_null(holder["calendarDate"])
        return stated.isNotNull() & parse_date_or_null(stated).isNull()

    sections = [vo2["generic"], vo2["cycling"], vo2["heatAltitudeAcclimation"], balance, status]
    return failures(
        docs,
        {
            "unreadable document": unreadable(docs),
            "bad training date": any_of([bad_date(s) for s in sections]),
            "bad training value": any_of(
                [
                    unfit(vo2["generic"]["vo2MaxPreciseValue"], "double"),
                    unfit(vo2["cycling"]["vo2MaxPreciseValue"], "double"),
                    any_unfit("doc.mostRecentVO2Max.heatAltitudeAcclimation", fl.ACCLIMATION),
                    any_unfit("balance", fl.LOAD_BALANCE),
                    any_unfit("status", fl.LOAD_STATUS),
                    any_unfit("status.acuteTrainingLoadDTO", fl.LOAD_RATIO),
                ]
            ),
        },
    )


def decode_training_status(docs: DataFrame) -> Decoded:
    rows = {
        "vo2_max.generic": project_vo2_max(docs, "generic"),
        "vo2_max.cycling": project_vo2_max(docs, "cycling"),
        "acclimation": project_acclimation(docs),
        "training_load.balance": project_training_load(docs, "balance"),
        "training_load.status": project_training_load(docs, "status"),
    }
    return Decoded(rows, [status_failures(docs)])


def _objects(docs: DataFrame) -> DataFrame:
    """Documents that are lists of flat objects: `items`, each a map from name to raw text."""
    return docs.withColumn("items", F.from_json("content", "array<map<string,string>>"))


def _not_a_list() -> Column:
    empty = F.trim(F.col("content")).isin("null", "[]", "{}")
    return F.col("items").isNull() & ~empty


def explode_training_readiness(docs: DataFrame) -> DataFrame:
    """One row per score object that has a time; without a local time the offset is 0.0."""
    item = F.col("item")
    time = iso_to_utc_timestamp(item["timestamp"])
    local = empty_to_null(item["timestampLocal"])
    offset = F.when(local.isNull(), F.lit(0.0)).otherwise(timezone_offset_hours(iso_to_utc_timestamp(local), time))
    return (
        spread(_objects(docs), F.col("items"))
        .filter(checks.keep_timed_text(item["timestamp"]))
        .select(
            *ORDER,
            "user_id",
            time.alias("timestamp"),
            offset.alias("timezone_offset_hours"),
            *columns_of("item", fl.READINESS),
        )
    )


def unknown_keys(item: Column) -> Column:
    """Names of an object that no readiness column takes."""
    known = F.lit([*fl.READINESS_SKIPPED, *[f.json for f in fl.READINESS]])
    return F.array_except(F.map_keys(item), known)


def readiness_failures(docs: DataFrame) -> DataFrame:
    docs = _objects(docs)

    def timed(item: Column) -> Column:
        return checks.keep_timed_text(item["timestamp"])

    def bad_time(item: Column) -> Column:
        local = empty_to_null(item["timestampLocal"])
        unread = iso_to_utc_timestamp(item["timestamp"]).isNull()
        return timed(item) & (unread | (local.isNotNull() & iso_to_utc_timestamp(local).isNull()))

    items = F.col("items")
    times = F.transform(
        F.filter(items, timed), lambda item: F.unix_micros(iso_to_utc_timestamp(item["timestamp"]))
    )
    return failures(
        docs,
        {
            "unreadable document": _not_a_list(),
            "unknown readiness field": exists(items, lambda i: timed(i) & (F.size(unknown_keys(i)) > 0)),
            "bad readiness time": exists(items, bad_time),
            "bad readiness value": F.expr(f"exists(items, i -> i.timestamp <> '' and {unfit_text('i', fl.READINESS)})"),
            "readiness time repeated": F.size(times) != F.size(F.array_distinct(times)),
        },
    )


def decode_training_readiness(docs: DataFrame) -> Decoded:
    return Decoded({"training_readiness": explode_training_readiness(docs)}, [readiness_failures(docs)])


def explode_personal_records(docs: DataFrame) -> DataFrame:
    """One row per record; an unknown type keeps its row without a label, and records of the types
    that belong to no activity lose the reference. Whether the activity exists is decided later."""
    item = F.col("item")
    kind = assign(item["typeId"], "int")
    return spread(_objects(docs), F.col("items")).select(
        *ORDER,
        "user_id",
        conditional_null_reference(assign(item["activityId"], "bigint"), kind, RECORDS_WITHOUT_ACTIVITY).alias(
            "activity_id"
        ),
        epoch_ms_to_timestamp(item["prStartTimeGmt"]).alias("timestamp"),
        kind.alias("type_id"),
        lookup_label(kind, RECORD_LABELS).alias("label"),
        assign(item["value"], "double").alias("value"),
    )


def record_failures(docs: DataFrame) -> DataFrame:
    docs = _objects(docs)
    needed = ["typeId", "activityId", "prStartTimeGmt"]

    def bad(item: Column) -> Column:
        return any_of(
            [
                item.isNull(),
                *[~F.map_contains_key(item, key) for key in needed],
                assign(item["typeId"], "int").isNull(),
                epoch_ms_to_timestamp(item["prStartTimeGmt"]).isNull(),
                unfit(item["activityId"], "bigint"),
                unfit(item["value"], "double"),
            ]
        )

    return failures(
        docs, {"unreadable document": _not_a_list(), "bad personal record": exists(F.col("items"), bad)}
    )


def repeated_record_types(records: DataFrame) -> DataFrame:
    """Documents that give one type twice: both rows would be the latest, so the document fails."""
    counted = records.groupBy(*ORIGIN, "user_id", "type_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1).select(*ORIGIN, F.lit("record type repeated").alias("rule"))


def decode_personal_records(docs: DataFrame) -> Decoded:
    return Decoded({"personal_record": explode_personal_records(docs)}, [record_failures(docs)])


def _has_prediction() -> Column:
    return ~F.trim(F.col("content")).isin("null", "[]", "{}")


def project_race_prediction(docs: DataFrame) -> DataFrame:
    doc = F.col("doc")
    return parse(docs.filter(_has_prediction()), RACE).select(
        *ORIGIN,
        F.lit(0).alias("pos"),
        "user_id",
        parse_date_or_null(doc["calendarDate"]).alias("date"),
        *columns_of("doc", fl.RACE_TIMES),
    )


def race_failures(docs: DataFrame) -> DataFrame:
    docs = parse(docs, RACE)
    doc = F.col("doc")
    return failures(
        docs,
        {
            "unreadable document": _has_prediction() & unreadable(docs),
            "race date missing": _has_prediction() & parse_date_or_null(doc["calendarDate"]).isNull(),
            "bad race time": any_unfit("doc", fl.RACE_TIMES),
        },
    )


def decode_race_predictions(docs: DataFrame) -> Decoded:
    return Decoded({"race_predictions": project_race_prediction(docs)}, [race_failures(docs)])
