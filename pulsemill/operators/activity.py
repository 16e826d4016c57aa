"""Activity lists: the activity row, the metrics of its sport, and every other number as name/value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill import fields as fl
from pulsemill.functions import checks
from pulsemill.functions.scalars import (
    assign,
    camel_to_snake,
    derive_end_timestamp,
    iso_to_utc_timestamp,
    numeric_kind,
    timezone_offset_hours,
    unfit,
)
from pulsemill.operators.documents import (
    ORDER,
    Decoded,
    any_of,
    any_unfit,
    columns_of,
    failures,
    parse,
    spread,
    struct_ddl,
)

_TYPE = "struct<typeId: string, typeKey: string>"
_KEYS = f"activityId string, activityType {_TYPE}"
_TIMES = "startTimeGMT string, startTimeLocal string, endTimeGMT string"
_CORE = f"{_KEYS}, eventType {_TYPE}, {_TIMES}, {struct_ddl([*fl.ACTIVITY_REQUIRED, *fl.ACTIVITY_OPTIONAL])}"
_SPORT_FIELDS = list({f.json: f for sport in fl.SPORTS.values() for f in sport}.values())
REQUIRED_KEYS = [*fl.ACTIVITY_KEYS, *[f.json for f in fl.ACTIVITY_REQUIRED]]

_CONSUMED = [
    *REQUIRED_KEYS,
    "endTimeGMT",
    *[f.json for f in fl.ACTIVITY_OPTIONAL],
]


def split_list(docs: DataFrame) -> DataFrame:
    """One row per list element: `text`, the element as JSON."""
    return spread(docs, F.from_json("content", "array<string>"), "text")


def _read(activities: DataFrame, ddl: str) -> DataFrame:
    """Add `act`, the named fields of the element as text."""
    return parse(activities, ddl, "text", "act")


def _sport() -> Column:
    return checks.sport_branch(F.coalesce(F.col("act.activityType.typeKey"), F.lit("")))


def _start() -> Column:
    return iso_to_utc_timestamp(F.col("act.startTimeGMT"))


def _end() -> Column:
    act = F.col("act")
    stated = act["endTimeGMT"]
    derived = derive_end_timestamp(F.lit(None).cast("timestamp"), _start(), assign(act["duration"], "double"))
    return F.when(stated.isNotNull(), iso_to_utc_timestamp(stated)).otherwise(derived)


def explode_activities(activities: DataFrame) -> DataFrame:
    """The activity row; a missing end time is start plus duration."""
    act = F.col("act")
    return _read(activities, _CORE).select(
        *ORDER,
        assign(act["activityId"], "bigint").alias("activity_id"),
        "user_id",
        assign(act["activityType"]["typeId"], "int").alias("activity_type_id"),
        act["activityType"]["typeKey"].alias("activity_type_key"),
        assign(act["eventType"]["typeId"], "int").alias("event_type_id"),
        act["eventType"]["typeKey"].alias("event_type_key"),
        _start().alias("start_ts"),
        _end().alias("end_ts"),
        timezone_offset_hours(iso_to_utc_timestamp(act["startTimeLocal"]), _start()).alias("timezone_offset_hours"),
        *columns_of("act", fl.ACTIVITY_REQUIRED),
        *columns_of("act", fl.ACTIVITY_OPTIONAL),
        F.lit(False).alias("ts_data_available"),
    )


def project_sport_metrics(activities: DataFrame, sport: str) -> DataFrame:
    """Metrics of the activities of one sport."""
    rows = _read(activities, f"{_KEYS}, {struct_ddl(fl.SPORTS[sport])}").filter(_sport() == sport)
    identity = assign(F.col("act.activityId"), "bigint").alias("activity_id")
    return rows.select(*ORDER, identity, *columns_of("act", fl.SPORTS[sport]))


def consumed(name: Column, sport: Column) -> Column:
    """The activity row or the metrics of the sport already hold the field."""
    taken = name.isin(*_CONSUMED)
    for key, fields in fl.SPORTS.items():
        taken = taken | ((sport == key) & name.isin(*[f.json for f in fields]))
    return taken


def unpivot_residual_metrics(activities: DataFrame) -> DataFrame:
    """Every number or boolean that nothing else stored, as (activity, metric, value)."""
    sorted_out = _read(activities, _KEYS).select(
        F.struct(*ORDER).alias("origin"),
        assign(F.col("act.activityId"), "bigint").alias("activity_id"),
        _sport().alias("sport"),
        F.try_parse_json("text").alias("whole"),
    )
    entry = activities.sparkSession.tvf.variant_explode(F.col("whole").outer())
    entries = sorted_out.lateralJoin(entry).select(
        "origin.*", "activity_id", "sport", "key", F.col("value").alias("entry")
    )
    return (
        entries.filter(~consumed(F.col("key"), F.col("sport")))
        .filter(checks.keep_unlisted(F.col("key"), parts=["ownerProfileImageUrl"]))
        .filter(numeric_kind(F.col("entry")))
        .withColumn("number", F.try_variant_get("entry", "$", "double"))
        .select(*ORDER, "activity_id", camel_to_snake(F.col("key")).alias("metric"), F.col("number").alias("value"))
    )


def activity_failures(docs: DataFrame, activities: DataFrame) -> DataFrame:
    activities = _read(activities, f"{_CORE}, {struct_ddl(_SPORT_FIELDS)}")
    act = F.col("act")
    sports = any_of(
        [
            (checks.sport_branch(act["activityType"]["typeKey"]) == sport) & any_unfit("act", fields)
            for sport, fields in fl.SPORTS.items()
        ]
    )
    is_list = checks.is_array_text(F.col("content"))
    of_docs = failures(
        docs,
        {
            "activities document is not an array": ~is_list,
            "unreadable document": is_list & F.from_json("content", "array<string>").isNull(),
        },
    )
    flags = [F.col("act")[f.json].isNull() for f in fl.ACTIVITY_REQUIRED]
    types = [act[o][p].isNull() for o in ("activityType", "eventType") for p in ("typeId", "typeKey")]
    of_items = failures(
        activities,
        {
            "activity field missing": ~checks.has_keys(F.col("text"), REQUIRED_KEYS),
            "activity field is null": any_of([act["activityId"].isNull(), *types, *flags]),
            "bad activity time": any_of(
                [_start().isNull(), _end().isNull(), iso_to_utc_timestamp(act["startTimeLocal"]).isNull()]
            ),
            "bad activity value": any_of(
                [
                    unfit(act["activityId"], "bigint"),
                    unfit(act["activityType"]["typeId"], "int"),
                    unfit(act["eventType"]["typeId"], "int"),
                    any_unfit("act", fl.ACTIVITY_REQUIRED),
                    any_unfit("act", fl.ACTIVITY_OPTIONAL),
                    sports,
                ]
            ),
        },
    )
    return of_docs.unionByName(of_items)


def decode_activities(docs: DataFrame) -> Decoded:
    activities = split_list(docs)
    rows = {"activity": explode_activities(activities)}
    for sport in fl.SPORTS:
        rows[f"{sport}_agg_metrics"] = project_sport_metrics(activities, sport)
    rows["supplemental_activity_metric"] = unpivot_residual_metrics(activities)
    return Decoded(rows, [activity_failures(docs, activities)])
