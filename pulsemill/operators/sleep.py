"""Sleep documents: one session row and five time series that carry the session's id."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill import fields as fl
from pulsemill.functions import checks
from pulsemill.functions.scalars import (
    assign,
    assign_sql,
    epoch_ms_to_timestamp,
    iso_to_utc_timestamp,
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
    struct_ddl,
    unreadable,
)
from pulsemill.plans.skew import skew_join

_TIMES = ["sleepStartTimestampGMT", "sleepEndTimestampGMT", "sleepStartTimestampLocal"]
_SCORE_NAMES = list(dict.fromkeys(name for name, _, _, _ in fl.SLEEP_SCORES))
_NEEDS = {"sleepNeed": "sleep_need", "nextSleepNeed": "next_sleep_need"}

_DAILY = (
    f"{struct_ddl([*_TIMES, *fl.SLEEP_DAILY])}, sleepScores struct<"
    + ", ".join(f"{name}: struct<qualifierKey: string, value: string>" for name in _SCORE_NAMES)
    + ">, "
    + ", ".join(
        f"{need} struct<" + ", ".join(f"{f.json}: string" for f in fl.SLEEP_NEED) + ">" for need in _NEEDS
    )
)
_SUMMARY = ", ".join(f"{f.json}: string" for f in fl.SLEEP_SPO2_SUMMARY)

# Table -> (array of the document, time field, value field, value kind, column).
SERIES = {
    "sleep_movement": ("sleepMovement", "startGMT", "activityLevel", "double", "activity_level"),
    "sleep_restless_moment": ("sleepRestlessMoments", "startGMT", "value", "int", "value"),
    "spo2": ("wellnessEpochSPO2DataDTOList", "epochTimestamp", "spo2Reading", "int", "value"),
    "hrv": ("hrvData", "startGMT", "value", "double", "value"),
    "breathing_disruption": ("breathingDisruptionData", "startGMT", "value", "int", "value"),
}
# Series whose times are ISO texts; the others count milliseconds.
ISO_SERIES = ["sleep_movement", "spo2"]

SESSION = (
    f"dailySleepDTO struct<{_DAILY}>, wellnessSpO2SleepSummaryDTO struct<{_SUMMARY}>, " + struct_ddl(fl.SLEEP_ROOT)
)


def _elements(tables: Iterable[str]) -> str:
    return ", ".join(f"{SERIES[table][0]} array<map<string,string>>" for table in tables)


_DTO = "doc.dailySleepDTO"


def _daily() -> Column:
    return F.col(_DTO)


def _has_session() -> Column:
    """Both GMT times are stated; otherwise the document gives no rows and no failure."""
    daily = _daily()
    return daily["sleepStartTimestampGMT"].isNotNull() & daily["sleepEndTimestampGMT"].isNotNull()


def sleep_key(user_id: Column, start_ts: Column) -> Column:
    """Session id that every retry and every writer derives alike."""
    return F.xxhash64(user_id, start_ts)


def nested_parts(path: str, parts: list[tuple[str, str, str, str]]) -> list[Column]:
    """(object, part, column, kind) -> flat columns; an absent object gives NULLs."""
    return [F.expr(assign_sql(f"{path}.{obj}.{part}", kind)).alias(column) for obj, part, column, kind in parts]


def project_sleep_session(docs: DataFrame) -> DataFrame:
    """The session row. Root values replace those inside the session, also when they are NULL."""
    docs = parse(docs, SESSION)
    daily = _daily()
    start = epoch_ms_to_timestamp(daily["sleepStartTimestampGMT"])
    local = epoch_ms_to_timestamp(daily["sleepStartTimestampLocal"])
    needs = [
        column.alias(f"{prefix}_{f.column}")
        for need, prefix in _NEEDS.items()
        for f, column in zip(fl.SLEEP_NEED, columns_of(f"{_DTO}.{need}", fl.SLEEP_NEED))
    ]
    return docs.filter(_has_session()).select(
        *ORIGIN,
        F.lit(0).alias("pos"),
        sleep_key(F.col("user_id"), start).alias("sleep_id"),
        "user_id",
        start.alias("start_ts"),
        epoch_ms_to_timestamp(daily["sleepEndTimestampGMT"]).alias("end_ts"),
        timezone_offset_hours(local, start).alias("timezone_offset_hours"),
        *columns_of(_DTO, fl.SLEEP_DAILY),
        *nested_parts(f"{_DTO}.sleepScores", fl.SLEEP_SCORES),
        *needs,
        *columns_of("doc.wellnessSpO2SleepSummaryDTO", fl.SLEEP_SPO2_SUMMARY),
        *columns_of("doc", fl.SLEEP_ROOT),
    )


def explode_sleep_series(docs: DataFrame, table: str) -> DataFrame:
    """One row per timed element of the table's array, keyed by the session id."""
    array, time_field, value_field, kind, column = SERIES[table]
    start = epoch_ms_to_timestamp(_daily()["sleepStartTimestampGMT"])
    rows = (
        parse(docs, f"dailySleepDTO struct<{struct_ddl(_TIMES)}>, {_elements([table])}")
        .filter(_has_session())
        .withColumn("sleep_id", sleep_key(F.col("user_id"), start))
        .select(*ORIGIN, "sleep_id", F.posexplode(F.col(f"doc.{array}")).alias("pos", "item"))
    )
    stated = F.col("item")[time_field]
    keep, time = _time_rules(table, stated)
    return rows.filter(keep).select(
        *ORDER, "sleep_id", time.alias("timestamp"), assign(F.col("item")[value_field], kind).alias(column)
    )


def _time_rules(table: str, stated: Column) -> tuple[Column, Column]:
    if table in ISO_SERIES:
        return checks.keep_timed_text(stated), iso_to_utc_timestamp(stated)
    return checks.keep_timed(stated.try_cast("double")), epoch_ms_to_timestamp(stated)


def explode_sleep_movement(docs: DataFrame) -> DataFrame:
    return explode_sleep_series(docs, "sleep_movement")


def explode_restless_moments(docs: DataFrame) -> DataFrame:
    return explode_sleep_series(docs, "sleep_restless_moment")


def explode_spo2(docs: DataFrame) -> DataFrame:
    return explode_sleep_series(docs, "spo2")


def explode_hrv(docs: DataFrame) -> DataFrame:
    return explode_sleep_series(docs, "hrv")


def explode_breathing_disruption(docs: DataFrame) -> DataFrame:
    return explode_sleep_series(docs, "breathing_disruption")


def _bad_element(table: str) -> Callable[[Column], Column]:
    _, time_field, value_field, kind, _ = SERIES[table]

    def bad(item: Column) -> Column:
        keep, time = _time_rules(table, item[time_field])
        return any_of(
            [
                item.isNull(),
                ~F.map_contains_key(item, time_field),
                keep & time.isNull(),
                keep & unfit(item[value_field], kind),
            ]
        )

    return bad


def sleep_failures(docs: DataFrame) -> DataFrame:
    """A session needs its three time keys and a local start; objects may be absent but not NULL."""
    docs = parse(docs, f"{SESSION}, {_elements(SERIES)}")
    daily = _daily()
    whole = F.try_parse_json("content")

    def null_object(path: str) -> Column:
        return F.is_variant_null(F.try_variant_get(whole, path, "variant"))

    text = F.get_json_object("content", "$.dailySleepDTO")
    present = F.coalesce(F.size(F.json_object_keys(text)) > 0, F.lit(False))
    objects = ["sleepScores", *_NEEDS, *[f"sleepScores.{name}" for name in _SCORE_NAMES]]
    rules = {
        "unreadable document": unreadable(docs),
        "sleep time missing": present & ~checks.has_keys(text, _TIMES),
        "local sleep start is null": present & _has_session() & daily["sleepStartTimestampLocal"].isNull(),
        "bad sleep time": present & _has_session() & any_of([unfit(daily[t], "double") for t in _TIMES]),
        "sleep object is null": present
        & _has_session()
        & any_of(
            [null_object(f"$.dailySleepDTO.{path}") for path in objects]
            + [null_object("$.wellnessSpO2SleepSummaryDTO")]
        ),
        "bad sleep value": _has_session()
        & any_of(
            [any_unfit(_DTO, fl.SLEEP_DAILY), any_unfit("doc", fl.SLEEP_ROOT)]
            + [any_unfit("doc.wellnessSpO2SleepSummaryDTO", fl.SLEEP_SPO2_SUMMARY)]
            + [any_unfit(f"{_DTO}.{need}", fl.SLEEP_NEED) for need in _NEEDS]
            + [any_unfit(f"{_DTO}.sleepScores.{o}", [fl.Field(p, c, k)]) for o, p, c, k in fl.SLEEP_SCORES]
        ),
    }
    for table, (array, *_) in SERIES.items():
        rules[f"bad {table} element"] = _has_session() & exists(F.col(f"doc.{array}"), _bad_element(table))
    return failures(docs, rules)


def resolve_surrogate_key(
    children: DataFrame, sessions: DataFrame, keys: list[str], surrogate: str
) -> DataFrame:
    """Give child rows the id of their stored session; a session may have very many children."""
    lookup = sessions.select(*keys, surrogate)
    return skew_join(children, lookup, keys, "inner")


def decode_sleep(docs: DataFrame) -> Decoded:
    rows = {"sleep": project_sleep_session(docs)}
    for table in SERIES:
        rows[table] = explode_sleep_series(docs, table)
    return Decoded(rows, [sleep_failures(docs)])
