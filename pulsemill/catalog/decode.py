"""Queries: documents and frames built from the given tables, decoded into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill import fields as fl
from pulsemill.catalog.base import Tables, as_docs, filled, filled_sql, millis, ntz, over_all_cores, query
from pulsemill.operators import activity, frames, profile, sleep, training, wellness
from pulsemill.registry import RECORD_LABELS

MS = "(epoch_us(ts) // 1000)"
VALUE = "cast(floor(value) as integer)"


def _int_value() -> Column:
    return F.floor("value").cast("bigint")


def _reading(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", millis("timestamp").alias("ts_ms"), "value")


@query(f"""
select user_id, {MS} as ts_ms, {VALUE} as value from events
union all select user_id, {MS} + 2000, {VALUE} + 1 from events
""")
def explode_heart_rate(t: Tables) -> DataFrame:
    ms, value = millis("ts"), _int_value()
    pairs = F.array(
        F.array(ms, value),
        F.array(ms + 1000, F.lit(None).cast("bigint")),
        F.array(F.lit(0).cast("bigint"), value),
        F.array(ms + 2000, value + 1),
    )
    docs = as_docs(t.events, F.to_json(F.struct(pairs.alias("heartRateValues"))), "user_id")
    return _reading(wellness.explode_heart_rate(docs))


@query(f"select user_id, {MS} as ts_ms, {VALUE} - 50 as value from events where floor(value) >= 50")
def explode_stress(t: Tables) -> DataFrame:
    pairs = F.array(F.array(millis("ts"), _int_value() - 50), F.array(millis("ts")))
    docs = as_docs(t.events, F.to_json(F.struct(pairs.alias("stressValuesArray"))), "user_id")
    return _reading(wellness.explode_stress(docs))


@query(f"""
select user_id, {MS} as ts_ms, {VALUE} as value from events
union all select user_id, {MS} + 1000, null from events
""")
def explode_body_battery(t: Tables) -> DataFrame:
    content = F.format_string(
        '{"bodyBatteryValuesArray": [[%d, "MEASURED", %d, 1.5], [%d, 7, null], [5, 6]]}',
        millis("ts"),
        _int_value(),
        millis("ts") + 1000,
    )
    docs = as_docs(t.events, content, "user_id")
    return _reading(wellness.explode_body_battery(docs))


def _double_pairs(t: Tables, name: str) -> DataFrame:
    pairs = F.array(F.array(millis("ts").cast("double"), F.col("value") - 50), F.array(F.lit(1.0)))
    return as_docs(t.events, F.to_json(F.struct(pairs.alias(name))), "user_id")


@query(f"select user_id, {MS} as ts_ms, value - 50 as value from events where value >= 50")
def explode_respiration(t: Tables) -> DataFrame:
    docs = _double_pairs(t, "respirationValuesArray")
    return _reading(wellness.explode_respiration(docs))


@query(f"select user_id, {MS} as ts_ms, value - 50 as value from events where value >= 50")
def explode_intensity_minutes(t: Tables) -> DataFrame:
    docs = _double_pairs(t, "imValuesArray")
    return _reading(wellness.explode_intensity_minutes(docs))


@query("""
select l_orderkey as user_id, l_shipdate + interval 15 minute as ts, l_linenumber as ascended,
  cast(l_quantity as integer) as descended
from lineitem
""")
def explode_floors(t: Tables) -> DataFrame:
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    content = F.format_string(
        '{"floorValuesArray": [["%sT00:00:00.0", "%sT00:15:00.0", %d, %d], ["%sT01:00:00.0"]]}',
        day,
        day,
        F.col("l_linenumber"),
        F.col("l_quantity").cast("int"),
        day,
    )
    docs = as_docs(t.lineitem, content, "l_orderkey")
    rows = wellness.explode_floors(docs)
    return rows.select("user_id", ntz(F.col("timestamp")).alias("ts"), "ascended", "descended")


@query(f"""
select user_id, date_trunc('second', ts) as ts, case when value < 20 then 0 else {VALUE} end as value,
  event_type as activity_level, event_type = 'click' as activity_level_constant
from events where value >= 10
""")
def explode_steps(t: Tables) -> DataFrame:
    steps = F.when(F.col("value") >= 20, _int_value()).when(F.col("value") >= 10, F.lit(0))
    end = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    item = F.struct(
        end.alias("endGMT"),
        steps.alias("steps"),
        F.col("event_type").alias("primaryActivityLevel"),
        (F.col("event_type") == "click").alias("activityLevelConstant"),
    )
    docs = as_docs(t.events, F.to_json(F.array(item)), "user_id")
    return wellness.explode_steps(docs).select(
        "user_id", ntz(F.col("timestamp")).alias("ts"), "value", "activity_level", "activity_level_constant"
    )


def _sleep_docs(t: Tables) -> DataFrame:
    """Every event as a night that starts with it, with two elements per series, one without time."""
    ms = millis("ts")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    none = F.lit(None)

    def series(time_name: str, time: Column, value_name: str, value: Column) -> Column:
        timed = F.struct(time.alias(time_name), value.alias(value_name))
        untimed = F.struct(none.cast(time_type(time_name)).alias(time_name), value.alias(value_name))
        return F.array(timed, untimed)

    def time_type(name: str) -> str:
        return "string" if name == "epochTimestamp" else "bigint"

    movement = F.array(
        F.struct(iso.alias("startGMT"), F.col("value").alias("activityLevel")),
        F.struct(F.lit("").alias("startGMT"), F.lit(0.5).alias("activityLevel")),
    )
    times = F.struct(
        ms.alias("sleepStartTimestampGMT"),
        (ms + 3_600_000).alias("sleepEndTimestampGMT"),
        (ms + 5_400_000).alias("sleepStartTimestampLocal"),
    )
    content = F.to_json(
        F.struct(
            times.alias("dailySleepDTO"),
            movement.alias("sleepMovement"),
            series("startGMT", ms + 60_000, "value", _int_value()).alias("sleepRestlessMoments"),
            series("epochTimestamp", iso, "spo2Reading", _int_value()).alias("wellnessEpochSPO2DataDTOList"),
            series("startGMT", ms + 300_000, "value", F.col("value")).alias("hrvData"),
            series("startGMT", ms + 600_000, "value", _int_value()).alias("breathingDisruptionData"),
        ),
        {"ignoreNullFields": "false"},
    )
    return as_docs(t.events, content, "user_id")


def _series_of_sessions(t: Tables, table: str, column: str = "value") -> DataFrame:
    docs = _sleep_docs(t)
    sessions = sleep.project_sleep_session(docs).select("sleep_id", "user_id", "start_ts")
    rows = sleep.explode_sleep_series(docs, table).drop("file_set_ts", "type_rank", "file_name", "pos")
    return rows.join(sessions, "sleep_id").select(
        "user_id", millis("start_ts").alias("start_ms"), millis("timestamp").alias("ts_ms"), column
    )


_SECOND_MS = "(epoch_us(ts) // 1000000 * 1000)"


@query(f"select user_id, {MS} as start_ms, {_SECOND_MS} as ts_ms, value as activity_level from events")
def explode_sleep_movement(t: Tables) -> DataFrame:
    return _series_of_sessions(t, "sleep_movement", "activity_level")


@query(f"select user_id, {MS} as start_ms, {MS} + 60000 as ts_ms, {VALUE} as value from events")
def explode_restless_moments(t: Tables) -> DataFrame:
    return _series_of_sessions(t, "sleep_restless_moment")


@query(f"select user_id, {MS} as start_ms, {_SECOND_MS} as ts_ms, {VALUE} as value from events")
def explode_spo2(t: Tables) -> DataFrame:
    return _series_of_sessions(t, "spo2")


@query(f"select user_id, {MS} as start_ms, {MS} + 300000 as ts_ms, value from events")
def explode_hrv(t: Tables) -> DataFrame:
    return _series_of_sessions(t, "hrv")


@query(f"select user_id, {MS} as start_ms, {MS} + 600000 as ts_ms, {VALUE} as value from events")
def explode_breathing_disruption(t: Tables) -> DataFrame:
    return _series_of_sessions(t, "breathing_disruption")


# Activities: every order is one.

_SPORT_SQL = "case o_orderstatus when 'F' then 'running' when 'O' then 'road_Cycling' else 'lap_swimming' end"
_PRIORITY_NO = "cast(substr(o_orderpriority, 1, 1) as integer)"


def _activity_list(t: Tables, fields: list[fl.Field] | None = None) -> DataFrame:
    """One activity per order, with a value for every one of `fields` or with a mix of known and unknown ones."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    rank = F.expr("cast(substr(o_orderpriority, 1, 1) as int)")
    ended = F.when(F.col("o_orderstatus") != "P", F.concat(day, F.lit("T02:00:00.0")))
    kind = F.struct(rank.alias("typeId"), F.expr(_SPORT_SQL).alias("typeKey"))
    mixed = [
        *[(rank == 1).alias(f.json) for f in fl.ACTIVITY_REQUIRED],
        F.col("o_orderpriority").alias("activityName"),
        F.col("o_totalprice").alias("averageHR"),
        F.col("o_custkey").alias("steps"),
        F.col("o_custkey").alias("strokes"),
        F.col("o_totalprice").alias("normPower"),
        rank.alias("maxAvgPower_20"),
        rank.alias("averageSwolf"),
        rank.alias("minTemperature"),
        F.col("o_totalprice").alias("extraValue"),
        (rank == 2).alias("extraFlag"),
        F.col("o_orderstatus").alias("extraText"),
        F.array(rank).alias("extraList"),
        rank.alias("ownerProfileImageUrlLarge"),
    ]
    item = F.struct(
        F.col("o_orderkey").alias("activityId"),
        kind.alias("activityType"),
        F.struct(rank.alias("typeId"), F.col("o_orderstatus").alias("typeKey")).alias("eventType"),
        F.concat(day, F.lit(" 00:00:00")).alias("startTimeGMT"),
        F.concat(day, F.lit("T05:30:00.0")).alias("startTimeLocal"),
        ended.alias("endTimeGMT"),
        (rank * 60.5).alias("duration"),
        *(mixed if fields is None else _of_orders(fields)),
    )
    return activity.split_list(as_docs(t.orders, F.to_json(F.array(item)), "o_custkey"))


_ORDER_VALUES = ("o_totalprice", "o_orderkey", "o_orderstatus")


def _of_orders(fields: list[fl.Field]) -> list[Column]:
    return filled(fields, *map(F.col, _ORDER_VALUES))


def _of_orders_sql(fields: list[fl.Field]) -> str:
    return filled_sql(fields, *_ORDER_VALUES)


_ACTIVITY = [*fl.ACTIVITY_REQUIRED, *[f for f in fl.ACTIVITY_OPTIONAL if f.json != "duration"]]


@query(f"""
select o_orderkey as activity_id, o_custkey as user_id, {_PRIORITY_NO} as activity_type_id,
  {_SPORT_SQL} as activity_type_key, {_PRIORITY_NO} as event_type_id, o_orderstatus as event_type_key,
  o_orderdate as start_ts,
  case when o_orderstatus <> 'P' then o_orderdate + interval 2 hour
    else o_orderdate + to_microseconds({_PRIORITY_NO} * 60500000) end as end_ts,
  5.5::double as timezone_offset_hours, {_PRIORITY_NO} * 60.5::double as duration,
  {_of_orders_sql(_ACTIVITY)}, false as ts_data_available
from orders
""")
def explode_activities(t: Tables) -> DataFrame:
    rows = activity.explode_activities(_activity_list(t, _ACTIVITY))
    columns = [f.column for f in fl.ACTIVITY_REQUIRED + fl.ACTIVITY_OPTIONAL]
    return rows.select(
        "activity_id", "user_id", "activity_type_id", "activity_type_key", "event_type_id", "event_type_key",
        ntz(F.col("start_ts")).alias("start_ts"), ntz(F.col("end_ts")).alias("end_ts"),
        "timezone_offset_hours", *columns, "ts_data_available",
    )


def _metrics(t: Tables, sport: str) -> DataFrame:
    fields = fl.SPORTS[sport]
    rows = activity.project_sport_metrics(_activity_list(t, fields), sport)
    return rows.select("activity_id", *[f.column for f in fields])


@query(f"select o_orderkey as activity_id, {_of_orders_sql(fl.SWIMMING)} from orders where o_orderstatus = 'P'")
def project_swimming_metrics(t: Tables) -> DataFrame:
    return _metrics(t, "swimming")


@query(f"select o_orderkey as activity_id, {_of_orders_sql(fl.CYCLING)} from orders where o_orderstatus = 'O'")
def project_cycling_metrics(t: Tables) -> DataFrame:
    return _metrics(t, "cycling")


@query(f"select o_orderkey as activity_id, {_of_orders_sql(fl.RUNNING)} from orders where o_orderstatus = 'F'")
def project_running_metrics(t: Tables) -> DataFrame:
    return _metrics(t, "running")


@query(f"""
select o_orderkey as activity_id, unnest(['extra_value', 'extra_flag']) as metric,
  unnest([o_totalprice, cast({_PRIORITY_NO} = 2 as integer)::double]) as value from orders
union all select o_orderkey, 'steps', o_custkey from orders where o_orderstatus <> 'F'
union all select o_orderkey, 'strokes', o_custkey from orders where o_orderstatus <> 'P'
union all select o_orderkey, 'norm_power', o_totalprice from orders where o_orderstatus = 'P'
union all select o_orderkey, 'max_avg_power_20', {_PRIORITY_NO} from orders where o_orderstatus <> 'O'
union all select o_orderkey, 'average_swolf', {_PRIORITY_NO} from orders where o_orderstatus <> 'P'
union all select o_orderkey, 'min_temperature', {_PRIORITY_NO} from orders where o_orderstatus = 'P'
""")
def unpivot_residual_metrics(t: Tables) -> DataFrame:
    return activity.unpivot_residual_metrics(_activity_list(t)).select("activity_id", "metric", "value")


# Training documents.


@query(f"""
select user_id, {MS} // 1000 * 1000 as ts_ms, case when event_type = 'click' then 0.0 else -3.5 end::double as offset_hours,
  {filled_sql(fl.READINESS, "floor(value)", "event_id", "event_type")}
from events where event_type <> 'error'
""")
def explode_training_readiness(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    local = F.date_format(F.col("ts") - F.expr("interval 210 minutes"), "yyyy-MM-dd'T'HH:mm:ss.0")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.0")
    item = F.struct(
        F.when(kind != "error", stamp).alias("timestamp"),
        F.when(kind != "click", local).alias("timestampLocal"),
        *filled(fl.READINESS, _int_value().cast("double"), F.col("event_id"), kind),
        F.col("event_id").alias("deviceId"),
    )
    docs = as_docs(t.events, F.to_json(F.array(item)), "user_id")
    return training.explode_training_readiness(docs).select(
        "user_id", millis("timestamp").alias("ts_ms"), F.col("timezone_offset_hours").alias("offset_hours"),
        *[f.column for f in fl.READINESS],
    )


_LABELS = ", ".join(f"({key}, '{label}')" for key, label in RECORD_LABELS.items())


@query(f"""
with labels_of(type_no, label) as (values {_LABELS})
select o_custkey as user_id, case when day(o_orderdate) not in (12, 13, 14, 15, 16) then o_orderkey end as activity_id,
  o_orderdate as ts, cast(day(o_orderdate) as integer) as type_id, label, o_totalprice as value
from orders left join labels_of on day(o_orderdate) = type_no
""")
def explode_personal_records(t: Tables) -> DataFrame:
    item = F.struct(
        F.dayofmonth("o_orderdate").alias("typeId"),
        F.col("o_orderkey").alias("activityId"),
        millis("o_orderdate").alias("prStartTimeGmt"),
        F.col("o_totalprice").alias("value"),
    )
    docs = as_docs(t.orders, F.to_json(F.array(item)), "o_custkey")
    return training.explode_personal_records(docs).select(
        "user_id", "activity_id", ntz(F.col("timestamp")).alias("ts"), "type_id", "label", "value"
    )


@query(f"""
select o_custkey as user_id, cast(o_orderdate as date) as date, {_of_orders_sql(fl.RACE_TIMES)} from orders
""")
def project_race_prediction(t: Tables) -> DataFrame:
    content = F.to_json(
        F.struct(
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("calendarDate"),
            *_of_orders(fl.RACE_TIMES),
        )
    )
    docs = as_docs(t.orders, content, "o_custkey")
    return training.project_race_prediction(docs).select("user_id", "date", *[f.column for f in fl.RACE_TIMES])


@query(f"""
select * replace (lower(gender) as gender) from (
  select c_custkey as user_id, {filled_sql(fl.USER_DATA, "c_acctbal", "c_custkey", "c_mktsegment")},
    c_name as full_name, date '1990-02-03' as birth_date
  from customer
)
""")
def project_user_profile(t: Tables) -> DataFrame:
    data = F.struct(
        *filled(fl.USER_DATA, F.col("c_acctbal"), F.col("c_custkey"), F.col("c_mktsegment")),
        F.lit("1990-02-03").alias("birthDate"),
    )
    content = F.to_json(F.struct(F.col("c_name").alias("full_name"), data.alias("userData")))
    docs = as_docs(t.customer, content, "c_custkey")
    row = profile.project_user_profile(docs).select("user_id", *[f.column for f in fl.USER_DATA])
    person = profile.project_demographics(docs).select("user_id", "full_name", "birth_date")
    return row.join(person, "user_id")


_NEEDS = {"sleepNeed": "sleep_need", "nextSleepNeed": "next_sleep_need"}
_NEED_FIELDS = {
    name: [fl.Field(f.json, f"{prefix}_{f.column}", f.kind) for f in fl.SLEEP_NEED] for name, prefix in _NEEDS.items()
}
_SCORE_FIELDS = [fl.Field(f"{name} {part}", column, kind) for name, part, column, kind in fl.SLEEP_SCORES]
_SLEEP_PARTS = [
    fl.SLEEP_DAILY, _SCORE_FIELDS, *_NEED_FIELDS.values(), fl.SLEEP_SPO2_SUMMARY, fl.SLEEP_ROOT,
]


@query(f"""
select o_custkey as user_id, o_orderdate as start_ts, o_orderdate + interval 8 hour as end_ts,
  2.0::double as timezone_offset_hours, {", ".join(map(_of_orders_sql, _SLEEP_PARTS))}
from orders
""")
def project_sleep_session(t: Tables) -> DataFrame:
    ms = millis("o_orderdate")
    names = dict.fromkeys(name for name, *_ in fl.SLEEP_SCORES)
    stated = {f.json: c for f, c in zip(_SCORE_FIELDS, _of_orders(_SCORE_FIELDS))}
    scores = [
        F.struct(*[stated[f"{name} {part}"].alias(part) for n, part, *_ in fl.SLEEP_SCORES if n == name]).alias(name)
        for name in names
    ]
    daily = F.struct(
        ms.alias("sleepStartTimestampGMT"),
        (ms + 28_800_000).alias("sleepEndTimestampGMT"),
        (ms + 7_200_000).alias("sleepStartTimestampLocal"),
        *_of_orders(fl.SLEEP_DAILY),
        *[F.struct(*_of_orders(fields)).alias(name) for name, fields in _NEED_FIELDS.items()],
        F.struct(*scores).alias("sleepScores"),
    )
    content = F.to_json(
        F.struct(
            daily.alias("dailySleepDTO"),
            F.struct(*_of_orders(fl.SLEEP_SPO2_SUMMARY)).alias("wellnessSpO2SleepSummaryDTO"),
            *_of_orders(fl.SLEEP_ROOT),
        )
    )
    rows = sleep.project_sleep_session(as_docs(t.orders, content, "o_custkey"))
    return rows.select(
        "user_id", ntz(F.col("start_ts")).alias("start_ts"), ntz(F.col("end_ts")).alias("end_ts"),
        "timezone_offset_hours", *[f.column for part in _SLEEP_PARTS for f in part],
    )


def _status_docs(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    after = F.date_format(F.col("o_orderdate") + F.expr("interval 1 day"), "yyyy-MM-dd")
    status = F.col("o_orderstatus")
    vo2 = F.struct(
        F.struct(day.alias("calendarDate"), F.col("o_totalprice").alias("vo2MaxPreciseValue")).alias("generic"),
        F.struct(
            F.when(status == "O", after).alias("calendarDate"), F.col("o_orderkey").alias("vo2MaxPreciseValue")
        ).alias("cycling"),
        F.when(
            status == "F",
            F.struct(day.alias("calendarDate"), *_of_orders(fl.ACCLIMATION)),
        ).alias("heatAltitudeAcclimation"),
    )
    balance = F.struct(day.alias("calendarDate"), *_of_orders(fl.LOAD_BALANCE))
    ratio = F.when(status != "P", F.struct(*_of_orders(fl.LOAD_RATIO)))
    load = F.struct(after.alias("calendarDate"), *_of_orders(fl.LOAD_STATUS), ratio.alias("acuteTrainingLoadDTO"))
    content = F.to_json(
        F.struct(
            vo2.alias("mostRecentVO2Max"),
            F.struct(F.create_map(F.lit("77"), balance).alias("metricsTrainingLoadBalanceDTOMap")).alias(
                "mostRecentTrainingLoadBalance"
            ),
            F.struct(F.create_map(F.lit("77"), load).alias("latestTrainingStatusData")).alias("mostRecentTrainingStatus"),
        )
    )
    return as_docs(t.orders, content, "o_custkey")


@query(f"""
select o_custkey as user_id, cast(o_orderdate as date) as date, 'generic' as kind, o_totalprice as value from orders
union all by name
select o_custkey as user_id, cast(o_orderdate + interval 1 day as date) as date, 'cycling' as kind,
  cast(o_orderkey as double) as value
from orders where o_orderstatus = 'O'
union all by name
select o_custkey as user_id, cast(o_orderdate as date) as date, 'altitude' as kind, {_of_orders_sql(fl.ACCLIMATION)}
from orders where o_orderstatus = 'F'
""")
def project_vo2_max(t: Tables) -> DataFrame:
    docs = _status_docs(t)
    parts = [
        training.project_vo2_max(docs, kind).select(
            "user_id", "date", F.lit(kind).alias("kind"), F.col(f"vo2_max_{kind}").alias("value")
        )
        for kind in ("generic", "cycling")
    ]
    altitude = training.project_acclimation(docs).select(
        "user_id", "date", F.lit("altitude").alias("kind"), *[f.column for f in fl.ACCLIMATION]
    )
    return parts[0].unionByName(parts[1]).unionByName(altitude, allowMissingColumns=True)


@query(f"""
select o_custkey as user_id, cast(o_orderdate as date) as date, {_of_orders_sql(fl.LOAD_BALANCE)} from orders
union all by name
select o_custkey as user_id, cast(o_orderdate + interval 1 day as date) as date, {_of_orders_sql(fl.LOAD_STATUS)},
  {_of_orders_sql(fl.LOAD_RATIO)}
from orders where o_orderstatus <> 'P'
union all by name
select o_custkey as user_id, cast(o_orderdate + interval 1 day as date) as date, {_of_orders_sql(fl.LOAD_STATUS)}
from orders where o_orderstatus = 'P'
""")
def project_training_load(t: Tables) -> DataFrame:
    docs = _status_docs(t)
    balance = training.project_training_load(docs, "balance")
    status = training.project_training_load(docs, "status")
    status = status.select("user_id", "date", *[f.column for f in fl.LOAD_RATIO + fl.LOAD_STATUS])
    balance = balance.select("user_id", "date", *[f.column for f in fl.LOAD_BALANCE])
    return balance.unionByName(status, allowMissingColumns=True)


@query("""
select l_orderkey as user_id, cast(l_shipdate as date) as date,
  case when l_returnflag = 'A' then l_linenumber end as moderate_minutes,
  case when l_returnflag = 'N' then l_linenumber + 1 end as vigorous_minutes,
  case when l_returnflag <> 'R' then cast(l_quantity as integer) - l_linenumber end as total_intensity_minutes
from lineitem where l_returnflag <> 'R' and l_linestatus = 'O'
""")
def project_intensity_totals(t: Tables) -> DataFrame:
    flag = F.col("l_returnflag")
    content = F.to_json(
        F.struct(
            F.when(F.col("l_linestatus") == "O", F.date_format("l_shipdate", "yyyy-MM-dd")).alias("calendarDate"),
            F.when(flag == "A", F.col("l_linenumber")).alias("moderateMinutes"),
            F.when(flag == "N", F.col("l_linenumber") + 1).alias("vigorousMinutes"),
            F.col("l_linenumber").alias("startDayMinutes"),
            F.when(flag != "R", F.col("l_quantity").cast("int")).alias("endDayMinutes"),
        )
    )
    docs = as_docs(t.lineitem, content, "l_orderkey")
    rows = wellness.project_intensity_totals(docs)
    return rows.select("user_id", "date", *fl.INTENSITY_TOTALS)


# Frames.


def _field(name: str | Column, value: Column, kind: str, units: str | None = None) -> Column:
    label = F.lit(name) if isinstance(name, str) else name
    return _field_struct(label, value.cast("string"), F.lit(None).cast("array<string>"), kind, units)


def _list_field(name: str, items: Column) -> Column:
    return _field_struct(F.lit(name), F.lit(None).cast("string"), items, "list", None)


def _field_struct(name: Column, value: Column, items: Column, kind: str, units: str | None) -> Column:
    return F.struct(
        name.alias("name"),
        value.alias("value"),
        items.alias("items"),
        F.lit(kind).alias("kind"),
        F.lit(units).cast("string").alias("units"),
    )


@query("""
select l_orderkey as activity_id, l_shipdate as ts, unnest(['quantity', 'line', 'open']) as name,
  unnest([l_quantity, l_linenumber, cast(l_linestatus = 'O' as integer)]::double[]) as value,
  unnest(['kg', null, null]) as units
from lineitem where l_returnflag <> 'R'
""")
def unpivot_record_frames(t: Tables) -> DataFrame:
    stamp = F.when(F.col("l_returnflag") != "R", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"))
    fields = F.array(
        _field("timestamp", stamp, "datetime"),
        _field("quantity", F.col("l_quantity"), "float", "kg"),
        _field("line", F.col("l_linenumber"), "int", ""),
        _field("open", F.col("l_linestatus") == "O", "bool"),
        _field("flag", F.col("l_returnflag"), "string"),
        _field("Unknown_17", F.col("l_linenumber"), "int"),
        _field(F.lit(None).cast("string"), F.col("l_linenumber"), "int"),
    )
    rows = over_all_cores(t.lineitem).select(
        F.col("l_orderkey").alias("activity_id"),
        F.col("l_linenumber").cast("bigint").alias("frame_seq"),
        F.lit("record").alias("frame_name"),
        fields.alias("fields"),
    )
    return frames.unpivot_record_frames(rows).select(
        "activity_id", ntz(F.col("timestamp")).alias("ts"), "name", "value", "units"
    )


def event_frames(t: Tables) -> DataFrame:
    """Events as split and lap frames of their user's activity, in the order of their ids."""
    kind = F.col("event_type")
    number = F.col("event_id").cast("string")
    fields = F.array(
        _field("split_type", kind, "string"),
        _field("distance", F.concat(number, F.lit(".25")), "float", "m"),
        _field("text", F.lit("n/a"), "string"),
        _field("unknown_3", number, "int"),
        _list_field("zone", F.array(number, F.lit(None).cast("string"), F.lit("7"), F.lit("bad"), F.lit("9"))),
    )
    return over_all_cores(t.events).select(
        F.col("user_id").alias("activity_id"),
        F.col("event_id").alias("frame_seq"),
        F.when(kind.isin("click", "view"), F.lit("split")).otherwise(F.lit("lap")).alias("frame_name"),
        fields.alias("fields"),
    )


_FRAMES_SQL = """
with frames as (select user_id as activity_id, event_id, event_type,
  case when event_type in ('click', 'view') then 'split' else 'lap' end as frame_name from events),
counted as (select *, cast(row_number() over (partition by activity_id, frame_name order by event_id) as integer) as idx
  from frames)
"""


@query(_FRAMES_SQL + """
select activity_id, idx as split_idx, event_type as split_type, unnest(['distance', 'zone_1', 'zone_3']) as name,
  unnest([event_id + 0.25, event_id, 7]::double[]) as value, unnest(['m', null, null]) as units
from counted where frame_name = 'split'
""")
def unpivot_split_frames(t: Tables) -> DataFrame:
    return frames.unpivot_split_frames(event_frames(t))


@query(_FRAMES_SQL + """
select activity_id, idx as lap_idx, unnest(['distance', 'zone_1', 'zone_3']) as name,
  unnest([event_id + 0.25, event_id, 7]::double[]) as value, unnest(['m', null, null]) as units
from counted where frame_name = 'lap'
""")
def unpivot_lap_frames(t: Tables) -> DataFrame:
    return frames.unpivot_lap_frames(event_frames(t))


@query(_FRAMES_SQL + "select activity_id, event_id as frame_seq, idx as frame_no from counted")
def running_frame_index(t: Tables) -> DataFrame:
    plain = event_frames(t).drop("fields")
    return frames.running_frame_index(plain, "frame_no").select(
        "activity_id", "frame_seq", F.col("frame_no").cast("int").alias("frame_no")
    )
