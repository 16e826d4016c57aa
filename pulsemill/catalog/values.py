"""Queries: scalar functions and row predicates of the decoders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill import fields as fl
from pulsemill.catalog.base import Tables, as_docs, millis, ntz, query
from pulsemill.functions import checks, scalars
from pulsemill.operators import sleep, training
from pulsemill.operators.documents import columns_of, parse, struct_ddl
from pulsemill.registry import RECORD_LABELS, RECORDS_WITHOUT_ACTIVITY

MS = "(epoch_us(ts) // 1000)"
MS_TS = "make_timestamp(epoch_us(ts) // 1000 * 1000)"


@query("""
select c_custkey, lower(substr(x, 1, 1) || regexp_replace(substr(x, 2), '([A-Z])', '_\\1', 'g')) as snake
from (select c_custkey, lower(c_mktsegment) || c_name || 'HR' as x from customer)
""")
def camel_to_snake(t: Tables) -> DataFrame:
    name = F.concat(F.lower("c_mktsegment"), "c_name", F.lit("HR"))
    return t.customer.select("c_custkey", scalars.camel_to_snake(name).alias("snake"))


_SOME = [f for f in fl.ACTIVITY_OPTIONAL if f.json in ("averageSpeed", "lapCount", "activityName", "maxSpeed")]


@query("""
select event_id, value as average_speed, cast(case when event_type = 'click' then event_id end as integer) as lap_count,
  event_type as activity_name, cast(null as double) as max_speed
from events
""")
def project_nullable_fields(t: Tables) -> DataFrame:
    content = F.to_json(
        F.struct(
            F.col("value").alias("averageSpeed"),
            F.when(F.col("event_type") == "click", F.col("event_id")).alias("lapCount"),
            F.col("event_type").alias("activityName"),
        )
    )
    docs = parse(as_docs(t.events, content, "user_id", "event_id"), struct_ddl(_SOME))
    return docs.select("event_id", *columns_of("doc", _SOME))


@query("""
select event_id, event_type in ('view', 'click') as complete,
  case when event_type in ('view', 'click') then '' else 'v' end as lacks
from events
""")
def project_required_fields(t: Tables) -> DataFrame:
    stated = F.when(F.col("event_type") == "view", F.lit(',"v":null')).when(
        F.col("event_type") == "click", F.lit(',"v":5')
    ).otherwise(F.lit(""))
    content = F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), stated, F.lit("}"))
    lacking = F.array_join(checks.missing_keys(content, ["id", "v"]), ",")
    return t.events.select(
        "event_id", checks.has_keys(content, ["id", "v"]).alias("complete"), lacking.alias("lacks")
    )


_RENAMED = [f for f in fl.ACTIVITY_OPTIONAL + fl.CYCLING if f.json in ("averageHR", "normPower", "max20MinPower")]


@query("""
select p_partkey, p_retailprice as average_hr, cast(p_size as double) as normalized_power,
  cast(p_partkey as double) as max_20min_power
from part
""")
def rename_custom_fields(t: Tables) -> DataFrame:
    content = F.to_json(
        F.struct(
            F.col("p_retailprice").alias("averageHR"),
            F.col("p_size").alias("normPower"),
            F.col("p_partkey").alias("max20MinPower"),
        )
    )
    docs = parse(as_docs(t.part, content, "p_partkey", "p_partkey"), struct_ddl(_RENAMED))
    return docs.select("p_partkey", *columns_of("doc", _RENAMED))


@query(f"select event_id, {MS_TS} as ts from events")
def epoch_ms_to_timestamp(t: Tables) -> DataFrame:
    return t.events.select("event_id", ntz(scalars.epoch_ms_to_timestamp(millis("ts"))).alias("ts"))


@query("select o_orderkey, o_orderdate as ts from orders")
def iso_to_utc_timestamp(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = (
        F.when(F.col("o_orderstatus") == "F", F.concat(day, F.lit("T00:00:00Z")))
        .when(F.col("o_orderstatus") == "O", F.concat(day, F.lit(" 00:00:00.0")))
        .otherwise(F.concat(day, F.lit("T00:00:00+02:00")))
    )
    return t.orders.select("o_orderkey", ntz(scalars.iso_to_utc_timestamp(text)).alias("ts"))


@query("select l_orderkey, l_linenumber, l_linenumber * 0.5::double as hours from lineitem")
def timezone_offset_hours(t: Tables) -> DataFrame:
    utc = F.col("l_shipdate").cast("timestamp")
    local = F.timestamp_micros(F.unix_micros(utc) + F.col("l_linenumber").cast("bigint") * 1_800_000_000)
    return t.lineitem.select("l_orderkey", "l_linenumber", scalars.timezone_offset_hours(local, utc).alias("hours"))


@query("""
select l_orderkey, l_linenumber, case l_returnflag when 'N' then l_shipdate + interval 1 day
  when 'A' then l_shipdate + to_microseconds(cast(l_quantity * 60500000 as bigint)) end as end_ts
from lineitem
""")
def derive_end_timestamp(t: Tables) -> DataFrame:
    start = F.col("l_shipdate").cast("timestamp")
    flag = F.col("l_returnflag")
    stated = F.when(flag == "N", F.timestamp_micros(F.unix_micros(start) + F.lit(86_400_000_000)))
    duration = F.when(flag == "A", F.col("l_quantity") * 60.5)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", ntz(scalars.derive_end_timestamp(stated, start, duration)).alias("end_ts")
    )


@query("select c_custkey, case when c_nationkey >= 5 then lower(c_mktsegment) end as gender from customer")
def lowercase_or_null(t: Tables) -> DataFrame:
    text = F.when(F.col("c_nationkey") < 5, F.lit("")).otherwise(F.col("c_mktsegment"))
    return t.customer.select("c_custkey", scalars.lowercase_or_null(text).alias("gender"))


@query("select o_orderkey, case when o_orderstatus <> 'P' then cast(o_orderdate as date) end as birth_date from orders")
def parse_date_or_null(t: Tables) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", scalars.parse_date_or_null(text).alias("birth_date"))


@query("""
select o_orderkey, case when o_orderstatus <> 'P' then o_orderpriority end as score_overall_key,
  cast(case when o_orderstatus <> 'P' then o_custkey end as integer) as score_overall_value,
  cast(null as varchar) as deep_pct_key
from orders
""")
def extract_nested_struct(t: Tables) -> DataFrame:
    score = F.struct(F.col("o_orderpriority").alias("qualifierKey"), F.col("o_custkey").alias("value"))
    scores = F.when(F.col("o_orderstatus") != "P", F.struct(score.alias("overall")))
    content = F.to_json(F.struct(F.struct(scores.alias("sleepScores")).alias("dailySleepDTO")))
    docs = parse(as_docs(t.orders, content, "o_custkey", "o_orderkey"), sleep.SESSION)
    wanted = [p for p in fl.SLEEP_SCORES if p[0] in ("overall", "deepPercentage") and p[2] != "deep_pct_value"]
    return docs.select("o_orderkey", *sleep.nested_parts("doc.dailySleepDTO.sleepScores", wanted))


@query("select event_id, case when event_type = 'click' then value + 1 end as avg_overnight_hrv from events")
def override_by_outer_field(t: Tables) -> DataFrame:
    times = [F.lit(1).alias(n) for n in ("sleepStartTimestampGMT", "sleepEndTimestampGMT", "sleepStartTimestampLocal")]
    content = F.to_json(
        F.struct(
            F.struct(*times, F.col("value").alias("avgOvernightHrv")).alias("dailySleepDTO"),
            F.when(F.col("event_type") == "click", F.col("value") + 1).alias("avgOvernightHrv"),
        )
    )
    rows = sleep.project_sleep_session(as_docs(t.events, content, "event_id"))
    return rows.select(F.col("user_id").alias("event_id"), "avg_overnight_hrv")


@query("""
select o_orderkey, cast(o_orderdate as date) as date, o_totalprice as monthly_load_anaerobic
from orders where o_orderstatus <> 'P'
""")
def first_map_entry(t: Tables) -> DataFrame:
    first = F.struct(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("calendarDate"),
        F.col("o_totalprice").alias("monthlyLoadAnaerobic"),
    )
    second = F.struct(F.lit("1990-01-01").alias("calendarDate"), F.lit(0.0).alias("monthlyLoadAnaerobic"))
    devices = F.when(
        F.col("o_orderstatus") != "P", F.create_map(F.lit("z-first"), first, F.lit("a-second"), second)
    )
    content = F.to_json(
        F.struct(F.struct(devices.alias("metricsTrainingLoadBalanceDTOMap")).alias("mostRecentTrainingLoadBalance"))
    )
    docs = as_docs(t.orders, content, "o_orderkey")
    rows = training.project_training_load(docs, "balance")
    return rows.select(F.col("user_id").alias("o_orderkey"), "date", "monthly_load_anaerobic")


@query("""
select l_orderkey, l_linenumber, cast(case when l_returnflag <> 'R' then l_quantity end as integer)
  - case when l_linestatus <> 'O' then l_linenumber end as total
from lineitem
""")
def null_safe_difference(t: Tables) -> DataFrame:
    end = F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("int"))
    start = F.when(F.col("l_linestatus") != "O", F.col("l_linenumber"))
    return t.lineitem.select("l_orderkey", "l_linenumber", scalars.null_safe_difference(end, start).alias("total"))


_LABELS = ", ".join(f"({key}, '{label}')" for key, label in RECORD_LABELS.items())


@query(f"""
with labels(type_id, label) as (values {_LABELS})
select l_orderkey, l_linenumber, cast(l_quantity as integer) as type_id, label
from lineitem left join labels on cast(l_quantity as integer) = type_id
""")
def lookup_label(t: Tables) -> DataFrame:
    kind = F.col("l_quantity").cast("int")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", kind.alias("type_id"), scalars.lookup_label(kind, RECORD_LABELS).alias("label")
    )


@query(f"""
select l_orderkey, l_linenumber,
  case when cast(l_quantity as integer) not in ({', '.join(map(str, RECORDS_WITHOUT_ACTIVITY))}) then l_partkey end
  as activity_id
from lineitem
""")
def conditional_null_reference(t: Tables) -> DataFrame:
    kind = F.col("l_quantity").cast("int")
    reference = scalars.conditional_null_reference(F.col("l_partkey"), kind, RECORDS_WITHOUT_ACTIVITY)
    return t.lineitem.select("l_orderkey", "l_linenumber", reference.alias("activity_id"))


@query("""
select vec_id, 'zone_' || i as name, cast(embedding[i] as double) as value
from (select vec_id, embedding, unnest(generate_series(1, len(embedding))) as i from embeddings)
where embedding[i] > 0
""")
def suffix_array_name(t: Tables) -> DataFrame:
    items = F.transform("embedding", lambda x: F.when(x > 0, x.cast("double")))
    return t.embeddings.select("vec_id", F.inline(scalars.numbered_items(items, F.lit("zone"))))


@query("""
select event_id, 'i' as key, cast(event_id as double) as number from events
union all select event_id, 'd', value from events
union all select event_id, 'b', case when event_type = 'click' then 1.0::double else 0.0::double end from events
union all select event_id, 's', null from events
union all select event_id, 'n', null from events
""")
def numeric_to_double(t: Tables) -> DataFrame:
    parts = F.struct(
        F.col("event_id").alias("i"),
        F.col("value").alias("d"),
        (F.col("event_type") == "click").alias("b"),
        F.col("user_id").cast("string").alias("s"),
        F.struct(F.col("user_id").alias("x")).alias("n"),
    )
    docs = t.events.select("event_id", F.parse_json(F.to_json(parts)).alias("whole"))
    entry = t.spark.tvf.variant_explode(F.col("whole").outer())
    return docs.lateralJoin(entry).select("event_id", "key", scalars.numeric_to_double(F.col("value")).alias("number"))


@query("""
select event_id, case event_type when 'click' then cast('1' || event_id as double)
  when 'purchase' then event_id + 0.5 when 'signup' then event_id * 10.0 end::double as number
from events where event_type in ('click', 'purchase', 'signup')
""")
def cast_or_skip(t: Tables) -> DataFrame:
    number = F.col("event_id").cast("string")
    kind = F.col("event_type")
    text = (
        F.when(kind == "click", F.concat(F.lit("1_"), number))
        .when(kind == "purchase", F.concat(F.lit("+"), number, F.lit(".5")))
        .when(kind == "signup", F.concat(F.lit(" "), number, F.lit("E1 ")))
        .when(kind == "view", F.lit("n/a"))
        .otherwise(F.concat(number, F.lit("d")))
    )
    return t.events.select("event_id", scalars.cast_or_skip(text).alias("number")).filter("number is not null")


@query("""
select doc_id, case when n_chars > 1000 then 'text too long: ' || lang else 'text fits' end as message from documents
""")
def error_message_of(t: Tables) -> DataFrame:
    long = F.col("n_chars") > 1000
    rule = F.when(long, F.lit("text too long")).otherwise(F.lit("text fits"))
    return t.documents.select("doc_id", scalars.error_message_of(rule, F.when(long, F.col("lang"))).alias("message"))


# Row predicates.


@query("""
with readings as (select event_id, case when value >= 10 then value - 50 end as reading from events)
select event_id, reading, reading is null as failed from readings where reading >= 0 or reading is null
""")
def drop_negative_sentinel(t: Tables) -> DataFrame:
    reading = F.when(F.col("value") >= 10, F.col("value") - 50)
    rows = t.events.select("event_id", reading.alias("reading"))
    value = F.col("reading")
    return rows.withColumn("failed", checks.bad_reading(value)).filter(checks.keep_measured(value) | F.col("failed"))


@query(f"""
select event_id, {MS} as ms, value as reading from events where event_type <> 'error' and value >= 10
""")
def drop_null_reading(t: Tables) -> DataFrame:
    ms = F.when(F.col("event_type") == "error", F.lit(0)).otherwise(millis("ts"))
    rows = t.events.select("event_id", ms.alias("ms"), F.when(F.col("value") >= 10, F.col("value")).alias("reading"))
    return rows.filter(checks.keep_reading(F.col("ms"), F.col("reading")))


@query("""
select event_id, cast(case when value < 20 then 0 else floor(value) end as bigint) as steps
from events where event_type not in ('click', 'view') and value >= 10
""")
def drop_incomplete_interval(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    end = F.when(kind == "view", F.lit("")).when(kind != "click", F.col("ts").cast("string"))
    steps = F.when(F.col("value") >= 20, F.floor("value")).when(F.col("value") >= 10, F.lit(0)).cast("bigint")
    rows = t.events.select("event_id", end.alias("end"), steps.alias("steps"))
    return rows.filter(checks.keep_interval(F.col("end"), F.col("steps"))).drop("end")


@query("select event_id from events where event_type not in ('click', 'view', 'error', 'signup')")
def drop_falsy_timestamp(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    ms = F.when(kind == "click", F.lit(0)).when(kind != "view", millis("ts"))
    text = F.when(kind == "error", F.lit("")).when(kind != "signup", F.col("ts").cast("string"))
    rows = t.events.select("event_id", ms.alias("ms"), text.alias("text"))
    return rows.filter(checks.keep_timed(F.col("ms")) & checks.keep_timed_text(F.col("text"))).select("event_id")


_LENGTHS = "case event_type when 'click' then 1 when 'view' then 2 when 'purchase' then 3 when 'signup' then 4 else 0 end"


@query(f"""
with sized as (select event_id, {_LENGTHS} as n from events)
select event_id, n >= 2 as two, n >= 3 as three, n >= 4 as four, n <> 2 as not_a_pair from sized
""")
def min_array_length(t: Tables) -> DataFrame:
    whole = F.array(millis("ts"), F.col("event_id"), F.col("user_id"), F.col("user_id"))
    values = F.slice(whole, F.lit(1), F.expr(_LENGTHS))
    return t.events.select(
        "event_id",
        checks.keep_long_enough(values, 2).alias("two"),
        checks.keep_long_enough(values, 3).alias("three"),
        checks.keep_long_enough(values, 4).alias("four"),
        checks.bad_length(values, 2).alias("not_a_pair"),
    )


@query("select p_partkey, p_name as name from part where p_size >= 10 and p_size <> 50")
def exclude_unknown_names(t: Tables) -> DataFrame:
    size = F.col("p_size")
    name = F.when(size < 10, F.concat(F.lit("UnKnown_"), "p_name")).when(size != 50, F.col("p_name"))
    return t.part.select("p_partkey", name.alias("name")).filter(checks.keep_known_name(F.col("name")))


@query("""
select event_id, 'score' as name, cast(user_id as varchar) as text from events
union all select event_id, 'level', event_type from events
""")
def exclude_named_fields(t: Tables) -> DataFrame:
    content = F.to_json(
        F.struct(
            F.col("user_id").alias("score"),
            F.col("event_type").alias("level"),
            F.col("event_id").alias("deviceId"),
            F.lit("x").alias("ownerProfileImageUrlSmall"),
        )
    )
    entries = t.events.select("event_id", F.explode(F.from_json(content, "map<string,string>")).alias("name", "text"))
    return entries.filter(checks.keep_unlisted(F.col("name"), fl.READINESS_SKIPPED, ["ownerProfileImageUrl"]))


@query("""
select event_id, 'flat' as key from events
union all select event_id, 'text' from events where event_type <> 'click'
""")
def exclude_nested_values(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") == "click", F.lit("[1]")).otherwise(F.lit('"x"'))
    content = F.concat(
        F.lit('{"flat":'), F.col("event_id").cast("string"), F.lit(',"nested":{"a":1},"text":'), text, F.lit("}")
    )
    docs = t.events.select("event_id", F.parse_json(content).alias("whole"))
    entry = t.spark.tvf.variant_explode(F.col("whole").outer())
    return docs.lateralJoin(entry).filter(checks.keep_flat(F.col("value"))).select("event_id", "key")


@query("""
select event_id, cast(ts as date) as date, value as time_5k from events where event_type in ('click', 'view')
""")
def skip_empty_document(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    filled = F.to_json(
        F.struct(F.date_format("ts", "yyyy-MM-dd").alias("calendarDate"), F.col("value").alias("time5K"))
    )
    content = (
        F.when(kind == "purchase", F.lit("{}"))
        .when(kind == "signup", F.lit(" [] "))
        .when(kind == "error", F.lit("null"))
        .otherwise(filled)
    )
    docs = as_docs(t.events, content, "event_id")
    rows = training.project_race_prediction(docs)
    return rows.select(F.col("user_id").alias("event_id"), "date", "time_5k")


@query("select event_id, event_type not in ('click', 'view') as rejected from events")
def reject_non_array_document(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    content = (
        F.when(kind == "click", F.lit(' [{"a": 1}]'))
        .when(kind == "view", F.lit("[]"))
        .when(kind == "signup", F.lit('{"a": [1]}'))
        .when(kind == "error", F.lit('"[1]"'))
    )
    return t.events.select("event_id", (~checks.is_array_text(content)).alias("rejected"))


_TYPE_KEYS = (
    "case p_type when 'ECONOMY' then 'Running' when 'SMALL' then 'indoor_Cycling' when 'LARGE' then 'lap_swimming' "
    "when 'MEDIUM' then 'mountain_biking' when 'PROMO' then 'trail_running' else 'swimming_and_cycling' end"
)


@query("""
select p_partkey, case p_type when 'ECONOMY' then 'running' when 'SMALL' then 'cycling' when 'LARGE' then 'swimming'
  when 'MEDIUM' then 'cycling' when 'PROMO' then 'other' else 'cycling' end as sport
from part
""")
def route_by_category(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", checks.sport_branch(F.expr(_TYPE_KEYS)).alias("sport"))
