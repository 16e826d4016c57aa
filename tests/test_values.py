import math

import pytest
from pyspark.sql import functions as F

from pulsemill import fields as fl
from pulsemill.functions import checks, names, scalars
from pulsemill.registry import DATA_TYPES, PROCESS_ORDER, chosen_types, file_patterns

SNAKE = {
    "averageHR": "average_h_r", "time5K": "time5_k", "activityId": "activity_id", "pr": "pr", "HRV": "h_r_v",
    "hrTimeInZone_1": "hr_time_in_zone_1",
}


def column(spark, values, expression, ddl="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {ddl}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("x"))).collect()]


def test_snake_case_agrees_with_its_plan_time_twin(spark):
    assert column(spark, list(SNAKE), scalars.camel_to_snake) == list(SNAKE.values())
    assert [scalars.snake_name(n) for n in SNAKE] == list(SNAKE.values())


def test_numbers_in_text(spark):
    texts = ["1_000", " 5.5 ", "1e3", "-.5", "5.", "inf", "5d", "0x10", "1__0", "_1", "", "abc", "True", None]
    got = column(spark, texts, scalars.cast_or_skip)
    assert got[:6] == [1000.0, 5.5, 1000.0, -0.5, 5.0, math.inf] and got[6:] == [None] * 8
    assert math.isnan(column(spark, ["NaN"], scalars.cast_or_skip)[0])


@pytest.mark.parametrize("kind", ["string", "int", "bigint", "double", "boolean", "date"])
def test_assignment_rules_agree_as_columns_and_as_sql(spark, kind):
    texts = ["5", "2.5", "-2.5", "1e2", "abc", "true", "TRUE", "2022-01-05", "99999999999", "5d", '{"a":1}', "", None]
    by_column = column(spark, texts, lambda x: scalars.assign(x, kind))
    assert by_column == column(spark, texts, lambda x: F.expr(scalars.assign_sql("x", kind)))
    wrong = column(spark, texts, lambda x: scalars.unfit(x, kind))
    assert wrong == column(spark, texts, lambda x: F.expr(scalars.unfit_sql("x", kind)))
    if kind == "int":
        assert by_column[:5] == [5, 3, -3, 100, None] and wrong[4] and not wrong[-1]


def test_times(spark):
    texts = ["2022-01-01T06:00:00.000", "2022-01-01 06:00:00", "2022-01-01T06:00:00+02:00", "soon", None]
    micros = column(spark, texts, lambda x: F.unix_micros(scalars.iso_to_utc_timestamp(x)))
    six = 1641016800000000
    assert micros == [six, six, six, None, None]
    instant = column(spark, texts, lambda x: F.unix_micros(scalars.iso_to_instant(x)))
    assert instant[2] == six - 7_200_000_000
    ms = column(spark, ["1641016800000", "1641016800000.25", "x"], lambda x: F.unix_micros(scalars.epoch_ms_to_timestamp(x)))
    assert ms == [six, six + 250, None]


def test_file_names(spark):
    good = "12_SLEEP_2022-01-01T12:00:00Z.json"
    activity = "12_ACTIVITY_99_2022-01-01T12:00:00Z.fit"
    texts = [good, activity, "12_SLEEP_2022-01-01T12:00:00+00:00.json", "x_SLEEP_1.json"]
    users = column(spark, texts, lambda x: names.parse_filename(x)["user_id"])
    assert users == [12, 12, None, None]
    assert column(spark, texts, names.parse_activity_filename) == [None, 99, None, None]
    by_pattern = column(spark, texts, lambda x: names.classify_file_type(x, file_patterns()))
    assert by_pattern == column(spark, texts, names.registered_type) == ["SLEEP", "ACTIVITY", "SLEEP", "SLEEP"]
    again = column(spark, ["data.csv"] * 2, lambda x: names.extract_file_timestamp(x, F.lit("2022-01-01").cast("timestamp"), x))
    assert again[0] == again[1]


def test_registry():
    assert sorted(DATA_TYPES) == sorted(PROCESS_ORDER) and len(DATA_TYPES) == 14
    assert chosen_types(None) == list(DATA_TYPES) and chosen_types([]) == []
    with pytest.raises(ValueError, match="NOPE"):
        chosen_types(["SLEEP", "NOPE"])


def test_field_lists():
    assert (len(fl.RUNNING), len(fl.CYCLING), len(fl.SWIMMING)) == (27, 41, 7)
    assert len(fl.READINESS) == 30 and len(fl.SLEEP_SCORES) == 12
    assert {f.json: f.column for f in fl.CYCLING}["max20MinPower"] == "max_20min_power"


def test_required_keys(spark):
    texts = ['{"a":1,"b":null}', '{"a":1}', "[]", None]
    assert column(spark, texts, lambda x: checks.has_keys(x, ["a", "b"])) == [True, False, False, False]


def test_sport_branches(spark):
    keys = ["running", "Trail_Running", "road_biking", "cycling_and_swimming", "open_water_SWIMMING", ""]
    assert column(spark, keys, checks.sport_branch) == ["running", "other", "cycling", "cycling", "swimming", "other"]
