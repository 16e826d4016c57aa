import pytest
from pyspark.sql import functions as F

from pulsemill.operators.frames import FRAMES
from pulsemill.plans.run import RunConfig, run_batch
from pulsemill.schema import TABLES
from pulsemill.session import scratch_path
from pulsemill.sources.store import Store
from samples import activity, day, frames


def config(run="r1", **extra):
    return RunConfig("wearables", run, "2025-08-08 03:00:00", **extra)


def frame_table(spark, rows):
    return spark.createDataFrame(rows, f"file_name string, {FRAMES}")


def contents(store):
    """All tables without audit stamps, as comparable sets."""
    out = {}
    for name, spec in TABLES.items():
        if name == "etl_result":
            continue
        columns = [c for c in spec.names if c not in ("create_ts", "update_ts")]
        out[name] = sorted(map(repr, store.read(name).select(*columns).collect()))
    return out


def test_full_day_replay_and_failed_set(spark, raw, table):
    store = Store(spark, scratch_path(spark, "store"))
    fit = frame_table(spark, frames())
    outcome = run_batch(spark, raw(day()), store, config(), fit)
    assert {r["state"] for r in outcome.collect()} == {"store"}
    assert outcome.count() == 14

    sizes = {name: store.read(name).count() for name in TABLES}
    assert sizes == {
        "user": 1, "user_profile": 1, "activity": 2, "running_agg_metrics": 1, "cycling_agg_metrics": 1,
        "swimming_agg_metrics": 0, "supplemental_activity_metric": 5, "sleep": 1, "sleep_movement": 1,
        "sleep_restless_moment": 1, "spo2": 1, "hrv": 1, "breathing_disruption": 1, "vo2_max": 1,
        "acclimation": 1, "training_load": 1, "training_readiness": 1, "stress": 1, "body_battery": 2,
        "heart_rate": 2, "steps": 1, "respiration": 1, "intensity_minutes": 1, "floors": 1,
        "personal_record": 2, "race_predictions": 1, "activity_ts_metric": 1, "activity_split_metric": 1,
        "activity_lap_metric": 4, "etl_result": 14,
    }
    assert table(store.read("user"), "full_name")[0] == ("Test User",)
    load = store.read("training_load").head()
    assert (load.monthly_load_anaerobic, load.training_status, load.total_intensity_minutes) == (12.5, 4, 12)
    sleep = store.read("sleep").head()
    assert sleep.timezone_offset_hours == 2.0 and sleep.avg_overnight_hrv is None and sleep.score_overall_value == 85
    assert store.read("hrv").head().sleep_id == sleep.sleep_id
    flags = dict(table(store.read("activity"), "activity_id", "ts_data_available"))
    assert flags == {1001: True, 1002: False}
    extra = table(store.read("supplemental_activity_metric"), "activity_id", "metric", "value")
    assert (1002, "steps", 9000.0) in extra and (1001, "some_flag", 1.0) in extra

    before = contents(store)
    run_batch(spark, raw(day()).repartition(5, "length"), store, config("r2"), fit)
    after = contents(store)
    assert after == before, [name for name in after if after[name] != before[name]]

    # A later day: one bad file takes its whole set away, the next set loses its parent activity.
    bad = {k: v for k, v in day(date="2025-08-09", activity_id=2001).items() if "ACTIV" in k or "HEART" in k}
    bad["7_HEART_RATE_2025-08-09T12:00:00Z.json"] = {"heartRateValues": [[1]]}
    bad["7_ACTIVITY_2001_2025-08-10T12:00:00Z.fit"] = ""
    bad["7_FLOORS_2025-08-10T12:00:00Z.json"] = {"floorValuesArray": []}
    bad["7_STEPS_2025-08-11T12:00:00Z.json"] = [{"endGMT": "2025-08-11T00:15:00.0", "steps": 5}]
    bad["7_BATTERY_2025-08-12T12:00:00Z.json"] = {}
    outcome = run_batch(spark, raw(bad), store, config("r3"), frame_table(spark, frames(date="2025-08-10", activity_id=2001)))
    states = {r["file_name"]: (r["state"], r["error_type"]) for r in outcome.collect()}
    assert states["7_ACTIVITIES_LIST_2025-08-09T12:00:00Z.json"] == ("quarantine", "bad heart rate reading")
    assert states["7_FLOORS_2025-08-10T12:00:00Z.json"] == ("quarantine", "activity not found")
    assert states["7_STEPS_2025-08-11T12:00:00Z.json"] == ("store", None)
    assert states["7_BATTERY_2025-08-12T12:00:00Z.json"] == ("quarantine", "no file type matches")
    assert store.read("activity").count() == 2 and store.read("steps").count() == 2
    assert store.read("etl_result").filter("not success").count() == 6

    store.register_views()
    assert spark.sql("select max(value) from heart_rate").head()[0] == 63


def test_latest_rows_move(spark, raw, table):
    store = Store(spark, scratch_path(spark, "store"))
    for run, date, time in (("a", "2025-08-07", 1500), ("b", "2025-08-09", 1490)):
        files = {
            f"7_RACE_PREDICTIONS_{date}T12:00:00Z.json": {"calendarDate": date, "time5K": time},
            f"7_USER_PROFILE_{date}T12:00:00Z.json": {"full_name": None, "userData": {"weight": time / 20}},
            f"7_PERSONAL_RECORDS_{date}T12:00:00Z.json": [
                {"typeId": 12, "activityId": 1, "prStartTimeGmt": 1754524800000 + time, "value": 1.0}
            ],
        }
        run_batch(spark, raw(files), store, config(run))
    assert table(store.read("race_predictions"), F.col("date").cast("string"), "latest") == [
        ("2025-08-07", False), ("2025-08-09", True),
    ]
    assert table(store.read("user_profile"), "weight", "latest") == [(74.5, True), (75.0, False)]
    assert [r[0] for r in table(store.read("personal_record"), "latest")] == [False, True]


def test_a_second_publish_of_one_version_fails(spark):
    store = Store(spark, scratch_path(spark, "store"))
    store.publish({}, 1)
    with pytest.raises(RuntimeError):
        store.publish({}, 1)


def test_custom_decoder_and_stages(spark, raw):
    from pulsemill.operators.documents import ORIGIN, Decoded

    def decode(docs):
        row = docs.select(
            *ORIGIN, F.lit(0).alias("pos"), "user_id", F.col("file_set_ts").alias("timestamp"),
            F.length("content").alias("value"),
        )
        return Decoded({"heart_rate": row}, [])

    store = Store(spark, scratch_path(spark, "store"))
    settings = config(
        decoders={"HEART_RATE": decode},
        ingest=lambda files: files.withColumn(
            "state", F.when(F.col("file_name").contains("STEPS"), F.lit("ingest")).otherwise(F.lit("process"))
        ),
        store=lambda outcome: outcome.withColumn("state", F.upper("state")),
    )
    files = {"7_HEART_RATE_2025-08-07T12:00:00Z.json": "abcde", "7_STEPS_2025-08-07T12:00:00Z.json": []}
    states = {r["file_name"]: r["state"] for r in run_batch(spark, raw(files), store, settings).collect()}
    assert sorted(states.values()) == ["INGEST", "STORE"]
    assert store.read("heart_rate").head().value == 5


def test_activity_flag_survives_relisting(spark, raw, table):
    store = Store(spark, scratch_path(spark, "store"))
    first = {k: v for k, v in day().items() if "ACTIVIT" in k}
    run_batch(spark, raw(first), store, config("a"), frame_table(spark, frames()))
    again = {"7_ACTIVITIES_LIST_2025-08-08T12:00:00Z.json": [activity(1001, activityName="Renamed")]}
    run_batch(spark, raw(again), store, config("b"))
    assert table(store.read("activity"), "activity_id", "activity_name", "ts_data_available") == [
        (1001, "Renamed", True), (1002, "Outing", False),
    ]


def listing(date, activities, records=()):
    files = {f"7_ACTIVITIES_LIST_{date}T12:00:00Z.json": [activity(i) for i in activities]}
    if records:
        files[f"7_PERSONAL_RECORDS_{date}T12:00:00Z.json"] = [
            {"typeId": 3, "activityId": i, "prStartTimeGmt": 1754524800000 + n, "value": 1.0 + n}
            for n, i in enumerate(records)
        ]
    return files


def fates(spark, raw, files):
    store = Store(spark, scratch_path(spark, "store"))
    outcome = run_batch(spark, raw(files), store, config(), frame_table(spark, []))
    return {r["file_name"]: (r["state"], r["error_type"]) for r in outcome.collect()}


def test_a_failed_set_stays_failed(spark, raw):
    alone = listing("2025-08-07", [5001], [5001, 5001])
    assert set(fates(spark, raw, alone).values()) == {("quarantine", "record type repeated")}
    later = alone | {"7_ACTIVITY_5001_2025-08-09T12:00:00Z.fit": ""}
    states = fates(spark, raw, later)
    assert states.pop("7_ACTIVITY_5001_2025-08-09T12:00:00Z.fit") == ("quarantine", "activity not found")
    assert set(states.values()) == {("quarantine", "record type repeated")}


def test_heart_rate_time_must_be_a_timestamp(spark, raw):
    bad = {"7_HEART_RATE_2025-08-07T12:00:00Z.json": {"heartRateValues": [[100000000000000000, 60]]}}
    assert set(fates(spark, raw, bad).values()) == {("quarantine", "bad heart rate reading")}


def test_only_chunks_by_time_expire(spark, raw):
    from datetime import date

    store = Store(spark, scratch_path(spark, "store"))
    run_batch(spark, raw(day()), store, config(), frame_table(spark, frames()))
    for upkeep in (store.expire, store.compact):
        with pytest.raises(ValueError):
            upkeep("activity", date(2035, 8, 9), 3650)
    assert store.read("activity").count() == 2
    assert store.expire("heart_rate", date(2035, 8, 9), 30) and store.read("heart_rate").count() == 0
