"""Edge rows of every decoder: what is kept, what is dropped, what fails the file."""

import pytest

from pulsemill.operators import activity, frames, profile, sleep, training, wellness
from samples import activity as an_activity
from samples import sleep as a_night

T = 1640995200000


def rules(table, decoded):
    found = decoded.failures[0]
    for more in decoded.failures[1:]:
        found = found.unionByName(more)
    return {f"{name}: {rule}" for name, rule in table(found, "file_name", "rule")}


def test_heart_rate(docs, table):
    decoded = wellness.decode_heart_rate(
        docs(
            {"heartRateValues": [[T, 60], [T + 1, None], [0, 61], [None, 62]]},
            {"heartRateValues": None}, {}, {"heartRateValues": [[T]]}, {"heartRateValues": [[T, "fast"]]},
            {"heartRateValues": 5}, "{broken",
        )
    )
    assert table(decoded.rows["heart_rate"].filter("file_name = 'doc0'"), "value") == [(60,)]
    assert rules(table, decoded) == {
        "doc3: bad heart rate reading", "doc4: bad heart rate reading", "doc5: unreadable document",
        "doc6: unreadable document",
    }


def test_stress_and_body_battery(docs, table):
    decoded = wellness.decode_stress(
        docs(
            {"stressValuesArray": [[T, 25], [T, -1], [T]], "bodyBatteryValuesArray": [[T, "M", 5], [T, "M", None], [T, 1]]},
            {"stressValuesArray": [[T, None]]}, {"bodyBatteryValuesArray": None}, {},
        )
    )
    assert table(decoded.rows["stress"], "value") == [(25,)]
    assert table(decoded.rows["body_battery"], "value") == [(5,), (None,)]
    assert rules(table, decoded) == {"doc1: bad stress reading", "doc2: bodyBatteryValuesArray is null"}


def test_respiration(docs, table):
    decoded = wellness.decode_respiration(
        docs({"respirationValuesArray": [[T, 14.5], [T, -2.0], [T]]}, {"respirationValuesArray": [[T, None]]})
    )
    assert table(decoded.rows["respiration"], "value") == [(14.5,)]
    assert rules(table, decoded) == {"doc1: bad respiration reading"}


def test_intensity(docs, table):
    decoded = wellness.decode_intensity(
        docs(
            {"imValuesArray": [[T, 2]], "calendarDate": "2022-01-01", "startDayMinutes": 4, "endDayMinutes": 9},
            {"calendarDate": "2022-01-01", "startDayMinutes": 4}, {"moderateMinutes": 3},
            {"calendarDate": "2022-01-01", "moderateMinutes": "many"},
        )
    )
    assert table(decoded.rows["training_load.intensity"], "moderate_minutes", "total_intensity_minutes") == [(None, 5)]
    assert rules(table, decoded) == {"doc3: bad intensity minutes"}


def test_floors_and_steps(docs, table):
    floors = wellness.decode_floors(
        docs({"floorValuesArray": [["a", "2022-01-01T00:15:00.0Z", 1, 2], ["a", "b"]]}, {"floorValuesArray": [["a", None, 1, 2]]})
    )
    assert table(floors.rows["floors"].filter("file_name = 'doc0'"), "ascended", "descended") == [(1, 2)]
    assert rules(table, floors) == {"doc1: bad floors reading"}
    steps = wellness.decode_steps(
        docs([{"endGMT": "2022-01-01T00:15:00.0", "steps": 0}, {"steps": 3}, {"endGMT": "2022-01-01T00:30:00.0"}], [], {"a": 1})
    )
    assert table(steps.rows["steps"].filter("file_name = 'doc0'"), "value") == [(0,)]


def test_sleep(docs, table):
    def changed(change):
        night = a_night()
        change(night)
        return night

    decoded = sleep.decode_sleep(
        docs(
            a_night(), {}, {"dailySleepDTO": {}},
            changed(lambda n: n["dailySleepDTO"].pop("sleepEndTimestampGMT")),
            changed(lambda n: n["dailySleepDTO"].update(sleepStartTimestampGMT=None)),
            changed(lambda n: n["dailySleepDTO"].update(sleepStartTimestampLocal=None)),
            changed(lambda n: n["dailySleepDTO"].update(sleepNeed=None)),
            changed(lambda n: n["sleepMovement"].append({"activityLevel": 1.0})),
            changed(lambda n: n["dailySleepDTO"].update(awakeCount="some")),
        )
    )
    assert rules(table, decoded) == {
        "doc3: sleep time missing", "doc5: local sleep start is null", "doc6: sleep object is null",
        "doc7: bad sleep_movement element", "doc8: bad sleep value",
    }
    night = decoded.rows["sleep"].filter("file_name = 'doc0'").head()
    assert (night.timezone_offset_hours, night.avg_overnight_hrv, night.sleep_need_actual) == (2.0, None, 500)
    for name, size in {"sleep_movement": 1, "sleep_restless_moment": 1, "spo2": 1, "hrv": 1, "breathing_disruption": 1}.items():
        assert decoded.rows[name].filter("file_name = 'doc0'").count() == size


def test_activities(docs, table):
    decoded = activity.decode_activities(
        docs(
            [an_activity(1), an_activity(2, "swimming_lap", strokes=7)], [], {"a": 1}, [an_activity(3, pr="DROP")],
            [an_activity(4, endTimeGMT="DROP")], [an_activity(5, endTimeGMT=None, duration="DROP")],
            [an_activity(6, calories="lots")],
        )
    )
    found = rules(table, decoded)
    assert {"doc2: activities document is not an array", "doc3: activity field missing", "doc5: bad activity time",
            "doc6: bad activity value"} <= found
    assert not [f for f in found if f.startswith(("doc0", "doc1", "doc4"))]
    rest = table(decoded.rows["supplemental_activity_metric"].filter("file_name = 'doc0'"), "activity_id", "metric", "value")
    assert rest == [
        (1, "some_flag", 1.0), (1, "some_number", 4.25), (2, "some_flag", 1.0), (2, "some_number", 4.25),
        (2, "steps", 9000.0), (2, "v_o2_max_value", 51.5),
    ]


def test_training_status(docs, table):
    device = {"calendarDate": "2022-01-03", "monthlyLoadAnaerobic": 1.5}
    decoded = training.decode_training_status(
        docs(
            {
                "mostRecentVO2Max": {"generic": {"calendarDate": "2022-01-01", "vo2MaxPreciseValue": 50.5}, "cycling": None},
                "mostRecentTrainingLoadBalance": {"metricsTrainingLoadBalanceDTOMap": {"z": device, "a": {}}},
                "mostRecentTrainingStatus": {"latestTrainingStatusData": {"1": {"calendarDate": "2022-01-04", "acuteTrainingLoadDTO": None}}},
            },
            {}, {"mostRecentVO2Max": {"generic": {"calendarDate": "late"}}},
        )
    )
    assert decoded.rows["vo2_max.cycling"].count() == 0
    assert table(decoded.rows["training_load.balance"], "monthly_load_anaerobic") == [(1.5,)]
    assert decoded.rows["training_load.status"].head().acwr_percent is None
    assert rules(table, decoded) == {"doc2: bad training date"}


def test_readiness(docs, table):
    stamp = "2022-01-01T06:00:00.0"
    decoded = training.decode_training_readiness(
        docs(
            [{"timestamp": stamp, "timestampLocal": "2022-01-01T11:45:00.0", "score": 5}, {"score": 1, "odd": 2}],
            [{"timestamp": stamp, "odd": 2}], [{"timestamp": stamp}, {"timestamp": stamp}], [{"timestamp": stamp, "score": "x"}],
        )
    )
    assert table(decoded.rows["training_readiness"].filter("file_name = 'doc0'"), "timezone_offset_hours", "score") == [(5.75, 5)]
    assert rules(table, decoded) == {
        "doc1: unknown readiness field", "doc2: readiness time repeated", "doc3: bad readiness value",
    }


def test_records_and_predictions(docs, table):
    decoded = training.decode_personal_records(
        docs(
            [{"typeId": 1, "activityId": 5, "prStartTimeGmt": T}, {"typeId": 99, "activityId": 6, "prStartTimeGmt": T},
             {"typeId": 14, "activityId": 7, "prStartTimeGmt": T}],
            [{"typeId": 1, "prStartTimeGmt": T}], None,
        )
    )
    assert table(decoded.rows["personal_record"].filter("file_name = 'doc0'"), "activity_id", "label") == [
        (5, "Run: 1 km"), (6, None), (None, "Steps: Most in a Month"),
    ]
    assert rules(table, decoded) == {"doc1: bad personal record"}
    races = training.decode_race_predictions(docs({"calendarDate": "2022-01-01", "time5K": 1}, {}, {"time5K": 1}))
    assert races.rows["race_predictions"].filter("date is not null").count() == 1
    assert rules(table, races) == {"doc2: race date missing"}


def test_profile(docs, table):
    decoded = profile.decode_user_profile(
        docs({"full_name": "A", "userData": {"gender": "", "birthDate": ""}}, {"full_name": "B"}, {"userData": {"birthDate": "soon"}})
    )
    assert table(decoded.rows["user_profile"].filter("file_name = 'doc0'"), "gender") == [(None,)]
    assert rules(table, decoded) == {"doc1: userData missing", "doc2: bad birth date"}


@pytest.mark.parametrize("name,expected", [("dist", [("dist", 5.5)]), ("unknown_1", []), ("split_type", [])])
def test_split_fields(spark, table, name, expected):
    fields = [("split_type", "run", None, "string", None), (name, "5.5", None, "float", "m")]
    rows = frames.unpivot_split_frames(spark.createDataFrame([(1, 0, "split", fields)], frames.FRAMES))
    assert table(rows, "name", "value") == expected


def test_list_fields_stop_at_the_first_bad_element(spark, table):
    fields = [("zone", None, ["1", None, "2", "bad", "4"], "list", "")]
    frame = spark.createDataFrame([(1, 0, "lap", fields), (1, 70_000, "lap", fields)], frames.FRAMES)
    assert table(frames.unpivot_lap_frames(frame), "lap_idx", "name", "value", "units") == [
        (1, "zone_1", 1.0, None), (1, "zone_3", 2.0, None), (2, "zone_1", 1.0, None), (2, "zone_3", 2.0, None),
    ]
    twice = spark.createDataFrame([(1, 0, "lap", [("a", "1", None, "int", None)] * 2)], frames.FRAMES)
    assert twice.select(frames.repeats_a_metric()).head()[0] is True
