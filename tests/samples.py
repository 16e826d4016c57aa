"""Small documents of every type, in the shapes the devices export."""

FLAGS = [
    "parent", "purposeful", "favorite", "pr", "hasPolyline", "hasImages", "hasVideo", "hasHeatMap",
    "manualActivity", "autoCalcCalories",
]


def activity(activity_id, type_key="running", **extra):
    item = {
        "activityId": activity_id,
        "activityName": "Outing",
        "activityType": {"typeId": 1, "typeKey": type_key},
        "eventType": {"typeId": 9, "typeKey": "race"},
        "startTimeGMT": "2025-08-07T06:00:00.0",
        "startTimeLocal": "2025-08-07T08:30:00.0",
        "endTimeGMT": "2025-08-07T07:00:00.0",
        "duration": 3600.5,
        "averageHR": 150,
        "steps": 9000,
        "vO2MaxValue": 51.5,
        "someNumber": 4.25,
        "someFlag": True,
        "quoted": "5",
        "ownerProfileImageUrlMedium": 3,
        "nested": {"a": 1},
    }
    item.update({flag: False for flag in FLAGS})
    item.update(extra)
    return {k: v for k, v in item.items() if v != "DROP"}


def sleep(start=1754517600000):
    return {
        "dailySleepDTO": {
            "id": 5,
            "sleepStartTimestampGMT": start,
            "sleepEndTimestampGMT": start + 28_800_000,
            "sleepStartTimestampLocal": start + 7_200_000,
            "calendarDate": "2025-08-07",
            "sleepTimeSeconds": 28000,
            "avgOvernightHrv": 99.0,
            "sleepScores": {"overall": {"qualifierKey": "GOOD", "value": 85}},
            "sleepNeed": {"baseline": 480, "actual": 500},
        },
        "wellnessSpO2SleepSummaryDTO": {"numberOfEventsBelowThreshold": 2},
        "sleepMovement": [
            {"startGMT": "2025-08-06T22:30:00.0", "activityLevel": 0.5},
            {"startGMT": None, "activityLevel": 0.7},
        ],
        "sleepRestlessMoments": [{"startGMT": start + 60_000, "value": 1}],
        "wellnessEpochSPO2DataDTOList": [{"epochTimestamp": "2025-08-06T22:31:00.0", "spo2Reading": 95}],
        "hrvData": [{"startGMT": start + 300_000, "value": 41.5}, {"startGMT": 0, "value": 1.0}],
        "breathingDisruptionData": [{"startGMT": start + 600_000, "value": 3}],
        "remSleepData": True,
        "restlessMomentsCount": 12,
    }


T0 = 1754524800000  # 2025-08-07 00:00:00 UTC


def day(user=7, date="2025-08-07", activity_id=1001):
    """A complete file set of one day."""

    def name(kind):
        return f"{user}_{kind}_{date}T12:00:00Z.json"

    return {
        name("USER_PROFILE"): {
            "full_name": "Test User",
            "userData": {"gender": "MALE", "weight": 70.5, "birthDate": "1990-01-01"},
        },
        name("ACTIVITIES_LIST"): [activity(activity_id), activity(activity_id + 1, "road_biking")],
        name("FLOORS"): {"floorValuesArray": [["2025-08-07T00:00:00.0", "2025-08-07T00:15:00.0", 1, 2], ["x"]]},
        name("HEART_RATE"): {"heartRateValues": [[T0, 60], [T0 + 120_000, None], [0, 61], [T0 + 240_000, 63]]},
        name("INTENSITY_MINUTES"): {
            "imValuesArray": [[T0, 2], [T0 + 1, -1]],
            "calendarDate": date,
            "moderateMinutes": 10,
            "vigorousMinutes": None,
            "startDayMinutes": 5,
            "endDayMinutes": 17,
        },
        name("PERSONAL_RECORDS"): [
            {"typeId": 1, "activityId": activity_id, "prStartTimeGmt": T0, "value": 250.5},
            {"typeId": 12, "activityId": 0, "prStartTimeGmt": T0, "value": 20000.0},
            {"typeId": 3, "activityId": 424242, "prStartTimeGmt": T0, "value": 1.0},
        ],
        name("RACE_PREDICTIONS"): {"calendarDate": date, "time5K": 1500, "timeMarathon": 13000},
        name("RESPIRATION"): {"respirationValuesArray": [[T0, 14.5], [T0 + 1, -2.0], [T0]]},
        name("SLEEP"): sleep(),
        name("STEPS"): [
            {"startGMT": "x", "endGMT": "2025-08-07T00:15:00.0", "steps": 0, "primaryActivityLevel": "sedentary"},
            {"startGMT": "x", "endGMT": None, "steps": 3},
        ],
        name("STRESS"): {
            "stressValuesArray": [[T0, 25], [T0 + 180_000, -1]],
            "bodyBatteryValuesArray": [[T0, "MEASURED", 50, 3.0], [T0 + 180_000, "MEASURED", None]],
        },
        name("TRAINING_STATUS"): {
            "mostRecentVO2Max": {
                "generic": {"calendarDate": date, "vo2MaxPreciseValue": 51.5},
                "cycling": {"calendarDate": date, "vo2MaxPreciseValue": 48.0},
                "heatAltitudeAcclimation": {"calendarDate": date, "currentAltitude": 120, "heatTrend": "UP"},
            },
            "mostRecentTrainingLoadBalance": {
                "metricsTrainingLoadBalanceDTOMap": {
                    "9": {"calendarDate": date, "monthlyLoadAnaerobic": 12.5},
                    "1": {"calendarDate": "2000-01-01"},
                }
            },
            "mostRecentTrainingStatus": {
                "latestTrainingStatusData": {
                    "9": {"calendarDate": date, "trainingStatus": 4, "acuteTrainingLoadDTO": None}
                }
            },
        },
        name("TRAINING_READINESS"): [
            {"timestamp": "2025-08-07T05:00:00.0", "timestampLocal": "2025-08-07T07:00:00.0", "score": 71},
            {"score": 1},
        ],
        f"{user}_ACTIVITY_{activity_id}_{date}T12:00:00Z.fit": "",
    }


def frames(user=7, date="2025-08-07", activity_id=1001):
    name = f"{user}_ACTIVITY_{activity_id}_{date}T12:00:00Z.fit"

    def field(label, value=None, kind="float", units=None, items=None):
        return (label, value, items, kind, units)

    stamp = field("timestamp", f"{date}T06:00:01", "datetime")
    rows = [
        (0, "record", [stamp, field("heart_rate", "140", "int", "bpm"), field("unknown_7", "1", "int")]),
        (1, "record", [field("heart_rate", "150", "int", "bpm")]),
        (2, "split", [field("split_type", "run", "string"), field("distance", "5.5", units="m")]),
        (3, "lap", [field("power", "200", units="W"), field("zones", None, "list", "", ["1", None, "3"])]),
        (4, "lap", [field("power", "210", units="W")]),
    ]
    return [(name, activity_id, *row) for row in rows]
