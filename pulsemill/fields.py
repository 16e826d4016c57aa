"""Field lists of the documents: JSON name, column name, column kind.

All lists are fixed values: they state what the documents call a field and where it is stored. A
column name is the snake-case form of the JSON name unless a third word states another one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pulsemill.functions.scalars import snake_name


@dataclass(frozen=True)
class Field:
    json: str
    column: str
    kind: str


def listed(text: str) -> list[Field]:
    """One field per line: JSON name, kind, and the column name where it is irregular."""
    out = []
    for line in text.strip().splitlines():
        json, kind, *column = line.split()
        out.append(Field(json, column[0] if column else snake_name(json), kind))
    return out


USER_DATA = listed("""
gender string
weight double
height double
vo2MaxRunning double vo2_max_running
vo2MaxCycling double vo2_max_cycling
lactateThresholdSpeed double
lactateThresholdHeartRate int
moderateIntensityMinutesHrZone int
vigorousIntensityMinutesHrZone int
""")

ACTIVITY_KEYS = ["activityId", "activityType", "eventType", "startTimeGMT", "startTimeLocal"]

ACTIVITY_REQUIRED = listed("""
parent boolean
purposeful boolean
favorite boolean
pr boolean
hasPolyline boolean
hasImages boolean
hasVideo boolean
hasHeatMap boolean
manualActivity boolean
autoCalcCalories boolean
""")

ACTIVITY_OPTIONAL = listed("""
averageHR double average_hr
maxHR double max_hr
duration double
distance double
calories double
activityName string
deviceId bigint
timeZoneId int
manufacturer string
hasSplits boolean
elevationCorrected boolean
atpActivity boolean
elapsedDuration double
movingDuration double
lapCount int
averageSpeed double
maxSpeed double
startLatitude double
startLongitude double
endLatitude double
endLongitude double
locationName string
aerobicTrainingEffect double
aerobicTrainingEffectMessage string
anaerobicTrainingEffect double
anaerobicTrainingEffectMessage string
trainingEffectLabel string
activityTrainingLoad double
differenceBodyBattery int
moderateIntensityMinutes int
vigorousIntensityMinutes int
bmrCalories double
waterEstimated double
hrTimeInZone_1 double
hrTimeInZone_2 double
hrTimeInZone_3 double
hrTimeInZone_4 double
hrTimeInZone_5 double
""")

SWIMMING = listed("""
averageSwimCadenceInStrokesPerMinute double avg_swim_cadence
averageSwolf double avg_swolf
poolLength double
activeLengths int
strokes double
avgStrokeDistance double
avgStrokes double
""")

_POWER_CURVE = [1, 2, 5, 10, 20, 30, 60, 120, 300, 600, 1200, 1800, 3600, 7200, 18000]


def _numbered(name: str, numbers, kind: str = "double") -> list[Field]:
    return [Field(f"{name}_{n}", f"{snake_name(name)}_{n}", kind) for n in numbers]


_ENVIRONMENT = listed("""
minTemperature double
maxTemperature double
elevationGain double
elevationLoss double
minElevation double
maxElevation double
minRespirationRate double
maxRespirationRate double
avgRespirationRate double
""")

CYCLING = (
    listed("""
vO2MaxValue double vo2_max_value
normPower double normalized_power
averageBikingCadenceInRevPerMinute double avg_biking_cadence
maxBikingCadenceInRevPerMinute double max_biking_cadence
max20MinPower double max_20min_power
trainingStressScore double
intensityFactor double
avgPower double
maxPower double
avgLeftBalance double
""")
    + _numbered("maxAvgPower", _POWER_CURVE)
    + _numbered("powerTimeInZone", range(1, 8))
    + _ENVIRONMENT
)

RUNNING = (
    listed("""
vO2MaxValue double vo2_max_value
normPower double normalized_power
averageRunningCadenceInStepsPerMinute double avg_running_cadence
maxRunningCadenceInStepsPerMinute double max_running_cadence
steps int
maxDoubleCadence double
avgVerticalOscillation double
avgGroundContactTime double
avgStrideLength double
avgVerticalRatio double
avgGroundContactBalance double
avgPower double
maxPower double
""")
    + _numbered("powerTimeInZone", range(1, 6))
    + _ENVIRONMENT
)

SPORTS = {"running": RUNNING, "cycling": CYCLING, "swimming": SWIMMING}

SLEEP_DAILY = listed("""
sleepQualityTypePK bigint sleep_quality_type_pk
sleepResultTypePK bigint sleep_result_type_pk
averageSpO2Value double average_spo2
lowestSpO2Value int lowest_spo2
highestSpO2Value int highest_spo2
averageSpO2HRSleep double average_spo2_hr_sleep
averageRespirationValue double average_respiration
lowestRespirationValue double lowest_respiration
highestRespirationValue double highest_respiration
calendarDate string
sleepVersion int
ageGroup string
respirationVersion int
sleepTimeSeconds int
napTimeSeconds int
unmeasurableSleepSeconds int
deepSleepSeconds int
lightSleepSeconds int
remSleepSeconds int
awakeSleepSeconds int
awakeCount int
sleepWindowConfirmed boolean
sleepWindowConfirmationType string
retro boolean
sleepFromDevice boolean
deviceRemCapable boolean
skinTempDataExists boolean
avgSleepStress double
breathingDisruptionSeverity string
hrvStatus string
restingHeartRate int
sleepScoreFeedback string
sleepScoreInsight string
sleepScorePersonalizedInsight string
""")

# JSON object, wanted part of it, column, kind.
SLEEP_SCORES = [
    ("totalDuration", "qualifierKey", "total_duration_key", "string"),
    ("stress", "qualifierKey", "stress_key", "string"),
    ("awakeCount", "qualifierKey", "awake_count_key", "string"),
    ("restlessness", "qualifierKey", "restlessness_key", "string"),
    ("overall", "qualifierKey", "score_overall_key", "string"),
    ("overall", "value", "score_overall_value", "int"),
    ("lightPercentage", "qualifierKey", "light_pct_key", "string"),
    ("lightPercentage", "value", "light_pct_value", "int"),
    ("deepPercentage", "qualifierKey", "deep_pct_key", "string"),
    ("deepPercentage", "value", "deep_pct_value", "int"),
    ("remPercentage", "qualifierKey", "rem_pct_key", "string"),
    ("remPercentage", "value", "rem_pct_value", "int"),
]

SLEEP_NEED = listed("""
baseline int baseline
actual int actual
feedback string feedback
trainingFeedback string training_feedback
sleepHistoryAdjustment string history_adj
hrvAdjustment string hrv_adj
napAdjustment string nap_adj
""")

SLEEP_SPO2_SUMMARY = listed("""
numberOfEventsBelowThreshold int
durationOfEventsBelowThreshold int
""")

SLEEP_ROOT = listed("""
restlessMomentsCount int
avgOvernightHrv double
bodyBatteryChange int
remSleepData boolean
""")

ACCLIMATION = listed("""
heatAcclimationPercentage double
altitudeAcclimation double
currentAltitude double
acclimationPercentage double
altitudeTrend string
heatTrend string
""")

LOAD_BALANCE = listed("""
trainingBalanceFeedbackPhrase string
monthlyLoadAerobicLow double
monthlyLoadAerobicHigh double
monthlyLoadAnaerobic double
monthlyLoadAerobicLowTargetMin double
monthlyLoadAerobicLowTargetMax double
monthlyLoadAerobicHighTargetMin double
monthlyLoadAerobicHighTargetMax double
monthlyLoadAnaerobicTargetMin double
monthlyLoadAnaerobicTargetMax double
""")

LOAD_RATIO = listed("""
acwrPercent double
acwrStatus string
acwrStatusFeedback string
dailyTrainingLoadAcute double
maxTrainingLoadChronic double
minTrainingLoadChronic double
dailyTrainingLoadChronic double
dailyAcuteChronicWorkloadRatio double
""")

LOAD_STATUS = listed("""
trainingStatus int
trainingStatusFeedbackPhrase string
""")

INTENSITY_TOTALS = ["moderate_minutes", "vigorous_minutes", "total_intensity_minutes"]

READINESS_SKIPPED = ["userProfilePK", "calendarDate", "timestampLocal", "deviceId", "timestamp"]

READINESS = listed("""
level string
feedbackLong string
feedbackShort string
score int
sleepScore int
sleepScoreFactorPercent int
sleepScoreFactorFeedback string
recoveryTime int
recoveryTimeFactorPercent int
recoveryTimeFactorFeedback string
acwrFactorPercent int
acwrFactorFeedback string
acuteLoad int
stressHistoryFactorPercent int
stressHistoryFactorFeedback string
hrvFactorPercent int
hrvFactorFeedback string
hrvWeeklyAverage int
sleepHistoryFactorPercent int
sleepHistoryFactorFeedback string
validSleep boolean
inputContext string
primaryActivityTracker boolean
recoveryTimeChangePhrase string
sleepHistoryFactorFeedbackPhrase string
hrvFactorFeedbackPhrase string
stressHistoryFactorFeedbackPhrase string
acwrFactorFeedbackPhrase string
recoveryTimeFactorFeedbackPhrase string
sleepScoreFactorFeedbackPhrase string
""")

RACE_TIMES = listed("""
time5K double time_5k
time10K double time_10k
timeHalfMarathon double time_half_marathon
timeMarathon double time_marathon
""")
