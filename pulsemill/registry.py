"""Data types of the mailbox: names, time parameter, extension, and the order inside a file set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Data types in matching order, with the time parameter of their request.
DATA_TYPES = {
    "SLEEP": "daily",
    "STRESS": "daily",
    "RESPIRATION": "daily",
    "HEART_RATE": "daily",
    "TRAINING_READINESS": "daily",
    "TRAINING_STATUS": "daily",
    "STEPS": "daily",
    "FLOORS": "daily",
    "INTENSITY_MINUTES": "daily",
    "ACTIVITIES_LIST": "range",
    "PERSONAL_RECORDS": "no_date",
    "RACE_PREDICTIONS": "no_date",
    "USER_PROFILE": "no_date",
    "ACTIVITY": "range",
}

# Order in which the files of one set take effect.
PROCESS_ORDER = [
    "USER_PROFILE",
    "ACTIVITIES_LIST",
    "FLOORS",
    "HEART_RATE",
    "INTENSITY_MINUTES",
    "PERSONAL_RECORDS",
    "RACE_PREDICTIONS",
    "RESPIRATION",
    "SLEEP",
    "STEPS",
    "STRESS",
    "TRAINING_STATUS",
    "TRAINING_READINESS",
    "ACTIVITY",
]

# Labels of personal record types, and the types that belong to no activity.
RECORD_LABELS = {
    1: "Run: 1 km",
    2: "Run: 1 mile",
    3: "Run: 5 km",
    4: "Run: 10 km",
    7: "Run: Longest",
    8: "Bike: Longest",
    9: "Bike: Max Total Ascent",
    10: "Bike: 20 min Avg Power",
    11: "Bike: 40 km",
    12: "Steps: Most in a Day",
    13: "Steps: Most in a Week",
    14: "Steps: Most in a Month",
    15: "Steps: Longest Goal Streak",
    16: "Steps: Unknown Type",
    17: "Swim: Longest",
    18: "Swim: 100 m",
    19: "Swim: 100 yd",
    20: "Swim: 400 m",
    21: "Swim: 500 yd",
    22: "Swim: 750 m",
    23: "Swim: 1000 m",
    24: "Swim: 1000 yd",
    25: "Swim: 1500 m",
    26: "Swim: 1650 yd",
}
RECORDS_WITHOUT_ACTIVITY = [12, 13, 14, 15, 16]


def extension(data_type: str) -> str:
    return "fit" if data_type == "ACTIVITY" else "json"


def file_patterns() -> dict[str, str]:
    """File name pattern per type, in matching order."""
    return {name: rf".*_{name}_.*\.{extension(name)}$" for name in DATA_TYPES}


def type_rank(data_type: Column) -> Column:
    """Position of a type inside its file set; an unlisted type comes last."""
    rank = F.lit(len(PROCESS_ORDER) + 1)
    for position in range(len(PROCESS_ORDER), 0, -1):
        rank = F.when(data_type == PROCESS_ORDER[position - 1], F.lit(position)).otherwise(rank)
    return rank


def chosen_types(names: Sequence[str] | None) -> list[str]:
    """None means all types, an empty list means none; unknown names are an error."""
    if names is None:
        return list(DATA_TYPES)
    wrong = [name for name in names if name not in DATA_TYPES]
    if wrong:
        raise ValueError(f"unknown data types {wrong}; known are {sorted(DATA_TYPES)}")
    return list(names)
