"""The stored tables: columns, keys, and how a run writes them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from pulsemill import fields as fl

APPEND, IGNORE, UPDATE, GROUPS, LATEST, LATEST_IGNORE = (
    "append", "ignore", "update", "groups", "latest", "latest_ignore",
)


@dataclass(frozen=True)
class Table:
    name: str
    columns: str
    keys: tuple[str, ...]
    policy: str
    audited: str = "insert"
    # Column the storage chunk is taken from: a DATE or TIMESTAMP is cut into 7-day chunks, an id
    # into ranges. It is part of the key, so that a key never changes its chunk.
    chunk_on: str | None = None
    segment: str | None = None
    preserve: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    parent: tuple[str, str] | None = None

    @property
    def schema(self) -> T.StructType:
        stamps = "create_ts timestamp" + (", update_ts timestamp" if self.audited == "update" else "")
        return T.StructType.fromDDL(f"{self.columns}, {stamps}")

    @property
    def names(self) -> list[str]:
        return self.schema.fieldNames()


def _cols(*parts) -> str:
    out = []
    for part in parts:
        out += [part] if isinstance(part, str) else [f"{f.column} {f.kind}" for f in part]
    return ", ".join(out)


def _series(name: str, owner: str, parent: str, value: str) -> Table:
    return Table(
        name,
        f"{owner} bigint, timestamp timestamp, {value}",
        (owner, "timestamp"),
        IGNORE,
        chunk_on="timestamp",
        segment=owner,
        required=(owner, "timestamp"),
        parent=(parent, owner),
    )


_SCORES = ", ".join(f"{column} {kind}" for _, _, column, kind in fl.SLEEP_SCORES)
_NEED = ", ".join(
    f"{prefix}_{f.column} {f.kind}" for prefix in ("sleep_need", "next_sleep_need") for f in fl.SLEEP_NEED
)
_ACTIVITY_REQUIRED = (
    "user_id", "activity_type_id", "activity_type_key", "event_type_id", "event_type_key",
    "start_ts", "end_ts", "timezone_offset_hours",
    *[f.column for f in fl.ACTIVITY_REQUIRED],
)

TABLES = {
    table.name: table
    for table in [
        Table("user", "user_id bigint, full_name string, birth_date date", ("user_id",), IGNORE),
        Table(
            "user_profile",
            _cols("user_profile_id bigint, user_id bigint", fl.USER_DATA, "latest boolean"),
            ("user_profile_id",),
            LATEST,
            required=("user_id", "latest"),
            parent=("user", "user_id"),
        ),
        Table(
            "activity",
            _cols(
                "activity_id bigint, user_id bigint, activity_type_id int, activity_type_key string",
                "event_type_id int, event_type_key string, start_ts timestamp, end_ts timestamp",
                "timezone_offset_hours double",
                fl.ACTIVITY_REQUIRED,
                fl.ACTIVITY_OPTIONAL,
                "ts_data_available boolean",
            ),
            ("activity_id",),
            UPDATE,
            audited="update",
            chunk_on="activity_id",
            preserve=("ts_data_available",),
            required=_ACTIVITY_REQUIRED,
            parent=("user", "user_id"),
        ),
        *[
            Table(
                f"{sport}_agg_metrics",
                _cols("activity_id bigint", columns),
                ("activity_id",),
                UPDATE,
                audited="update",
                chunk_on="activity_id",
                parent=("activity", "activity_id"),
            )
            for sport, columns in fl.SPORTS.items()
        ],
        Table(
            "supplemental_activity_metric",
            "activity_id bigint, metric string, value double",
            ("activity_id", "metric"),
            UPDATE,
            audited="update",
            chunk_on="activity_id",
            parent=("activity", "activity_id"),
        ),
        Table(
            "sleep",
            _cols(
                "sleep_id bigint, user_id bigint, start_ts timestamp, end_ts timestamp",
                "timezone_offset_hours double",
                fl.SLEEP_DAILY,
                _SCORES,
                _NEED,
                fl.SLEEP_SPO2_SUMMARY,
                fl.SLEEP_ROOT,
            ),
            ("user_id", "start_ts"),
            UPDATE,
            audited="update",
            chunk_on="start_ts",
            preserve=("sleep_id",),
            required=("sleep_id", "user_id", "start_ts", "end_ts", "timezone_offset_hours"),
            parent=("user", "user_id"),
        ),
        _series("sleep_movement", "sleep_id", "sleep", "activity_level double"),
        _series("sleep_restless_moment", "sleep_id", "sleep", "value int"),
        _series("spo2", "sleep_id", "sleep", "value int"),
        _series("hrv", "sleep_id", "sleep", "value double"),
        _series("breathing_disruption", "sleep_id", "sleep", "value int"),
        Table(
            "vo2_max",
            "user_id bigint, date date, vo2_max_generic double, vo2_max_cycling double",
            ("user_id", "date"),
            GROUPS,
            audited="update",
            chunk_on="date",
            parent=("user", "user_id"),
        ),
        Table(
            "acclimation",
            _cols("user_id bigint, date date", fl.ACCLIMATION),
            ("user_id", "date"),
            UPDATE,
            audited="update",
            chunk_on="date",
            parent=("user", "user_id"),
        ),
        Table(
            "training_load",
            _cols(
                "user_id bigint, date date",
                fl.LOAD_BALANCE,
                fl.LOAD_RATIO,
                fl.LOAD_STATUS,
                [fl.Field(c, c, "int") for c in fl.INTENSITY_TOTALS],
            ),
            ("user_id", "date"),
            GROUPS,
            audited="update",
            chunk_on="date",
            parent=("user", "user_id"),
        ),
        Table(
            "training_readiness",
            _cols("user_id bigint, timestamp timestamp, timezone_offset_hours double", fl.READINESS),
            ("user_id", "timestamp"),
            UPDATE,
            audited="update",
            chunk_on="timestamp",
            required=("user_id", "timestamp", "timezone_offset_hours"),
            parent=("user", "user_id"),
        ),
        _series("stress", "user_id", "user", "value int"),
        _series("body_battery", "user_id", "user", "value int"),
        _series("heart_rate", "user_id", "user", "value int"),
        _series(
            "steps", "user_id", "user", "value int, activity_level string, activity_level_constant boolean"
        ),
        _series("respiration", "user_id", "user", "value double"),
        _series("intensity_minutes", "user_id", "user", "value double"),
        _series("floors", "user_id", "user", "ascended int, descended int"),
        Table(
            "personal_record",
            "user_id bigint, activity_id bigint, timestamp timestamp, type_id int, label string, "
            "value double, latest boolean",
            ("user_id", "type_id", "timestamp"),
            LATEST,
            required=("user_id", "type_id", "timestamp", "latest"),
            parent=("activity", "activity_id"),
        ),
        Table(
            "race_predictions",
            _cols("user_id bigint, date date", fl.RACE_TIMES, "latest boolean"),
            ("user_id", "date"),
            LATEST_IGNORE,
            required=("user_id", "date", "latest"),
        ),
        Table(
            "activity_ts_metric",
            "activity_id bigint, timestamp timestamp, name string, value double, units string",
            (),
            APPEND,
            chunk_on="timestamp",
            segment="activity_id",
            required=("activity_id", "timestamp", "name"),
            parent=("activity", "activity_id"),
        ),
        Table(
            "activity_split_metric",
            "activity_id bigint, split_idx int, split_type string, name string, value double, units string",
            ("activity_id", "split_idx", "name"),
            APPEND,
            chunk_on="activity_id",
            parent=("activity", "activity_id"),
        ),
        Table(
            "activity_lap_metric",
            "activity_id bigint, lap_idx int, name string, value double, units string",
            ("activity_id", "lap_idx", "name"),
            APPEND,
            chunk_on="activity_id",
            parent=("activity", "activity_id"),
        ),
        Table(
            "etl_result",
            "dag_id string, dag_run_id string, dag_start_date timestamp, file_name string, "
            "success boolean, error_type string, traceback string",
            ("dag_id", "dag_run_id", "dag_start_date", "file_name"),
            UPDATE,
            audited="update",
            chunk_on="dag_start_date",
            required=("success",),
        ),
    ]
}

# Writers of the tables whose rows are filled by several documents.
COLUMN_GROUPS = {
    "vo2_max": {"generic": ["vo2_max_generic"], "cycling": ["vo2_max_cycling"]},
    "training_load": {
        "balance": [f.column for f in fl.LOAD_BALANCE],
        "status": [f.column for f in fl.LOAD_RATIO + fl.LOAD_STATUS],
        "intensity": fl.INTENSITY_TOTALS,
    },
}
LATEST_PER = {
    "user_profile": ["user_id"],
    "personal_record": ["user_id", "type_id"],
    "race_predictions": ["user_id"],
}
# The 13 series cut into chunks by time, with their segment and the order inside a segment.
SERIES = {t.name: t.segment for t in TABLES.values() if t.segment}
