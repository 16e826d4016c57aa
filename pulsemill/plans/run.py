"""One run: raw documents and decoded frames in, tables and file outcomes out.

All file sets of a run are processed at once. Their sequential effect is kept by one total order,
(set time, type rank, file name, position): insert-ignore keeps the first row of that order, updates
the last one. A set that breaks any rule gives no rows at all.

The raw files are read once: parsed names and contents are staged as Parquet, one folder per type, so
that each decoder reads only its own documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.functions.names import parse_activity_filename
from pulsemill.operators import activity, constraints, frames, merge, profile, sleep, training, wellness
from pulsemill.operators.documents import ORDER, ORIGIN, Decoded
from pulsemill.plans.skew import skew_join
from pulsemill.registry import RECORDS_WITHOUT_ACTIVITY
from pulsemill.schema import (
    APPEND,
    COLUMN_GROUPS,
    GROUPS,
    IGNORE,
    LATEST,
    LATEST_IGNORE,
    LATEST_PER,
    TABLES,
)
from pulsemill.session import remove_folder, scratch_path
from pulsemill.sources import ledger
from pulsemill.sources.mailbox import with_origin
from pulsemill.sources.store import WHOLE, Store, added, replaced

JOBS_AT_ONCE = 8


class Decoder(Protocol):
    """A decoder of one file type: documents in, rows per table and failures out."""

    def __call__(self, docs: DataFrame) -> Decoded: ...


DECODERS: dict[str, Decoder] = {
    "USER_PROFILE": profile.decode_user_profile,
    "ACTIVITIES_LIST": activity.decode_activities,
    "FLOORS": wellness.decode_floors,
    "HEART_RATE": wellness.decode_heart_rate,
    "INTENSITY_MINUTES": wellness.decode_intensity,
    "PERSONAL_RECORDS": training.decode_personal_records,
    "RACE_PREDICTIONS": training.decode_race_predictions,
    "RESPIRATION": wellness.decode_respiration,
    "SLEEP": sleep.decode_sleep,
    "STEPS": wellness.decode_steps,
    "STRESS": wellness.decode_stress,
    "TRAINING_STATUS": training.decode_training_status,
    "TRAINING_READINESS": training.decode_training_readiness,
}

# A stage of a run that a caller may replace, with any extra arguments bound beforehand.
Stage = Callable[[DataFrame], DataFrame]


@dataclass
class RunConfig:
    dag_id: str
    dag_run_id: str
    dag_start_date: str
    store_format: str | None = None
    process_format: str | None = None
    decoders: dict[str, Decoder] = field(default_factory=lambda: dict(DECODERS))
    prepare: Stage | None = None
    ingest: Stage | None = None
    store: Stage | None = None


def run_batch(
    spark: SparkSession,
    raw: DataFrame,
    store: Store,
    config: RunConfig,
    decoded_frames: DataFrame | None = None,
    progress: tuple[str, list[str]] | None = None,
) -> DataFrame:
    """Process the raw documents, publish all tables at once, and return one row per file:
    file_name, state, success, error_type. `decoded_frames` holds the frames of the activity files,
    by file name. `progress`, a stream's name and marks, becomes visible together with the tables."""
    work = Workspace(spark, scratch_path(spark, "run"))
    run, version, manifest = uuid.uuid4().hex, store.version(), store.manifest()
    files = _stage_files(work, raw, config)
    taken = files.filter(F.col("state") == "process")
    decoded, findings = _decode(taken, config)
    parts = together(spark, {name: partial(work.save, rows, f"rows-{name}") for name, rows in decoded.items()})
    findings = work.save(_with_constraints(findings, parts), "findings")
    fit = _activity_files(work, taken, decoded_frames)
    known = store.read("activity", manifest=manifest).select("activity_id")
    failed, n_failed, visible = _failed_sets(work, known, parts, findings, fit)
    good = taken.filter("user_id is not null")
    if visible is not None:
        parts["personal_record"] = visible
    if n_failed:
        parts = {name: without_sets(rows, failed) for name, rows in parts.items()}
        fit, good = without_sets(fit, failed), without_sets(good, failed)

    now = F.lit(config.dag_start_date).cast("timestamp")
    target = Target(store, manifest, run, now)
    merged = [name for name in TABLES if name not in ("user", "activity", "etl_result")]
    together(
        spark,
        {
            "user": partial(_write_users, target, good, parts),
            "activity": partial(_write_activities, work, target, parts, fit, decoded_frames),
            **{name: partial(_write_table, target, name, parts) for name in merged},
        },
    )
    outcome = work.save(_outcome(files, failed), "outcome")
    if config.store:
        outcome = config.store(outcome)
    _write_results(target, config, outcome)
    if progress:
        store.mark(manifest, *progress)
    store.publish(manifest, version + 1)
    work.clear(keep="outcome")
    return outcome


def _with_constraints(findings: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """Broken rules of the files, and rows without a key or required column of their table."""
    for name, rows in parts.items():
        broken = constraints.null_findings(rows, TABLES[name.split(".")[0]])
        if broken is not None:
            findings = findings.unionByName(broken)
    return findings


def together(spark: SparkSession, tasks: dict[str, Callable]) -> dict:
    """Run independent Spark jobs side by side: one small table must not keep the cluster waiting."""
    with ThreadPoolExecutor(max_workers=JOBS_AT_ONCE) as pool:
        bind = inheritable_thread_target(spark)
        running = {name: pool.submit(bind(task)) for name, task in tasks.items()}
        return {name: job.result() for name, job in running.items()}


@dataclass
class Workspace:
    """Written intermediate frames: they cut the lineage and outlive a lost executor."""

    spark: SparkSession
    folder: str
    names: list[str] = field(default_factory=list)

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        self.names.append(name)
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def clear(self, keep: str) -> None:
        """Delete all but one of the frames."""
        for name in self.names:
            if name != keep:
                remove_folder(self.spark, f"{self.folder}/{name}")


@dataclass
class Target:
    """Where one run writes: the store, the manifest in the making, run id and run time."""

    store: Store
    manifest: dict
    run: str
    now: Column

    def stored(self, name: str, chunks: list[str] | None = None) -> DataFrame:
        return self.store.read(name, chunks, self.manifest).select(*TABLES[name].names)

    def replace(self, name: str, touched: list[str], rows: DataFrame) -> None:
        replaced(self.manifest, name, touched, self.store.write(name, rows, self.run))

    def add(self, name: str, rows: DataFrame) -> None:
        added(self.manifest, name, self.store.write(name, rows, self.run))


def _stage_files(work: Workspace, raw: DataFrame, config: RunConfig) -> DataFrame:
    routed = config.ingest(raw) if config.ingest else raw.withColumn(
        "state", ledger.route_ingest(F.col("file_name"), config.store_format, config.process_format)
    )
    staged = with_origin(config.prepare(routed) if config.prepare else routed)
    path = f"{work.folder}/files"
    work.names.append("files")
    staged.withColumn("folder", F.coalesce("file_type", F.lit("UNMATCHED"))).write.partitionBy("folder").parquet(path)
    return work.spark.read.parquet(path)


def _decode(files: DataFrame, config: RunConfig) -> tuple[dict[str, DataFrame], DataFrame]:
    """Rows per table (several writers as `table.writer`) and all broken rules of the files."""
    parts: dict[str, DataFrame] = {}
    unmatched = files.filter("folder = 'UNMATCHED'").select(*ORIGIN, F.lit("no file type matches").alias("rule"))
    unparsed = files.filter("folder <> 'UNMATCHED' and user_id is null").select(
        *ORIGIN, F.lit("file name does not match the pattern").alias("rule")
    )
    findings = unmatched.unionByName(unparsed)
    # At most one folder per registered type.
    present = {row[0] for row in files.select("folder").distinct().collect()}
    for kind, decoder in config.decoders.items():
        if kind not in present:
            continue
        decoded = decoder(files.filter((F.col("folder") == kind) & F.col("user_id").isNotNull()))
        parts.update(decoded.rows)
        for found in decoded.failures:
            findings = findings.unionByName(found)
    return parts, findings


def _activity_files(work: Workspace, files: DataFrame, decoded: DataFrame | None) -> DataFrame:
    """Activity files with their activity, and what their frames say: whether they give a time series,
    and whether one of them names a metric twice."""
    fit = files.filter("folder = 'ACTIVITY' and user_id is not null").select(
        *ORIGIN, parse_activity_filename(F.col("file_name")).alias("activity_id")
    )
    if decoded is None:
        decoded = work.spark.createDataFrame([], f"file_name string, {frames.FRAMES}")
    found = decoded.groupBy("file_name").agg(
        F.max(frames.has_series()).alias("has_series"), F.max(frames.repeats_a_metric()).alias("repeats")
    )
    flags = [F.coalesce(name, F.lit(False)).alias(name) for name in ("has_series", "repeats")]
    joined = fit.join(found, "file_name", "left").select(*ORIGIN, "activity_id", *flags)
    return work.save(joined, "activity_files")


def _failed_sets(
    work: Workspace, known: DataFrame, parts: dict[str, DataFrame], findings: DataFrame, fit: DataFrame
) -> tuple[DataFrame, int, DataFrame | None]:
    """Sets that fail, with the first broken rule, their number, and the personal records whose
    activity exists.

    A failed set takes its activities with it, which may cost later sets their parent rows. A set is
    judged against stored activities, its own list, and the lists of earlier sets that survive, so it
    depends on earlier sets only: after n rounds the first n sets are final, and the rounds end when
    the set of failures stands still. Each round works on written frames of (set, activity) pairs and
    failure rows, never on the documents.
    """
    empty = work.spark.createDataFrame([], "file_set_ts timestamp, activity_id bigint")
    listed = parts["activity"].select("file_set_ts", "activity_id").distinct() if "activity" in parts else empty
    listed = work.save(listed, "listed")
    twice = fit.filter("repeats").select(*ORIGIN, F.lit("metric repeated").alias("rule"))
    unnamed = fit.filter("activity_id is null").select(*ORIGIN, F.lit("no activity id in the name").alias("rule"))
    findings = findings.unionByName(twice).unionByName(unnamed)
    records = parts.get("personal_record")
    failed = work.save(_per_set(findings), "failed-0")
    turn = 0
    while True:
        turn += 1
        alive = without_sets(listed, failed)
        since = F.col("since")
        first_seen = (
            known.select("activity_id", F.lit(None).cast("timestamp").alias("since"))
            .unionByName(alive.select("activity_id", F.col("file_set_ts").alias("since")))
            .groupBy("activity_id")
            .agg(F.max(since.isNull()).alias("stored"), F.min(since).alias("since"))
        )
        found = findings.unionByName(
            fit.join(_seen(fit, first_seen, listed).select(*ORIGIN), ORIGIN, "left_anti").select(
                *ORIGIN, F.lit("activity not found").alias("rule")
            )
        )
        visible = None
        if records is not None:
            free = records.filter(F.col("type_id").isin(*RECORDS_WITHOUT_ACTIVITY))
            bound = records.filter(F.col("activity_id").isNotNull())
            visible = work.save(free.unionByName(_seen(bound, first_seen, listed)), f"visible-{turn}")
            found = found.unionByName(training.repeated_record_types(visible))
        now_failed = work.save(_per_set(found), f"failed-{turn}")
        before, after = failed.select("file_set_ts"), now_failed.select("file_set_ts")
        changed = before.exceptAll(after).unionByName(after.exceptAll(before)).limit(1).count()
        failed = now_failed
        if not changed:
            return failed, failed.count(), visible


def _seen(rows: DataFrame, first_seen: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows whose activity is stored, listed in an earlier set that survives, or listed in their own set,
    whether that survives or not."""
    joined = skew_join(rows, first_seen, ["activity_id"], "left")
    own = listed.withColumn("own", F.lit(True))
    joined = skew_join(joined, own, ["file_set_ts", "activity_id"], "left")
    visible = F.col("own") | F.col("stored") | (F.col("since") <= F.col("file_set_ts"))
    return joined.filter(visible).select(*rows.columns)


def without_sets(rows: DataFrame, failed: DataFrame) -> DataFrame:
    """Rows of the sets that did not fail; one set may hold very many rows."""
    return skew_join(rows, failed.select("file_set_ts"), ["file_set_ts"], "left_anti")


def _per_set(findings: DataFrame) -> DataFrame:
    """One row per failed set with the rule broken first in processing order."""
    return findings.groupBy("file_set_ts").agg(
        F.min_by("rule", F.struct("type_rank", "file_name", "rule")).alias("error_type")
    )


def _write_users(target: Target, files: DataFrame, parts: dict[str, DataFrame]) -> None:
    named = files.select("user_id").distinct()
    users = merge.ensure_dimension_rows(target.stored("user"), named, "user_id")
    if "user.demographics" in parts:
        users = merge.fill_missing_attributes(
            users, parts["user.demographics"], "user_id", ["full_name", "birth_date"], ORDER, "full_name"
        )
    target.replace("user", [WHOLE], users.withColumn("create_ts", F.coalesce("create_ts", target.now)))


def _write_table(target: Target, name: str, parts: dict[str, DataFrame]) -> None:
    """Merge one table: insert-only tables add folders, the others rewrite the chunks they touch."""
    table = TABLES[name]
    mine = {part.split(".")[-1]: rows for part, rows in parts.items() if part.split(".")[0] == name}
    if table.policy == APPEND or not mine:
        return
    stamped = {k: merge.stamp_audit_columns(r, target.now, table.audited == "update") for k, r in mine.items()}
    together = merge.union_writers(*stamped.values())
    touched = target.store.touched_chunks(name, together)
    keys = list(table.keys)
    if table.policy == IGNORE:
        stored = target.stored(name, touched)
        target.add(name, merge.rows_to_insert(stored, together, keys, ORDER))
    elif table.policy == GROUPS:
        groups = {k: list(COLUMN_GROUPS[name][k]) for k in stamped}
        result = merge.merge_column_groups(target.stored(name, touched), stamped, groups, keys, ORDER)
        target.replace(name, touched, _restamp(result, together, keys, target.now))
    elif table.policy in (LATEST, LATEST_IGNORE):
        # The flag of a user may sit on any stored row, so these small tables are one chunk.
        mode = "ignore" if table.policy == LATEST_IGNORE else "update"
        result = merge.maintain_latest_flag(target.stored(name), together, LATEST_PER[name], keys, ORDER, mode)
        target.replace(name, touched, result)
    else:
        preserve = ["create_ts", *table.preserve]
        result = merge.upsert(target.stored(name, touched), together, keys, ORDER, preserve=preserve)
        target.replace(name, touched, result)


def _restamp(result: DataFrame, source: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """Stamps of a table that is merged by column groups."""
    hit = source.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return (
        result.join(hit, keys, "left")
        .withColumn("create_ts", F.coalesce("create_ts", now))
        .withColumn("update_ts", F.when(F.col("_hit"), now).otherwise(F.col("update_ts")))
        .drop("_hit")
    )


def _write_activities(
    work: Workspace, target: Target, parts: dict[str, DataFrame], fit: DataFrame, decoded: DataFrame | None
) -> None:
    """Activities, then the frames of those whose series are not stored yet, then their flag.

    Of several files of one activity the first in order counts; if it gives no series, the next one
    is read too, as the flag is set only by stored series. All of this is decided per file; the
    frames themselves are joined once.
    """
    touched_by = [rows.select("activity_id") for rows in (parts.get("activity"), fit) if rows is not None]
    touched = target.store.touched_chunks("activity", merge.union_writers(*touched_by))
    activities = target.stored("activity", touched)
    if "activity" in parts:
        rows = merge.stamp_audit_columns(parts["activity"], target.now)
        preserve = ["create_ts", *TABLES["activity"].preserve]
        activities = merge.upsert(activities, rows, ["activity_id"], ORDER, preserve=preserve)
    if decoded is not None:
        loaded = activities.filter("ts_data_available").select("activity_id")
        waiting = work.save(skew_join(fit, loaded, ["activity_id"], "left_anti"), "waiting")
        opening = waiting.filter("has_series").groupBy("activity_id").agg(
            F.min(F.struct(*ORIGIN)).alias("_opening")
        )
        in_time = F.col("_opening").isNull() | (F.struct(*ORIGIN) <= F.col("_opening"))
        chosen = skew_join(waiting, opening, ["activity_id"], "left").filter(in_time).select(*ORIGIN, "activity_id")
        named = decoded.select("file_name", "frame_seq", "frame_name", "fields")
        todo = skew_join(named, chosen, ["file_name"], "inner")
        keep = ["activity_id", *ORIGIN]
        metrics = {
            "activity_ts_metric": frames.unpivot_record_frames(todo, keep),
            "activity_split_metric": frames.unpivot_split_frames(todo, keep),
            "activity_lap_metric": frames.unpivot_lap_frames(todo, keep),
        }
        for name, rows in metrics.items():
            target.add(name, merge.stamp_audit_columns(rows, target.now, updated=False))
        flags = opening.select("activity_id", F.lit(True).alias("_now"))
        flagged = F.coalesce("ts_data_available", F.lit(False)) | F.coalesce("_now", F.lit(False))
        activities = (
            activities.join(flags, "activity_id", "left").withColumn("ts_data_available", flagged).drop("_now")
        )
    target.replace("activity", touched, activities)


def _outcome(files: DataFrame, failed: DataFrame) -> DataFrame:
    """State and success of every file of the run."""
    taken = skew_join(
        files.filter("state = 'process'").select("file_name", "file_set_ts"),
        failed,
        ["file_set_ts"],
        "left",
    )
    done = taken.select(
        "file_name",
        F.when(F.col("error_type").isNull(), F.lit("store")).otherwise(F.lit("quarantine")).alias("state"),
        F.col("error_type").isNull().alias("success"),
        "error_type",
    )
    rest = files.filter("state <> 'process'").select("file_name", "state")
    return done.unionByName(rest, allowMissingColumns=True)


def _write_results(target: Target, config: RunConfig, outcome: DataFrame) -> None:
    rows = outcome.filter(F.col("success").isNotNull()).select(
        F.lit(config.dag_id).alias("dag_id"),
        F.lit(config.dag_run_id).alias("dag_run_id"),
        F.lit(config.dag_start_date).cast("timestamp").alias("dag_start_date"),
        "file_name",
        "success",
        "error_type",
        F.lit(None).cast("string").alias("traceback"),
    )
    rows = merge.stamp_audit_columns(rows, target.now)
    touched = target.store.touched_chunks("etl_result", rows)
    keys = list(TABLES["etl_result"].keys)
    stored = target.stored("etl_result", touched)
    target.replace("etl_result", touched, merge.upsert(stored, rows, keys, ["file_name"], preserve=["create_ts"]))
