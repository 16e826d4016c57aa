"""The file ledger: routing, file sets, batches, outcomes.

A file set is the group of files that share one time. It may hold any number of files, so a set is
never gathered into one row: membership stays one row per file, sizes are aggregates, and the map
form is cut into pages of a bounded number of paths.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.plans.numbering import number_rows, time_levels
from pulsemill.plans.skew import skew_join
from pulsemill.registry import DATA_TYPES, extension

PAGE_SIZE = 1000
SET_MAP = "map<string, array<string>>"


def route_ingest(name: Column, store_format: str | None, process_format: str | None) -> Column:
    """State of a new file: `store` first, then `process`; leftovers are processed only if no
    process format is set, else they stay in `ingest`."""
    rest = F.lit("process") if process_format is None else F.when(
        name.rlike(process_format), F.lit("process")
    ).otherwise(F.lit("ingest"))
    if store_format is None:
        return rest
    return F.when(name.rlike(store_format), F.lit("store")).otherwise(rest)


def group_file_sets(files: DataFrame) -> DataFrame:
    """One row per set and type: number of files and bytes. Membership is the row of the file."""
    return files.groupBy("file_set_ts", "file_type").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("length").alias("total_bytes"),
        F.min("file_name").alias("first_name"),
        F.max("file_name").alias("last_name"),
    )


def order_file_sets(sets: DataFrame) -> DataFrame:
    """Add `set_no`, the 1-based place of a set in time; set times are distinct."""
    return number_rows(sets, "set_no", ["file_set_ts"], time_levels("file_set_ts"))


def unmatched_files(files: DataFrame) -> DataFrame:
    """Files no type matches, with the number of such files in their set; their sets fail."""
    lost = files.filter(F.col("file_type").isNull()).select("file_set_ts", "file_name")
    sizes = lost.groupBy("file_set_ts").agg(F.count(F.lit(1)).alias("n_unmatched"))
    return skew_join(lost, sizes, ["file_set_ts"], "inner")


def assign_batches(sets: DataFrame, min_sets: int, max_batches: int) -> DataFrame:
    """Add `batch_id`: blocks of `min_sets` sets in time order, at most `max_batches` of them, the
    remaining sets dealt round-robin. Fewer sets than one block make one batch."""
    if max_batches <= 0 or min_sets <= 0:
        raise ValueError("batch parameters must be greater than 0")
    ordered = order_file_sets(sets)
    total = sets.agg(F.count(F.lit(1)).alias("n_sets")).scalar()
    place = F.col("set_no") - 1
    blocks = F.least(F.floor(total / min_sets), F.lit(max_batches))
    full = blocks * min_sets
    batch = (
        F.when(blocks == 0, F.lit(0))
        .when(place < full, F.floor(place / min_sets))
        .otherwise(F.pmod(place - full, F.greatest(blocks, F.lit(1))))
    )
    return ordered.withColumn("batch_id", batch.cast("bigint"))


def file_set_pages(files: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Sets in map form, type -> paths, cut into pages of at most `page_size` paths of one type.

    The number of a path inside its set and type is taken in hash buckets of the path, so that a
    very large set is numbered by many tasks.
    """
    bucket = F.pmod(F.xxhash64("path"), F.lit(1024))
    keyed = files.filter(F.col("file_type").isNotNull()).withColumn("_bucket", bucket)
    numbered = number_rows(
        keyed, "_no", ["_bucket", "path"], [F.col("_bucket")], ["file_set_ts", "file_type"]
    )
    pages = numbered.withColumn("page", F.floor((F.col("_no") - 1) / page_size))
    return pages.groupBy("file_set_ts", "file_type", "page").agg(
        F.create_map(F.first("file_type"), F.array_sort(F.collect_list("path"))).alias("files")
    )


def to_serializable(files: Column) -> Column:
    return F.to_json(files)


def from_serializable(text: Column, known_types: Sequence[str]) -> Column:
    """Read a set back; types nobody knows are dropped."""
    return F.map_filter(F.from_json(text, SET_MAP), lambda name, _: name.isin(*known_types))


def file_set_size(files: DataFrame) -> DataFrame:
    """Total bytes of the files of a set that exist (those with a known length)."""
    return files.groupBy("file_set_ts").agg(F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"))


def all_paths(files: Column) -> Column:
    """All paths of a (page of a) set in map form."""
    return F.flatten(F.map_values(files))


def paths_of_type(files: Column, type_name: str) -> Column:
    """Paths of one type, an empty list if the set has none."""
    return F.coalesce(F.try_element_at(files, F.lit(type_name)), F.array().cast("array<string>"))


def init_results(files: DataFrame, results: DataFrame) -> DataFrame:
    """Every file starts as failed; a reported result replaces that. Names are unique on both sides."""
    return files.join(results.select("file_name", "success"), "file_name", "left").withColumn(
        "success", F.coalesce("success", F.lit(False))
    )


def file_set_status(files: DataFrame) -> DataFrame:
    """`set_ok` per file: a set succeeds only if all its files did."""
    sets = files.groupBy("file_set_ts").agg(F.bool_and("success").alias("set_ok"))
    return skew_join(files, sets, ["file_set_ts"], "inner")


def route_store(files: DataFrame, results: DataFrame) -> DataFrame:
    """`quarantine` for files reported as failed, `store` for all others, also those without result."""
    failed = results.filter(~F.col("success")).select("file_name", F.lit(True).alias("_failed")).distinct()
    return files.join(failed, "file_name", "left").withColumn(
        "state", F.when(F.col("_failed"), F.lit("quarantine")).otherwise(F.lit("store"))
    ).drop("_failed")


def state_summary(files: DataFrame) -> DataFrame:
    """Every file with its state and the size of that state. There are four states, so the sizes are
    broadcast; the names are not gathered, sort the rows to list them."""
    sizes = files.groupBy("state").agg(F.count(F.lit(1)).alias("n_files"))
    return files.join(F.broadcast(sizes), "state").select("state", "n_files", "file_name")


def result_summary(results: DataFrame) -> DataFrame:
    """One row: successes, errors, and the n/total text."""
    counts = results.agg(
        F.count_if("success").alias("n_success"),
        F.count_if(~F.col("success")).alias("n_error"),
        F.count(F.lit(1)).alias("n_total"),
    )
    text = F.concat_ws("/", F.col("n_success").cast("string"), F.col("n_total").cast("string"))
    return counts.withColumn("summary", text)


def target_row_counts(rows: DataFrame, target: str) -> DataFrame:
    return rows.groupBy(target).agg(F.count(F.lit(1)).alias("n_rows"))


def compare_results(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows only on one side, and whether both result sets are equal."""
    columns = left.columns
    sides = left.withColumn("_side", F.lit(1)).unionByName(right.select(*columns).withColumn("_side", F.lit(-1)))
    balance = sides.groupBy(*columns).agg(F.sum("_side").alias("_balance"))
    more, less = F.greatest("_balance", F.lit(0)), F.greatest(-F.col("_balance"), F.lit(0))
    totals = balance.agg(
        F.coalesce(F.sum(more), F.lit(0)).alias("only_left"),
        F.coalesce(F.sum(less), F.lit(0)).alias("only_right"),
    )
    return totals.withColumn("equal", (F.col("only_left") == 0) & (F.col("only_right") == 0))


def read_etl_result(results: DataFrame, dag_id: str, dag_run_id: str, dag_start_date) -> DataFrame:
    """Results of one run; the three predicates reach the Parquet scan."""
    return results.filter(
        (F.col("dag_id") == dag_id)
        & (F.col("dag_run_id") == dag_run_id)
        & (F.col("dag_start_date") == F.lit(dag_start_date))
    )


def unprocessed_types(files: DataFrame, handled: Sequence[str]) -> DataFrame:
    """File types that occur but nobody handles."""
    types = files.filter(F.col("file_type").isNotNull()).select("file_type").distinct()
    return types.filter(~F.col("file_type").isin(*handled))


def resolve_date_interval(start: Column, end: Column) -> tuple[Column, Column]:
    """Days to fetch, both inclusive: the end is exclusive unless it is the start day or earlier."""
    first, last = start.cast("date"), end.cast("date")
    return first, F.when(last > first, F.date_sub(last, 1)).otherwise(last)


def extraction_manifest(intervals: DataFrame, data_types: Sequence[str] | None = None) -> DataFrame:
    """What to fetch per interval row (user_id, start_day, end_day): daily and range types once a day,
    undated types once at the end. Activity files are fetched by activity, not by day."""
    wanted = [t for t in (DATA_TYPES if data_types is None else data_types) if t != "ACTIVITY"]
    dated = [t for t in wanted if DATA_TYPES[t] != "no_date"]
    undated = [t for t in wanted if DATA_TYPES[t] == "no_date"]

    def requests(types: Sequence[str], days: Column) -> Column:
        entries = [
            F.struct(F.lit(t).alias("data_type"), F.lit(DATA_TYPES[t]).alias("time_param"), F.lit(extension(t)).alias("extension"))
            for t in types
        ]
        kinds = F.array(*entries)
        return F.flatten(
            F.transform(
                days,
                lambda day: F.transform(
                    kinds,
                    lambda kind: F.struct(
                        day.alias("day"),
                        kind["data_type"].alias("data_type"),
                        kind["time_param"].alias("time_param"),
                        kind["extension"].alias("extension"),
                    ),
                ),
            )
        )

    span = F.when(
        F.col("start_day") <= F.col("end_day"), F.sequence("start_day", "end_day")
    ).otherwise(F.array().cast("array<date>"))
    parts = []
    if dated:
        parts.append(intervals.select("user_id", F.inline(requests(dated, span))))
    if undated:
        parts.append(intervals.select("user_id", F.inline(requests(undated, F.array("end_day")))))
    if not parts:
        raise ValueError("no data types to fetch by day")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def select_data_types(requests: DataFrame, names: Sequence[str] | None) -> DataFrame:
    """Rows of the chosen types: all for None, none for an empty list."""
    if names is None:
        return requests
    if not names:
        return requests.filter(F.lit(False))
    return requests.filter(F.col("data_type").isin(*names))


def invalid_data_types(requests: DataFrame, available: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Requested names the registry does not have."""
    return requests.select("data_type").distinct().filter(~F.col("data_type").isin(*available))
