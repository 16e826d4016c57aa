"""Reading and landing whole documents, and the columns derived from their names.

File names state times with colons, which not every Hadoop file system accepts. Documents are landed
under safe names, with `_` for `:`, and the ledger keeps the original name.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.functions.names import (
    classify_file_type,
    extract_file_timestamp,
    parse_filename,
    registered_type,
)
from pulsemill.plans.once import with_columns_once
from pulsemill.registry import type_rank

RAW = "file_name string, path string, mtime timestamp, length bigint, content string"

# Micro-batches of one drain. Each has a fixed cost, so a fixed number of files per batch would let
# that cost grow with the mailbox; the tasks of a large batch hold no more than those of a small one.
MOST_BATCHES = 32


def safe_name(name: Column) -> Column:
    return F.replace(name, F.lit(":"), F.lit("_"))


def original_name(name: Column) -> Column:
    """Undo `safe_name` for the time inside a name."""
    return F.regexp_replace(name, r"(\d{4}-\d{2}-\d{2}T\d{2})_(\d{2})_(\d{2})", "$1:$2:$3")


def scan_raw_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file with its whole text. Many small files are packed into one task by
    spark.sql.files.maxPartitionBytes and spark.sql.files.openCostInBytes."""
    return _raw(spark.read.text(folder, wholetext=True, recursiveFileLookup=True))


def stream_raw_documents(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The mailbox as a stream: each file is read once, remembered by the checkpoint. A batch takes
    `files_per_batch` files, or more if the files now in the folder would make over MOST_BATCHES batches."""
    reader = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
    if files_per_batch:
        share = -(-_count_files(spark, folder) // MOST_BATCHES)
        reader = reader.option("maxFilesPerTrigger", max(files_per_batch, share))
    return _raw(reader.load(folder))


def _count_files(spark: SparkSession, folder: str) -> int:
    """Files the stream would list; their names stay in the JVM."""
    return len(spark.read.text(folder, recursiveFileLookup=True)._jdf.inputFiles())


def _raw(texts: DataFrame) -> DataFrame:
    meta = F.col("_metadata")
    landed = F.regexp_extract(meta["file_path"], "/doc=([^/]+)/", 1)
    name = F.when(landed != "", landed).otherwise(meta["file_name"])
    return texts.select(
        original_name(name).alias("file_name"),
        meta["file_path"].alias("path"),
        meta["file_modification_time"].alias("mtime"),
        meta["file_size"].alias("length"),
        F.col("value").alias("content"),
    )


def land_documents(docs: DataFrame, folder: str) -> None:
    """Write each document (file_name, content) as one text file, in a folder that carries its name."""
    rows = docs.select(safe_name(F.col("file_name")).alias("doc"), F.col("content").alias("value"))
    rows.write.mode("append").partitionBy("doc").text(folder)


def with_origin(raw: DataFrame, patterns: Mapping[str, str] | None = None) -> DataFrame:
    """Add file type, set time and type rank from the name, and its parsed parts."""
    name = F.col("file_name")
    parsed = parse_filename(name)
    derived = {
        "file_type": classify_file_type(name, patterns) if patterns else registered_type(name),
        "file_set_ts": extract_file_timestamp(name, F.col("mtime"), F.col("path")),
        **parsed,
    }
    return with_columns_once(raw, derived).withColumn("type_rank", type_rank(F.col("file_type")))
