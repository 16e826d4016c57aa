"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    # Naive ISO texts and epoch values in the documents are UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value, as JSON loaders commonly do.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A rewrite replaces only the chunks it writes.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM does not compile longer methods; rows of many columns are then read in smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set the runtime settings the operators rely on; safe to call many times."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Local session for tests and the bench; a cluster passes its own session instead."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pulsemill")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare_session(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or a local one for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="pulsemill-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_folder(spark)}/pulsemill/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system the session knows; a missing one is fine."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
