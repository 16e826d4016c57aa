"""The stored tables as Parquet folders, published together.

A run writes new folders and then one small manifest that names, per table and chunk, the folders
that count. Readers see the old manifest or the new one, never half a run; a lost run leaves folders
nobody names. Tables with a chunk rewrite only the chunks a run touches, and insert-only tables only
add folders, so the cost of a run follows its input and not the size of the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from pulsemill.schema import TABLES, Table
from pulsemill.sources.chunks import (
    CHUNK_DAYS,
    COMPACT_AFTER_DAYS,
    chunk_of,
    cluster_chunks,
    id_chunk_of,
)

WHOLE = "all"
# Entry of the manifest for how far each stream has come.
STREAMS = "_streams"


def chunk_column(table: Table) -> Column:
    """Chunk of a row as text, the same for every version of a key."""
    if table.chunk_on is None:
        return F.lit(WHOLE)
    column = F.col(table.chunk_on)
    if table.schema[table.chunk_on].dataType.typeName() == "long":
        return id_chunk_of(column).cast("string")
    return chunk_of(column).cast("string")


class Store:
    """Tables below one root folder on a file system all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # The manifest is a small JSON file per version; the highest version counts.

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_manifest")
        return jvm, path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        _, path, fs = self._fs()
        if not fs.exists(path):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def manifest(self) -> dict[str, dict[str, list[str]]]:
        version = self.version()
        if version == 0:
            return {}
        row = self.spark.read.text(f"{self.root}/_manifest/{version:010d}.json", wholetext=True).head()
        return json.loads(row[0])

    def publish(self, content: dict[str, dict[str, list[str]]], version: int) -> None:
        """Write the manifest of `version`; fails if another run has published it already."""
        jvm, path, fs = self._fs()
        target = jvm.org.apache.hadoop.fs.Path(path, f"{version:010d}.json")
        draft = jvm.org.apache.hadoop.fs.Path(path, f"draft-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(content), "utf-8"))
        out.close()
        if fs.exists(target) or not fs.rename(draft, target):
            raise RuntimeError(f"version {version} was published by another run")

    def progress(self, stream: str) -> list[str]:
        """The marks a stream has published together with its last tables; none before its first."""
        return self.manifest().get(STREAMS, {}).get(stream, [])

    def mark(self, manifest: dict[str, dict[str, list[str]]], stream: str, marks: list[str]) -> None:
        manifest.setdefault(STREAMS, {})[stream] = marks

    # Reading.

    def read(self, name: str, chunks: Sequence[str] | None = None, manifest: dict | None = None) -> DataFrame:
        """The table, or only the named chunks of it, with the folder column `chunk`."""
        table = TABLES[name]
        listed = (self.manifest() if manifest is None else manifest).get(name, {})
        folders = [f for c, paths in listed.items() if chunks is None or c in chunks for f in paths]
        schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in table.schema)}, chunk string"
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{f}" for f in folders]
        base = f"{self.root}/{name}"
        frame = self.spark.read.schema(f"{schema}, run string").option("basePath", base).parquet(*paths)
        return frame.drop("run")

    def read_range(self, name: str, low: date, high: date) -> DataFrame:
        """Rows of a time table with low <= time < high; only the chunks of that range are opened."""
        column = F.col(TABLES[name].chunk_on)
        listed = self.manifest()
        first = low - timedelta(days=CHUNK_DAYS)
        chunks = [c for c in listed.get(name, {}) if first.isoformat() < c < high.isoformat()]
        frame = self.read(name, chunks, listed)
        return frame.filter((column >= F.lit(low)) & (column < F.lit(high)))

    def state_digest(self) -> DataFrame:
        """(table_name, chunk, n_rows, digest) of everything stored, without the time stamps of writing. The
        digest is a sum of row hashes: equal for equal rows in any order, and combined before the shuffle."""
        manifest = self.manifest()
        parts = []
        for name, table in TABLES.items():
            columns = [c for c in table.names if c not in ("create_ts", "update_ts")]
            rows = self.read(name, manifest=manifest).groupBy("chunk").agg(
                F.count(F.lit(1)).alias("n_rows"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("digest")
            )
            if manifest.get(name):
                parts.append(rows.select(F.lit(name).alias("table_name"), "chunk", "n_rows", "digest"))
        if not parts:
            return self.spark.createDataFrame([], "table_name string, chunk string, n_rows bigint, digest decimal(38,0)")
        return reduce(DataFrame.unionByName, parts)

    def register_views(self) -> None:
        """Every table as a temporary view, for Spark SQL."""
        manifest = self.manifest()
        for name in TABLES:
            self.read(name, manifest=manifest).createOrReplaceTempView(name)

    # Writing.

    def write(self, name: str, rows: DataFrame, run: str, codec: str = "snappy") -> dict[str, list[str]]:
        """Write rows as folders of this run and list them by chunk; nothing is visible yet."""
        table = TABLES[name]
        chunked = rows.select(*table.names, chunk_column(table).alias("chunk"))
        path = f"{self.root}/{name}/run={run}"
        keys = [c for c in (table.segment, table.chunk_on, *table.keys) if c]
        clustered = cluster_chunks(chunked, [], list(dict.fromkeys(keys)))
        (
            clustered.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", codec)
            .partitionBy("chunk")
            .parquet(path)
        )
        jvm, _, fs = self._fs()
        listed = fs.listStatus(jvm.org.apache.hadoop.fs.Path(path))
        names = [s.getPath().getName() for s in listed if s.isDirectory()]
        return {n[len("chunk="):]: [f"{name}/run={run}/{n}"] for n in names if n.startswith("chunk=")}

    def touched_chunks(self, name: str, rows: DataFrame) -> list[str]:
        """Chunks the rows fall into: days over 7 or ids over the range, a short list."""
        table = TABLES[name]
        if table.chunk_on is None:
            return [WHOLE]
        found = rows.filter(F.col(table.chunk_on).isNotNull()).select(chunk_column(table).alias("chunk"))
        return [r[0] for r in found.distinct().toLocalIterator()]


    # Upkeep of time tables.

    def _last_chunk(self, name: str, today: date, days: int) -> date:
        """First day of the last chunk that ended more than `days` ago; only time makes a chunk old."""
        table = TABLES[name]
        kind = {f.name: f.dataType for f in self.read(name).schema}.get(table.chunk_on)
        if not isinstance(kind, (DateType, TimestampType)):
            raise ValueError(f"{name} has no chunks by time")
        return today - timedelta(days=days + CHUNK_DAYS)

    def compact(self, name: str, today: date, days: int = COMPACT_AFTER_DAYS) -> list[str]:
        """Rewrite the chunks older than `days` that are made of several folders as one sorted zstd
        folder each, and publish; returns the chunks."""
        version, listed = self.version(), self.manifest()
        last = self._last_chunk(name, today, days)
        old = [c for c, folders in listed.get(name, {}).items() if date.fromisoformat(c) <= last and len(folders) > 1]
        if old:
            rows = self.read(name, old, listed)
            replaced(listed, name, old, self.write(name, rows, f"compact-{uuid.uuid4().hex}", "zstd"))
            self.publish(listed, version + 1)
        return old

    def expire(self, name: str, today: date, days: int) -> list[str]:
        """Stop listing the chunks that ended more than `days` ago; returns them."""
        version, listed = self.version(), self.manifest()
        last = self._last_chunk(name, today, days)
        gone = [c for c in listed.get(name, {}) if date.fromisoformat(c) <= last]
        if gone:
            replaced(listed, name, gone, {})
            self.publish(listed, version + 1)
        return gone


def added(manifest: dict, name: str, new: dict[str, list[str]]) -> None:
    """List new folders beside the stored ones."""
    table = manifest.setdefault(name, {})
    for chunk, folders in new.items():
        table[chunk] = table.get(chunk, []) + folders


def replaced(manifest: dict, name: str, touched: Sequence[str], new: dict[str, list[str]]) -> None:
    """List new folders in place of the touched chunks."""
    table = manifest.setdefault(name, {})
    for chunk in touched:
        table.pop(chunk, None)
    table.update(new)
