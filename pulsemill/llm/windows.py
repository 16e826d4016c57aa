"""Line dedup by overlapping three-line windows.

Every three consecutive lines are hashed to 128 bits. A window that occurs anywhere else, in whatever
document, is repeated; its first occurrence in the order (doc_id, place) stays and the lines of all later
ones are removed, where overlapping windows merge into one removed stretch. Documents of one or two
lines are one window. The lines travel as hashes; the texts are shuffled once, to meet their covered
positions.

A removed position can be covered by a later occurrence only, so the first copy of a passage is kept
even when part of it also belongs to another repeated passage; such overlapping lines go.

Nulls: a null or empty text has no lines and stays as it is; null ids come first in the order. Rows of
the same id and text are one document and are treated alike. No rows give no rows; other columns pass
through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.shared import fresh

WINDOW = 3


def _hash(*parts: Column) -> list[Column]:
    """Two independent 64-bit hashes."""
    return [F.xxhash64(F.lit(salt), *parts) for salt in (17, 23)]


def line_windows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """(id, key, place, h1, h2): the hashed windows of each document; `key` is the hash of its text."""
    lines = docs.filter(F.length(text) > 0).select(
        F.col(doc_id).alias("id"), F.xxhash64(text).alias("key"), F.split(text, "\n").alias("lines")
    )
    count = F.size("lines")

    def window(i: Column) -> Column:
        members = [F.get("lines", i + n) for n in range(width)]
        # The number of lines keeps short documents apart from longer windows.
        h1, h2 = _hash(F.least(count, F.lit(width)), *members)
        return F.struct(i.alias("place"), h1.alias("h1"), h2.alias("h2"))

    places = F.sequence(F.lit(0), F.greatest(count - width, F.lit(0)))
    return lines.select("id", "key", F.inline(F.transform(places, window)))


def covered_lines(windows: DataFrame, width: int = WINDOW) -> DataFrame:
    """(id, key, covered): the positions that later occurrences of repeated windows cover."""
    spot = F.struct(F.col("id").isNotNull().alias("known"), "id", "key", "place")
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.min(spot).alias("first"), F.max(spot).alias("last"))
        .filter(F.col("first") != F.col("last"))
        .select("h1", "h2", "first")
    )
    later = windows.join(repeated, ["h1", "h2"]).filter(spot > F.col("first"))
    positions = later.groupBy("id", "key").agg(F.collect_set("place").alias("starts"))
    covered = F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (width - 1))))
    return positions.select("id", "key", F.array_distinct(covered).alias("covered"))


def drop_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", removed: str = "n_removed", width: int = WINDOW
) -> DataFrame:
    """The documents with the later occurrences of repeated windows removed, and how many lines went."""
    key, found, covered, hit = fresh("key", "id", "covered", "hit")
    marks = covered_lines(line_windows(docs, doc_id, text, width), width).select(
        F.col("id").alias(found), F.col("key").alias(key), F.col("covered").alias(covered)
    )
    own = F.xxhash64(text)
    joined = docs.join(marks, F.col(doc_id).eqNullSafe(F.col(found)) & (own == F.col(key)), "left")
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda line, i: ~F.array_contains(F.col(covered), i))
    marked = joined.withColumn(hit, F.when(F.col(covered).isNotNull(), F.struct(lines.alias("all"), kept.alias("kept"))))
    count = F.coalesce(F.size(f"{hit}.all") - F.size(f"{hit}.kept"), F.lit(0))
    new = F.when(F.col(hit).isNotNull(), F.array_join(f"{hit}.kept", "\n")).otherwise(F.col(text))
    columns = [new.alias(c) if c == text else F.col(c) for c in docs.columns]
    return marked.select(*columns, F.when(F.col(hit).isNull(), 0).otherwise(count).cast("long").alias(removed))
