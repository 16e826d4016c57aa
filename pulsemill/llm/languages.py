"""Language identification by fusing evidence.

The log likelihood of a text under each language comes from hashed letter trigrams, fitted on a bounded
sample of about TRAIN_DOCS labelled documents, equally many of every label that has them; as overlapping trigrams repeat each other, a third of it
counts. The class UNKNOWN has a uniform likelihood, so a text that fits no language better than chance is
rejected, and so is one without letters. To this are added

* how often each declared language (of markup or metadata) goes with each language found by text alone,
* the same for the language segment of an address,
* a prior of the host, smoothed toward the prior of its address suffix, which is smoothed toward the prior
  of the whole table. Priors are sums of the text posteriors per group, without the row's own share.

All three are grouped aggregations. Hosts are pre-aggregated before the shuffle; they are broadcast if
counted to be few and joined with their hot keys apart otherwise.

Nulls: a null text is empty; missing declarations, segments and hosts add no evidence. Texts without a
letter have the language UNKNOWN and are not accepted. Repeated rows are judged alike, no rows give no
rows, and other columns pass through; those of
the names of the results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.ragged import text_slices
from pulsemill.llm.shared import BROADCAST_ROWS, fresh, lookup_join, staged
from pulsemill.plans.once import with_columns_once

# Bound of the sample that the trigram model is fitted on.
TRAIN_DOCS = 20_000
SLOTS = 1 << 15
SLICE = 2 << 20
UNKNOWN = "und"
# Share of overlapping trigrams that counts.
TEMPER = 1 / 3
# Rows of a label that are read at least, if it has so many.
LEAST_DOCS = 5
# Languages that are scored at once, which bounds memory.
BLOCK = 16
# Rows that the parent's prior counts for.
STRENGTH = 20.0
# Prior of a text in none of the languages.
FOREIGN = 1e-4


@dataclass(frozen=True)
class Trigrams:
    """Languages, and the log probability of every slot under each."""

    languages: tuple[str, ...]
    table: np.ndarray


@cache
def _letters() -> np.ndarray:
    """The code point of a letter, 0 for anything else; letters beyond the first plane stay."""
    points = np.arange(0x110000, dtype=np.uint32)
    plane = np.array([chr(c).isalpha() for c in range(0x10000)])
    points[: 0x10000][~plane] = 0
    return points


def trigram_slots(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The slots of all letter trigrams, with blanks around every text, and each text's offset."""
    lowered = [" " + t.lower() + " " for t in texts.to_pylist()]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), np.uint32)
    ends = np.concatenate([[0], np.cumsum([len(t) for t in lowered])])
    letters = _letters()[points]
    a, b, c = letters[:-2], letters[1:-1], letters[2:]
    slots = (a * np.uint32(2654435761) + b * np.uint32(2246822519) + c * np.uint32(3266489917)) >> np.uint32(17)
    # A trigram has its letter in the middle, and belongs to the text of that letter.
    keep = b != 0
    counted = np.concatenate([[0], np.cumsum(keep)])
    first = np.minimum(np.maximum(ends - 1, 0), len(keep)) if len(points) > 2 else np.zeros(len(ends), np.int64)
    return slots[keep].astype(np.int64), counted[first]


def fit_trigrams(docs: DataFrame, label: str = "lang", text: str = "text", key: str = "doc_id", most: int = TRAIN_DOCS) -> Trigrams:
    """Count trigrams per label over a sample dealt by hash: about `most` rows in equal parts, and at least
    LEAST_DOCS of a label. Every label that occurs is a language, however few rows it has."""
    labelled = docs.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    rows = labelled.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    languages = tuple(sorted(r[0] for r in rows))
    quota = max(LEAST_DOCS, most // max(1, len(rows)))
    own, size = fresh("label", "size")
    sizes = docs.sparkSession.createDataFrame([(r[0], r["n"]) for r in rows], f"{own} string, {size} long")
    sample = labelled.join(F.broadcast(sizes), F.col(label) == F.col(own))
    sample = sample.filter(F.pmod(F.xxhash64(key, text), F.col(size)) < quota)
    place = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(languages) * SLOTS, np.int64)
        for batch in batches:
            for first, texts in text_slices(batch.column(1), SLICE):
                slots, offsets = trigram_slots(texts)
                labels = batch.column(0).slice(first, len(texts)).to_pylist()
                row = np.repeat([place.get(name, -1) for name in labels], np.diff(offsets))
                cell, n = np.unique((row * SLOTS + slots)[row >= 0], return_counts=True)
                sums[cell] += n
        cell = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(sums[cell])], names=["cell", "n"])

    cells = sample.select(label, text).mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    held = cells.toArrow()
    sums = np.zeros(max(1, len(languages)) * SLOTS)
    sums[held["cell"].to_numpy()] = held["n"].to_numpy()
    sums = sums.reshape(-1, SLOTS) + 0.1
    return Trigrams(languages, np.log(sums / sums.sum(1, keepdims=True)).astype(np.float32)[: len(languages)])


def with_likelihoods(docs: DataFrame, model: Trigrams, text: str, out: str, shares: str, foreign: float) -> DataFrame:
    """Add two arrays: the tempered log likelihood under each language and under UNKNOWN, which has the prior
    `foreign`, and the shares of each by the text alone; null without letters."""
    at = docs.columns.index(text)
    uniform = -math.log(SLOTS)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.concatenate([model.table.T, np.full((SLOTS, 1), uniform, np.float32)], 1)
        for batch in batches:
            for first, texts in text_slices(batch.column(at), SLICE):
                slots, offsets = trigram_slots(texts)
                sums = np.zeros((len(texts), table.shape[1]))
                full = np.flatnonzero(np.diff(offsets))
                if len(full):
                    for n in range(0, table.shape[1], BLOCK):
                        each = table[:, n : n + BLOCK][slots]
                        sums[full, n : n + BLOCK] = np.add.reduceat(each, offsets[full], axis=0, dtype=np.float64) * TEMPER
                sums[:, -1] += foreign
                share = np.exp(sums - sums.max(1, keepdims=True))
                share /= share.sum(1, keepdims=True)
                lists = [
                    pa.array([r if n else None for r, n in zip(of, np.diff(offsets))], pa.list_(pa.float64()))
                    for of in (sums, share)
                ]
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, *lists], names=names)

    names = [*docs.columns, out, shares]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    return docs.mapInArrow(score, ", ".join([*fields, f"`{out}` array<double>", f"`{shares}` array<double>"]))


def _sum(values: str) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda t, v: t + v)


def _array(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def identify(
    docs: DataFrame,
    model: Trigrams,
    text: str = "text",
    declared: Column | None = None,
    segment: Column | None = None,
    host: Column | None = None,
    language: str = "language",
    confidence: str = "confidence",
    accepted: str = "accepted",
) -> DataFrame:
    """The documents with the language found, its posterior, and whether a language was found at all."""
    classes = [*model.languages, UNKNOWN]
    none = F.lit(None).cast("string")
    host = none if host is None else host
    suffix = F.regexp_extract(host, r"\.([A-Za-z]+)$", 1)
    named = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("_row"),
        F.col(text).alias("_read"),
        (none if declared is None else F.lower(declared)).alias("_declared"),
        (none if segment is None else F.lower(segment)).alias("_segment"),
        F.lower(host).alias("_host"),
        F.when(host.isNotNull(), F.lower(suffix)).alias("_suffix"),
    )
    scored = with_likelihoods(named, model, "_read", "_scores", "_text", math.log(FOREIGN)).drop("_read")

    sums = [F.sum(F.get("_text", F.lit(i))).alias(f"s{i}") for i in range(len(classes))]
    groups = staged(
        scored.filter(F.col("_text").isNotNull())
        .groupBy("_host", "_suffix", _known("_declared", classes), _known("_segment", classes))
        .agg(*sums),
        "language-groups",
    )
    whole = groups.agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(classes))]).first()
    total = [whole[f"s{i}"] or 0.0 for i in range(len(classes))]
    prior = [(t + 1.0) / (sum(total) + len(total)) for t in total]

    by_declared = _evidence(groups, "_declared", classes)
    by_segment = _evidence(groups, "_segment", classes)
    suffixes = groups.groupBy("_suffix").agg(*[F.sum(f"s{i}").alias(f"u{i}") for i in range(len(classes))])
    hosts = groups.filter(F.col("_host").isNotNull()).groupBy("_host", "_suffix").agg(
        *[F.sum(f"s{i}").alias(f"s{i}") for i in range(len(classes))]
    )
    hosts = staged(
        hosts.join(suffixes, "_suffix").select(
            "_host",
            F.array(*[f"s{i}" for i in range(len(classes))]).alias("_of_host"),
            F.array(*[f"u{i}" for i in range(len(classes))]).alias("_of_suffix"),
        ),
        "language-hosts",
    )
    if hosts.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        scored = staged(scored, "language-scored")
    judged = lookup_join(scored, hosts, "_host")

    zeros = _array([0.0] * len(classes))
    own = F.coalesce("_text", zeros)
    for column, table in (("_declared", by_declared), ("_segment", by_segment)):
        # One row per language at most.
        logs = docs.sparkSession.createDataFrame(list(table.items()), f"{column}_tag string, {column}_logs array<double>")
        judged = judged.join(F.broadcast(logs), _known(column, classes) == F.col(f"{column}_tag"), "left")

    def without(column: str) -> Column:
        own_part = F.when(F.col(column).isNotNull(), own).otherwise(zeros)
        return F.zip_with(F.coalesce(F.col(column), zeros), own_part, lambda s, o: F.greatest(s - o, F.lit(0.0)))

    def smooth(counts: str, total: str, parent: Column | str) -> Column:
        return F.zip_with(counts, parent, lambda s, p: (s + F.lit(STRENGTH) * p) / (F.col(total) + F.lit(STRENGTH)))

    def plus(left: Column | str, right: Column | str) -> Column:
        return F.zip_with(left, right, lambda s, p: s + p)

    # Each step is a column of its own: what a step takes from the one before is computed once a row, not once
    # for every language.
    steps = [
        {"_rest_suffix": without("_of_suffix"), "_rest_host": without("_of_host")},
        {"_n_suffix": _sum("_rest_suffix"), "_n_host": _sum("_rest_host"), "_prior": _array(prior)},
        {"_by_suffix": smooth("_rest_suffix", "_n_suffix", "_prior")},
        {"_by_host": smooth("_rest_host", "_n_host", "_by_suffix")},
        {"_log_host": F.transform("_by_host", lambda p: F.log(p))},
        {"_sum_1": plus("_scores", "_log_host")},
        {"_sum_2": plus("_sum_1", F.coalesce("_declared_logs", zeros))},
        {"_fused": plus("_sum_2", F.coalesce("_segment_logs", zeros))},
        {"_top": F.array_max("_fused")},
        {"_weights": F.transform("_fused", lambda s: F.exp(s - F.col("_top")))},
        {"_total": _sum("_weights")},
        {"_final": F.transform("_weights", lambda w: w / F.col("_total"))},
    ]
    # The optimizer cannot take fields of a struct through the steps, so the rows are unpacked first.
    judged = judged.select(*[F.col(f"_row.{c}").alias(f"_own{i}") for i, c in enumerate(docs.columns)], *[c for c in judged.columns if c != "_row"])
    for step in steps:
        judged = with_columns_once(judged, step)
    best = F.array_max("_final")
    number = F.array_position("_final", best)
    found = F.when(F.col("_final").isNull(), F.lit(UNKNOWN)).otherwise(F.element_at(F.array(*map(F.lit, classes)), number.cast("int")))
    kept = [c for c in docs.columns if c not in (language, confidence, accepted)]
    own_columns = [F.col(f"_own{docs.columns.index(c)}").alias(c) for c in kept]
    out = judged.select(*own_columns, found.alias(language), F.coalesce(best, F.lit(1.0)).alias(confidence))
    return out.withColumn(accepted, F.col(language) != UNKNOWN)


def _known(column: str, classes: list[str]) -> Column:
    """A declaration if it names a language of the model, else null: primary tags only."""
    tag = F.regexp_extract(F.col(column), r"^([a-z]+)", 1)
    return F.when(tag.isin(classes[:-1]), tag).alias(column)


def _evidence(groups: DataFrame, column: str, classes: list[str]) -> dict[str, list[float]]:
    """log P(declaration | language) for each declaration that names a language, from grouped sums."""
    sums = [F.sum(f"s{i}").alias(f"s{i}") for i in range(len(classes))]
    rows = groups.filter(F.col(column).isNotNull()).groupBy(column).agg(*sums).collect()
    total = [sum(r[f"s{i}"] for r in rows) for i in range(len(classes))]
    n = max(1, len(classes) - 1)
    return {
        r[column]: [math.log((r[f"s{i}"] + 1.0) / (total[i] + n)) for i in range(len(classes))] for r in rows
    }
