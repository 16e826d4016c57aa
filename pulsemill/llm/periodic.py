"""Runs of words: stretches that repeat with a period and cannot be made longer.

A run of period q is at least two periods and LEAST words long. With the words in either order (ascending
or descending, the end before all of them) the longest Lyndon word that starts at a place ends where the next
smaller suffix starts; every run holds such a word of its own period in one of the two orders. Each is
extended to the right by the suffix tree of the words and to the left by the tree of their reversal.

Trees are grown only where a run can be. Each run is at least twelve words, so GRAM consecutive words of it
come back one period later, and such repeats cover the run whole; a repeat farther away than half of the
covered stretch around it is of no run in there. What this leaves, and only that, goes into the trees: many
stretches at a time with separators of their own between them, a long one alone.

A word goes when a run holds it after the first period of that run; the kept words are joined by one blank.

Nulls: a null text has no words. Words are cut at ASCII white space. Empty texts, repeated rows and null ids
are rows like others; no rows give no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.ragged import distinct, split_words, text_slices
from pulsemill.llm.suffix_tree import SuffixTree

BLANKS = (32, 9, 10, 11, 12, 13)
LEAST = 12
GRAM = LEAST // 2
# Text bytes that are looked at together, and words of one tree unless one stretch is longer.
SLICE = 4 << 20
TREE_WORDS = 1 << 16


def _next_smaller(rank: list[int]) -> list[int]:
    """For every place but the last the next one of lower rank; the last has the lowest rank of all."""
    n = len(rank) - 1
    after = [n] * (n + 1)
    for i in range(n - 1, -1, -1):
        j = i + 1
        own = rank[i]
        while rank[j] > own:
            j = after[j]
        after[i] = j
    return after[:-1]


def runs_of(x: np.ndarray, least: int = LEAST) -> np.ndarray:
    """(runs, 3): start, length and period of all runs of the numbers x, which are 1 or more."""
    n = len(x)
    if n < least:
        return np.empty((0, 3), np.int64)
    forward = SuffixTree(np.append(x, 0))
    roots = [_next_smaller(forward.ranks(up).tolist()) for up in (True, False)]
    at = np.tile(np.arange(n), 2)
    after = np.array(roots[0] + roots[1])
    period = after - at
    right = forward.common(at, after)
    # Only what reaches two periods and the least length with some words on its left.
    near = np.flatnonzero((2 * period <= n) & (period + right + at >= np.maximum(2 * period, least)))
    at, after, period, right = at[near], after[near], period[near], right[near]
    del forward
    back = SuffixTree(np.append(x[::-1], 0))
    left = back.common(n - at, n - after) if len(at) else at
    length = left + period + right
    found = np.stack([at - left, length, period], 1)[length >= np.maximum(2 * period, least)]
    return np.unique(found, axis=0)


def _covered(grams: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in one of the grams."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, grams, 1)
    np.add.at(steps, grams + GRAM, -1)
    return np.cumsum(steps[:-1]) > 0


def stretches(word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of stretches of words that hold every run of LEAST words or more of every text."""
    n = len(word)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero(np.arange(n) + GRAM <= offsets[1:][text]) if n else np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        code = text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(GRAM):
            code = (code ^ (word[at + k].astype(np.uint64) + np.uint64(k + 1))) * np.uint64(0xBF58476D1CE4E5B9)
            code ^= code >> np.uint64(29)
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    far = n + 1
    gap = np.where(same, np.diff(at[order]), far)
    # The distance to the nearest repeat on either side; equal codes of different texts only add work.
    nearest = np.empty(len(at), np.int64)
    nearest[order] = np.minimum(np.append(gap, far), np.append(far, gap)) if len(at) else far
    at, nearest = at[nearest < far], nearest[nearest < far]
    while True:
        inside = np.concatenate([[False], _covered(at, n), [False]])
        # Texts that touch are not one stretch.
        edge = inside[1:] != inside[:-1]
        starts = np.flatnonzero(edge & inside[1:])
        ends = np.flatnonzero(edge & inside[:-1])
        if len(starts):
            cut = offsets[1:-1]
            cut = np.unique(cut[(cut > 0) & (cut < n)])
            cut = cut[inside[cut] & inside[cut + 1]]
            starts, ends = np.sort(np.append(starts, cut)), np.sort(np.append(ends, cut))
        length = ends - starts
        own = length[np.searchsorted(starts, at, side="right") - 1] if len(at) else at
        good = (2 * nearest <= own) & (own >= LEAST)
        if good.all():
            return starts, ends
        at, nearest = at[good], nearest[good]


def _batches(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of stretches of about TREE_WORDS words, at least one stretch each."""
    sums = np.cumsum(ends - starts)
    first = 0
    while first < len(starts):
        done = sums[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sums, done + TREE_WORDS, side="right")))
        yield first, last
        first = last


def runs_of_texts(word: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(runs, 4): text, start in the text, length and period of all runs, in this order."""
    found = [np.empty((0, 3), np.int64)]
    starts, ends = stretches(word, offsets)
    for first, last in _batches(starts, ends):
        size = ends[first:last] - starts[first:last]
        begin = np.concatenate([[0], np.cumsum(size + 1)])
        mine = np.repeat(np.arange(last - first), size)
        place = np.arange(len(mine)) + mine
        source = place - begin[mine] + starts[first:last][mine]
        _, dense = np.unique(word[source], return_inverse=True)
        x = np.zeros(begin[-1], np.int64)
        x[place] = dense + 1
        # Every stretch ends with a separator of its own, which no run holds.
        x[begin[1:] - 1] = dense.max() + 2 + np.arange(last - first)
        runs = runs_of(x)
        of = np.searchsorted(begin, runs[:, 0], side="right") - 1
        runs[:, 0] += starts[first:last][of] - begin[of]
        found.append(runs)
    runs = np.concatenate(found)
    text = np.searchsorted(offsets, runs[:, 0], side="right") - 1
    runs = np.column_stack([text, runs[:, 0] - offsets[text], runs[:, 1:]])
    return runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]


def _report(texts: pa.Array) -> list[pa.Array]:
    """The number of words, the runs and the collapsed text of each text."""
    words, offsets = split_words(texts, BLANKS)
    n = len(offsets) - 1
    runs = runs_of_texts(distinct(words)[0].astype(np.int64), offsets)
    begin = offsets[runs[:, 0]] + runs[:, 1]
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, begin + runs[:, 3], 1)
    np.add.at(steps, begin + runs[:, 2], -1)
    stays = np.cumsum(steps[:-1]) == 0
    kept = np.concatenate([[0], np.cumsum(stays)])[offsets]
    lists = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), words.filter(pa.array(stays)).cast(pa.string()))
    order = np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))
    runs = runs[order]
    triples = pa.StructArray.from_arrays([pa.array(runs[:, c], pa.int64()) for c in (1, 2, 3)], names=["start", "length", "period"])
    at = np.searchsorted(runs[:, 0], np.arange(n + 1))
    return [
        pa.array(np.diff(offsets), pa.int64()),
        pa.ListArray.from_arrays(pa.array(at, pa.int32()), triples),
        pc.binary_join(lists, " "),
    ]


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every document: its runs by start and period, and its text
    without their repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch.column(1), SLICE):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), *_report(texts)], names=["doc_id", "n_words", "runs", "collapsed"]
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(run, schema)


def made_periodic(text: Column, doc_id: Column) -> Column:
    """The text, or for a tenth of all ids, dealt by checksum, its words with a periodic end: from word a on
    the words are those p words over and over."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words).cast("long")
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / F.lit(10))
    a = F.pmod(g, n)
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
    again = F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int"))
    end = F.slice(F.flatten(again), F.lit(1), (n - a).cast("int"))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), end), " ")
    return F.when((F.pmod(h, F.lit(10)) == 0) & (n > 0), made).otherwise(text)


def run_report(found: DataFrame) -> DataFrame:
    """Counts, the longest run and digests of the rows of `find_runs`."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines"), "collapsed")
    length = -F.col("best.less")
    return rows.select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * length / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
