"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

A shingle is five words (all words of a shorter text). Its weight is its count in the text times an idf
between 1 - DAMPING and 1: document frequencies fall into a count sketch of ROWS x SLOTS counters, less
the mean load of a counter, so its size is fixed and it covers every document. The damping keeps a
large group of near copies, whose shingles are frequent by themselves, above the threshold.

Each text gets BANDS x DEPTH consistent weighted samples; two texts agree in a sample with the probability
of their weighted Jaccard similarity. Texts that agree in a whole band are in one bucket. Pairs that come
out of buckets are verified by their exact weighted Jaccard similarity, at least THRESHOLD:

* every text with the first document of its largest bucket,
* then, in at most TURNS rounds, the classes that are left in a bucket: one text stands for each class, and
  those that follow each other are compared when the bucket is sorted by the bands after its own (the more
  samples two texts share, the nearer they stand). A round has at most one pair per class and bucket.

A bucket of more than two texts that is not one class by then is unsettled, and the remaining pairs of the texts
of such buckets are found exactly, by a weighted prefix filter: with shingles in one order for all texts, rarest
first, the first shingle that two similar texts share leaves behind it, in both, the weight that they need to
have in common. So texts meet at shingles that leave at least THRESHOLD of their weight, and at
2 THRESHOLD / (1 + THRESHOLD) in the lighter text. At each such shingle a class is one row, with the most weight
that any of its texts leaves and the least weight that any has: a bound for all of them. A text meets the rows of
larger classes and is compared with one text of each. Only where that was no link, and no other link has joined
them, the text meets the class's texts one by one.
Hot shingles are dealt out by salt, no bucket is gathered in one place, and none is cut.
Equal texts are one node. Classes are the connected components of the verified links.

Nulls: a null text is empty; equal texts, empty ones too, are one class. Texts without words are alike
only if equal. Null ids stay and name a class only if all ids of it are null. Repeated rows share a class.
No rows give no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.llm.graph import components
from pulsemill.llm.ragged import as_bytes, split_words, text_slices
from pulsemill.llm.shared import fresh, staged, whole_text
from pulsemill.plans.skew import skew_join

WORDS = 5
THRESHOLD = 0.8
BANDS = 13
DEPTH = 4
TURNS = 2
ROWS = 2
SLOTS = 1 << 16
DAMPING = 0.25
# Texts of a hot shingle that one task compares with its partners.
DEALT = 1024
# Parts of the rows of a shingle when they are looked up.
COPIES = 8
# Slack of sums in single precision.
SLACK = 1 - 1e-5
BLANKS = (32, 10, 9, 13)
SLICE = 1 << 20

_U = np.uint64


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; every bit of the result depends on every bit of the input."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, and each text's offset."""
    words, offsets = split_words(texts, BLANKS)
    flat, ends = as_bytes(words)
    if not len(flat):
        return np.empty(0, _U), offsets
    place = np.arange(len(flat)) - np.repeat(ends[:-1], np.diff(ends))
    with np.errstate(over="ignore"):
        power = _mix((place.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15))
        sums = np.add.reduceat((flat.astype(_U) + _U(1)) * power, ends[:-1])
        return _mix(sums + np.diff(ends).astype(_U)), offsets


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, count, offsets): the distinct shingles of every text, sorted, with their counts."""
    words, offsets = _word_hashes(texts)
    sizes = np.diff(offsets)
    counts = np.where(sizes >= WORDS, sizes - WORDS + 1, np.minimum(sizes, 1))
    doc = np.repeat(np.arange(len(sizes)), counts)
    starts = np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(counts)])[:-1], counts) + np.arange(counts.sum())
    value = np.zeros(len(doc), _U)
    with np.errstate(over="ignore"):
        for n in range(WORDS):
            at = starts + n
            inside = at < offsets[1:][doc]
            value = np.where(inside, _mix(value * _U(3) + words[np.minimum(at, len(words) - 1)]), value) if len(words) else value
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    tf = np.diff(np.append(first, len(doc)))
    return value[first], tf, np.searchsorted(doc[first], np.arange(len(sizes) + 1))


def _counters(value: np.ndarray) -> list[np.ndarray]:
    return [
        (_mix(value + _U(row + 1)) & _U(SLOTS - 1)).astype(np.int64) + row * SLOTS for row in range(ROWS)
    ]


class Idf:
    """Damped inverse document frequencies from the count sketch."""

    def __init__(self, counts: np.ndarray, texts: int):
        load = counts.reshape(ROWS, SLOTS).sum(1, keepdims=True) / SLOTS
        excess = np.maximum(counts.reshape(ROWS, SLOTS) - load, 1.0)
        share = np.log(excess) / np.log(max(texts, 2))
        self.weight = (1.0 - DAMPING * np.minimum(share, 1.0)).astype(np.float32).ravel()

    def of(self, value: np.ndarray) -> np.ndarray:
        rows = [self.weight[at] for at in _counters(value)]
        return np.maximum.reduce(rows) if len(value) else np.empty(0, np.float32)


def samples(value: np.ndarray, weight: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, BANDS * DEPTH): the smallest key of each consistent weighted sample, as its identity.

    r and c are Gamma(2, 1), beta is uniform, all from a hash of shingle and sample; with
    t = floor(ln w / r + beta) the key is ln c - r (t - beta) - r. Texts without shingles have zeros.
    """
    full = np.flatnonzero(np.diff(offsets))
    out = np.zeros((len(offsets) - 1, BANDS * DEPTH), np.uint32)
    if not len(full):
        return out
    starts = offsets[full]
    log_weight = np.log(weight).astype(np.float32)
    unit = np.float32(2.0**-24)
    with np.errstate(over="ignore"):
        for sample in range(BANDS * DEPTH):
            h = _mix(value + _U(0x9E3779B97F4A7C15) * _U(2 * sample + 11))
            g = _mix(h + _U(0xD1B54A32D192ED03))
            u = [
                ((x >> _U(s)) & _U(0xFFFFFF)).astype(np.float32) * unit + unit / 2
                for x, s in ((h, 0), (h, 24), (g, 0), (g, 24))
            ]
            beta = (((h >> _U(48)) << _U(8)) | (g >> _U(56))).astype(np.float32) * unit
            r = -np.log(u[0] * u[1])
            c = -np.log(u[2] * u[3])
            t = np.floor(log_weight / r + beta)
            key = np.log(c) - r * (t - beta) - r
            out[full, sample] = np.minimum.reduceat(key, starts).astype(np.float32).view(np.uint32)
    return out


def band_hashes(drawn: np.ndarray) -> np.ndarray:
    """(texts, BANDS): one hash for the samples of each band."""
    h = np.zeros((len(drawn), BANDS), _U)
    with np.errstate(over="ignore"):
        for n in range(DEPTH):
            h = _mix(h * _U(5) + drawn.reshape(len(drawn), BANDS, DEPTH)[:, :, n].astype(_U) + _U(1))
    return h.view(np.int64)


def fit_idf(docs: DataFrame, text: str = "text") -> Idf:
    """Count the documents of every shingle into the fixed number of counters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, texts = np.zeros(ROWS * SLOTS, np.int64), 0
        for batch in batches:
            texts += batch.num_rows
            for _, part in text_slices(batch.column(0), SLICE):
                value, _, _ = shingles(part)
                for at in _counters(value):
                    sums += np.bincount(at, minlength=len(sums))
        cell = np.append(np.flatnonzero(sums), ROWS * SLOTS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell, pa.int32()), pa.array(np.append(sums[cell[:-1]], texts))], names=["cell", "n"]
        )

    held = docs.select(text).mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(ROWS * SLOTS + 1)
    sums[held["cell"].to_numpy()] = held["n"].to_numpy()
    return Idf(sums[:-1], int(sums[-1]))


def signatures(docs: DataFrame, idf: Idf, doc_id: str, text: str) -> DataFrame:
    """(id, node, bands): the key of the text and its band hashes; no bands without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_slices(batch.column(2), SLICE):
                value, tf, offsets = shingles(texts)
                bands = band_hashes(samples(value, tf * idf.of(value), offsets))
                rows = [b if n else None for b, n in zip(bands, np.diff(offsets))]
                part = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(rows, pa.list_(pa.int64()))], names=["id", "node", "bands"]
                )

    kind = docs.schema[doc_id].dataType.simpleString()
    keyed = docs.select(F.col(doc_id).alias("id"), text_node(text).alias("node"), whole_text(text).alias("text"))
    return keyed.mapInArrow(run, f"id {kind}, node string, bands array<long>")


def text_node(text: str) -> Column:
    """128 bits that stand for a text."""
    own = whole_text(text)
    return F.concat(F.lower(F.hex(F.xxhash64(own))), F.lit("-"), F.lower(F.hex(F.xxhash64(F.lit(1), own))))


def similar(pairs: DataFrame, texts: DataFrame, idf: Idf, threshold: float) -> DataFrame:
    """The pairs (a, b) of texts (n, text) whose exact weighted Jaccard similarity reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, left in text_slices(batch.column(2), SLICE):
                right = batch.column(3).slice(first, len(left)).cast(pa.large_string())
                # The text of a hot partner is read once per slice.
                coded = pa.concat_arrays([left, right]).dictionary_encode()
                value, tf, offsets = shingles(coded.dictionary)
                weight = tf * idf.of(value)
                place = coded.indices.to_numpy()
                a, b = place[: len(left)], place[len(left) :]
                total = np.add.reduceat(np.append(weight, 0.0), offsets[:-1]) * (np.diff(offsets) > 0)
                shared = np.zeros(len(left))
                for n, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
                    xs, ys = slice(offsets[x], offsets[x + 1]), slice(offsets[y], offsets[y + 1])
                    _, i, j = np.intersect1d(value[xs], value[ys], assume_unique=True, return_indices=True)
                    shared[n] = np.minimum(weight[xs][i], weight[ys][j]).sum()
                union = total[a] + total[b] - shared
                good = pa.array((shared >= threshold * union) & (union > 0))
                yield pa.RecordBatch.from_arrays(
                    [c.slice(first, len(left)).filter(good) for c in batch.columns[:2]], names=["a", "b"]
                )

    met = pairs.join(texts.select(F.col("n").alias("a"), F.col("text").alias("ta")), "a")
    met = met.join(texts.select(F.col("n").alias("b"), F.col("text").alias("tb")), "b")
    return met.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _neighbours(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of texts that follow each other in a bucket (band, hash) in their `order` there. Buckets
    are cut anywhere by a range sort; a task pairs the rows that it reads in order, and the first row of a
    partition follows the last one of the partition before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        first = last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            band, hashed, node = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:3])
            here = [x[0].item() for x in (band, hashed, node)]
            first = first or here
            if last:
                band, hashed, node = (np.append(x, y) for x, y in zip(last, (band, hashed, node)))
            same = (band[1:] == band[:-1]) & (hashed[1:] == hashed[:-1]) & (node[1:] != node[:-1])
            last = [x[-1].item() for x in (band, hashed, node)]
            yield _pairs(node[:-1][same], node[1:][same])
        if last:
            yield _pairs([first[2]], [last[2]], part, ":".join(map(str, first[:2])), ":".join(map(str, last[:2])))

    def _pairs(a, b, part=None, head=None, tail=None) -> pa.RecordBatch:
        n = len(a)
        columns = [
            pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([part] * n, pa.int32()),
            pa.array([head] * n, pa.string()), pa.array([tail] * n, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "part", "head", "tail"])

    keys = ["band", "hash", "order", "n"]
    sorted_ = members.select("band", "hash", "n", "order").repartitionByRange(*keys).sortWithinPartitions(*keys)
    found = staged(sorted_.mapInArrow(run, "a long, b long, part int, head string, tail string"), "near-order")
    line = Window.orderBy("part")
    ends = found.filter(F.col("part").isNotNull()).select(
        F.col("b").alias("a"), F.lead("a").over(line).alias("b"), "tail", F.lead("head").over(line).alias("head")
    )
    across = ends.filter((F.col("tail") == F.col("head")) & (F.col("a") != F.col("b"))).select("a", "b")
    return found.filter(F.col("part").isNull()).select("a", "b").unionByName(across)


def prefixes(texts: DataFrame, idf: Idf, threshold: float) -> DataFrame:
    """(key, n, root, members, total, rest): the shingles of texts (n, root, members, text), rarest first, as long
    as the weight `rest` from there on is at least the threshold's share of the text's weight `total`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in text_slices(batch.column(3), SLICE):
                value, tf, offsets = shingles(part)
                own = idf.of(value)
                text = np.repeat(np.arange(len(part)), np.diff(offsets))
                order = np.lexsort((value, -own, text))
                weight = (tf * own).astype(np.float64)[order]
                ends = np.concatenate([[0.0], np.cumsum(weight)])
                total = np.diff(ends[offsets])[text]
                rest = ends[offsets[1:]][text] - ends[:-1]
                kept = np.flatnonzero(rest >= SLACK * threshold * total)
                place = pa.array(text[kept] + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(value[order][kept].view(np.int64)), *(batch.column(c).take(place) for c in range(3)),
                        pa.array(total[kept].astype(np.float32)), pa.array(rest[kept].astype(np.float32)),
                    ],
                    names=["key", "n", "root", "members", "total", "rest"],
                )

    rows = texts.select("n", "root", "members", "text")
    return rows.mapInArrow(run, "key long, n long, root long, members long, total float, rest float")


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The root of each row's text; a text without links is its own class."""
    held = rows.drop("root").join(roots.withColumnRenamed("node", "n"), "n", "left")
    return held.withColumn("root", F.coalesce("root", "n"))


def _classes(rooted: DataFrame, turn: int) -> DataFrame:
    """(band, hash, root, n): the classes of buckets that hold several, with one text for each; another text
    stands for a class in every turn."""
    ones = rooted.groupBy("band", "hash", "root").agg(F.min_by("n", F.xxhash64("n", F.lit(turn))).alias("n"))
    ones = staged(ones, "near-ones")
    mixed = ones.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("classes")).filter("classes > 1")
    return ones.join(mixed.select("band", "hash"), ["band", "hash"], "left_semi")


class _Links:
    """Verified links, tried pairs and the classes they make."""

    def __init__(self, texts: DataFrame, idf: Idf, threshold: float):
        self.texts, self.idf, self.threshold = texts, idf, threshold
        self.links = self.tried = self.roots = None
        self.verified = 0

    def verify(self, pairs: DataFrame) -> bool:
        """Compare pairs that were not tried before; whether any of them is a link."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.tried is not None:
            pairs = pairs.join(self.tried, ["a", "b"], "left_anti")
        pairs = staged(pairs, "near-pairs")
        self.verified += pairs.count()
        new = staged(similar(pairs, self.texts, self.idf, self.threshold), "near-links")
        self.tried = pairs if self.tried is None else self.tried.unionByName(pairs)
        found = self.links is None or new.limit(1).count() > 0
        if found:
            # Classes that were found before are chains of their own; only what joins them is new.
            chains = [] if self.roots is None else [self.roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))]
            self.links = reduce(DataFrame.unionByName, chains, new)
            self.roots = components(self.links, "near")
        return found


def _settle(members: DataFrame, signs: DataFrame, found: _Links) -> DataFrame:
    """Link the classes of each bucket to their neighbours, in TURNS orders; (n, root) of the texts in buckets of
    more than two texts that are unsettled after that."""
    for turn in range(TURNS):
        ones = _classes(_rooted(members, found.roots), turn).join(signs, "n")
        later = [F.shiftright(F.element_at("bands", F.pmod(F.col("band") + 2 * turn + k, F.lit(BANDS)) + 1), 32) for k in (1, 2)]
        ones = ones.select("band", "hash", "n", F.shiftleft(later[0], 32).bitwiseXOR(later[1]).alias("order"))
        if not found.verify(_neighbours(ones)):
            break
    rooted = staged(_rooted(members.filter("size > 2"), found.roots), "near-rooted")
    mixed = _classes(rooted, 0).select("band", "hash").distinct()
    return staged(rooted.join(mixed, ["band", "hash"], "left_semi").select("n", "root").distinct(), "near-unsettled")


def _dealt(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join rows of texts with rows of classes or texts per `key`; of a hot key (lefts, rights) both sides are
    dealt out in parts of DEALT, and each part meets each part of the other side."""
    rows, columns = (F.greatest(F.ceil(F.col(c) / DEALT), F.lit(1)).cast("int") for c in ("lefts", "rights"))

    def copies(count: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), count - 1))

    def part(count: Column, name: str) -> Column:
        return F.pmod(F.xxhash64(name), count).cast("int")

    left = left.withColumn("row", part(rows, "n_a")).withColumn("column", copies(columns)).drop("lefts", "rights")
    right = right.withColumn("column", part(columns, "n")).withColumn("row", copies(rows)).drop("lefts", "rights")
    return left.join(right, ["key", "row", "column"])


def _looked_up(rows: DataFrame, lookup: DataFrame, where: Column | None = None) -> DataFrame:
    """Join rows with a lookup of one row per key, the rows of a key in COPIES parts."""
    copies = lookup.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))).withColumnRenamed("key", "_key")
    rows = rows.withColumn("_copy", F.pmod(F.xxhash64("n"), F.lit(COPIES)).cast("int"))
    same = (F.col("key") == F.col("_key")) & (F.col("_copy") == F.col("copy"))
    return rows.join(copies, same if where is None else same & where).drop("_key", "copy", "_copy")


def _complete(unsettled: DataFrame, found: _Links) -> None:
    """Find all links between different classes of the texts (n, root) of unsettled buckets."""
    threshold = found.threshold
    sizes = unsettled.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    classed = skew_join(unsettled, sizes, ["root"])
    # The lighter text of a pair needs this share of its weight.
    short = F.col("rest") >= F.lit(SLACK * 2 * threshold / (1 + threshold)) * F.col("total")
    needed = F.lit(SLACK * threshold / (1 + threshold)) * (F.col("total_a") + F.col("total"))
    rows = prefixes(found.texts.join(classed, "n"), found.idf, threshold).withColumn("short", short)
    rows = staged(rows, "near-prefixes")

    classes = rows.groupBy("key", "root", "members").agg(
        F.max_by("n", F.struct("rest", "n")).alias("n"), F.max("rest").alias("rest"), F.min("total").alias("total"),
        F.max("short").alias("short"), F.count(F.lit(1)).alias("size"),
    )
    classes = staged(classes, "near-classes")
    keys = classes.groupBy("key").agg(
        F.sum("size").alias("lefts"), F.count(F.lit(1)).alias("rights"), F.max("short").alias("any"),
        F.max(F.struct("members", "root")).alias("top"),
    )
    keys = staged(keys.filter("rights > 1 and any").select("key", "lefts", "rights", "top"), "near-keys")
    # A text of a smaller class meets the classes above its own.
    low = _looked_up(rows, keys, F.struct("members", "root") < F.col("top"))
    low = low.select("key", "lefts", "rights", *[F.col(c).alias(f"{c}_a") for c in ("n", "root", "total", "rest", "short", "members")])
    met = _dealt(staged(low, "near-low"), _looked_up(classes, keys.drop("top")))
    met = met.filter(
        (F.struct("members_a", "root_a") < F.struct(F.col("members").alias("members_a"), F.col("root").alias("root_a")))
        & (F.col("short_a") | F.col("short"))
        & (F.least("rest_a", "rest") >= needed)
    )
    tries = met.groupBy("n_a", "root_a", "root").agg(
        F.max_by("n", F.struct(F.least("rest_a", "rest"), "n")).alias("n"), F.max("members").alias("members")
    )
    tries = staged(tries, "near-tries")
    found.verify(tries.select(F.col("n_a").alias("a"), F.col("n").alias("b")))

    # What is in two classes still, beside a class's chosen text: the text and every text of the class, where
    # their own bound allows it.
    now = _rooted(unsettled.select(F.col("root").alias("n")).distinct(), found.roots)
    open_ = tries.filter("members > 1").select("n_a", "root_a", "root")
    for name in ("root_a", "root"):
        open_ = skew_join(open_, now.select(F.col("n").alias(name), F.col("root").alias(f"now_{name}")), [name])
    open_ = staged(open_.filter("now_root_a <> now_root").select("n_a", "root"), "near-open")
    place = F.struct("key", "root").alias("key")
    texts = rows.select("key", *[F.col(c).alias(f"{c}_a") for c in ("n", "total", "rest", "short")])
    texts = staged(texts.join(open_, "n_a").select(place, "n_a", "total_a", "rest_a", "short_a"), "near-low")
    counted = texts.groupBy("key").agg(F.count(F.lit(1)).alias("lefts"))
    theirs = classes.select(place, F.col("size").alias("rights"))
    counted = staged(counted.join(theirs, "key"), "near-keys")
    others = _looked_up(rows.select(place, "n", "total", "rest", "short"), counted)
    met = _dealt(_looked_up(texts.withColumn("n", F.col("n_a")), counted).drop("n"), others)
    met = met.filter((F.least("rest_a", "rest") >= needed) & F.when(F.col("total_a") <= F.col("total"), F.col("short_a")).otherwise(F.col("short")))
    found.verify(met.select(F.col("n_a").alias("a"), F.col("n").alias("b")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, node, class_id, class_size, keep): the class of every document, named by its smallest id, and
    whether the document is the one that stays; of rows with the same id and text each is marked."""
    idf = fit_idf(docs, text)
    signed = staged(signatures(docs, idf, doc_id, text), "near-signed")
    # From here on a text is a number.
    nodes = signed.groupBy("node").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("rows"), F.first("bands").alias("bands"))
    nodes = staged(nodes.withColumn("n", F.monotonically_increasing_id()), "near-nodes")

    members = nodes.filter(F.col("bands").isNotNull()).select("n", "id", F.posexplode("bands").alias("band", "hash"))
    size = members.groupBy("band", "hash").agg(
        F.count(F.lit(1)).alias("size"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "n")).alias("least")
    )
    shared = size.filter("size > 1").select("band", "hash", "size", F.col("least.n").alias("leader"))
    members = staged(skew_join(members.drop("id"), shared, ["band", "hash"]), "near-members")

    involved = staged(members.select("n").distinct().join(nodes.select("n", "node", "bands"), "n"), "near-involved")
    texts = docs.select(text_node(text).alias("node"), whole_text(text).alias("text"))
    texts = staged(texts.join(involved.select("n", "node"), "node").select("n", "text").dropDuplicates(["n"]), "near-texts")

    found = _Links(texts, idf, threshold)
    star = members.filter("n <> leader").groupBy("n").agg(F.max_by("leader", F.struct("size", "leader")).alias("leader"))
    found.verify(star.select(F.col("leader").alias("a"), F.col("n").alias("b")))
    _complete(_settle(members, involved.select("n", "bands"), found), found)
    roots = found.roots

    rooted = nodes.select("n", "node", "id", "rows").join(roots.withColumnRenamed("node", "n"), "n", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "n"))
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "n")).alias("least")
    classes = rooted.groupBy("root").agg(least, F.sum("rows").alias("class_size"))
    named = rooted.join(classes, "root").select(
        "node", F.col("least.id").alias("class_id"), "class_size", (F.col("n") == F.col("least.n")).alias("leads")
    )
    return signed.select("id", "node").join(named, "node").select(
        "id", "node", "class_id", "class_size", (F.col("leads") & F.col("id").eqNullSafe(F.col("class_id"))).alias("keep")
    )


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, with its columns; of rows with the same id and text one stays."""
    node, found = fresh("node", "id")
    kept = near_duplicates(docs, doc_id, text).filter("keep").select(F.col("id").alias(found), F.col("node").alias(node)).distinct()
    tagged = docs.withColumn(node, text_node(text))
    joined = tagged.join(
        kept.withColumnRenamed(node, f"{node}k"),
        (F.col(node) == F.col(f"{node}k")) & F.col(doc_id).eqNullSafe(F.col(found)),
        "left_semi",
    )
    return joined.dropDuplicates([node]).select(*docs.columns)
