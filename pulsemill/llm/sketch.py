"""Document fingerprints: threshold-scaled sketches of word shingles.

A shingle is a word with the four words before it; the first words of a text make shorter ones, so any
text with a word has shingles. A sketch keeps every shingle hash below the fixed fraction 1/SCALE of the
hash range, so sketches of very unequal texts stay comparable, and the union of sketches is the sketch
of the joined texts. Where fewer than LEAST hashes lie below it the LEAST smallest are kept, and the
sketch says below which bound it is complete ("bound:hash,hash,...", hexadecimal). Two sketches are
compared below the smaller of their bounds. Everything is built from SQL functions.

Nulls: a null text is empty; the sketch of a text without words is empty, like another such text (1) and
unlike any other (0). Null ids come first in the order. Rows of the same id and text are one document and
are treated alike, so the next document is the next different (id, text). No rows give no rows. Extra
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.llm.shared import staged, whole_text
from pulsemill.plans.once import with_columns_once

WORDS = 5
SCALE = 4
LEAST = 64
# Hashes are 31-bit numbers: a sketch is moved with the text, and two texts rarely share one by chance.
RANGE = 1 << 31


def _shingles(hashed: Column) -> Column:
    def one(h: Column, i: Column) -> Column:
        before = [F.get(hashed, i - n) for n in range(1, WORDS)]
        return F.shiftrightunsigned(F.xxhash64(h, *before), 33).cast("int")

    return F.transform(hashed, one)


def with_sketch(df: DataFrame, sketches: dict[str, Column], scale: int = SCALE, least: int = LEAST) -> DataFrame:
    """Add a struct (bound, hashes) for each named text."""
    df = with_columns_once(
        df,
        {
            f"_w_{name}": F.transform(
                F.filter(F.split(text, r"\s+"), lambda w: w != ""), lambda w: F.xxhash64(w)
            )
            for name, text in sketches.items()
        },
    )
    df = with_columns_once(df, {f"_h_{name}": _shingles(F.col(f"_w_{name}")) for name in sketches})
    bound = RANGE // scale
    low = {name: F.array_sort(F.array_distinct(F.filter(f"_h_{name}", lambda h: h < bound))) for name in sketches}
    df = with_columns_once(df, {f"_l_{name}": low[name] for name in sketches})

    def sketch(name: str) -> Column:
        kept = F.col(f"_l_{name}")
        every = F.slice(F.array_sort(F.array_distinct(F.col(f"_h_{name}"))), 1, least + 1)
        few = F.when(
            F.size(every) <= least, F.struct(F.lit(RANGE).cast("long").alias("bound"), every.alias("hashes"))
        ).otherwise(
            F.struct(F.element_at(every, least + 1).cast("long").alias("bound"), F.slice(every, 1, least).alias("hashes"))
        )
        enough = F.struct(F.lit(bound).cast("long").alias("bound"), kept.alias("hashes"))
        return F.when(F.size(kept) >= least, enough).otherwise(few)

    df = with_columns_once(df, {name: sketch(name) for name in sketches})
    return df.drop(*[f"_{k}_{name}" for k in "whl" for name in sketches])


def written(sketch: str) -> Column:
    """A sketch as text."""
    hashes = F.transform(f"{sketch}.hashes", lambda h: F.lower(F.hex(h)))
    return F.concat(F.lower(F.hex(f"{sketch}.bound")), F.lit(":"), F.array_join(hashes, ","))


def parsed(text: Column) -> Column:
    """The struct of a written sketch."""
    listed = F.filter(F.split(F.substring_index(text, ":", -1), ","), lambda h: h != "")
    return F.struct(
        F.conv(F.substring_index(text, ":", 1), 16, 10).cast("long").alias("bound"),
        F.transform(listed, lambda h: F.conv(h, 16, 10).cast("int")).alias("hashes"),
    )


def _common(a: str, b: str) -> tuple[Column, Column, Column]:
    """How many hashes both, the first and the second sketch have below the smaller bound."""
    bound = F.least(f"{a}.bound", f"{b}.bound")
    left = F.filter(f"{a}.hashes", lambda h: h < bound)
    right = F.filter(f"{b}.hashes", lambda h: h < bound)
    return F.size(F.array_intersect(left, right)), F.size(left), F.size(right)


def likeness(a: str, b: str) -> Column:
    """Estimated Jaccard similarity of two texts by their sketches."""
    both, left, right = _common(a, b)
    union = left + right - both
    return F.when(F.col(a) == F.col(b), 1.0).when(union == 0, 0.0).otherwise(both / union)


def containment(a: str, b: str) -> Column:
    """Estimated share of the first text's shingles that the second one has."""
    both, left, _ = _common(a, b)
    return F.when(F.col(a) == F.col(b), 1.0).when(left == 0, 0.0).otherwise(both / left)


def merged(a: str, b: str, scale: int = SCALE, least: int = LEAST) -> Column:
    """The sketch of two texts together: all hashes of both below the smaller bound."""
    bound = F.least(f"{a}.bound", f"{b}.bound")
    every = F.array_sort(F.array_union(f"{a}.hashes", f"{b}.hashes"))
    return F.struct(bound.alias("bound"), F.filter(every, lambda h: h < bound).alias("hashes"))


def next_documents(rows: DataFrame) -> DataFrame:
    """(k1, k2, need, n1, n2): of each (id, k1, k2, need) the keys of the row that follows it in the order
    (id, k2), the first one after the last.

    Rows are range-partitioned and sorted, so their running number says which partition and place they
    have; the follower is found by number, and the first row of the next partition closes a partition.
    Ids and hashes are moved, texts are not.
    """
    ordered = rows.distinct().repartitionByRange("id", "k2", "k1").sortWithinPartitions("id", "k2", "k1")
    numbered = staged(ordered.withColumn("at", F.monotonically_increasing_id()), "sketch-order")
    part = F.shiftright("at", 33)
    # One row for each partition: few, and they meet in one task.
    heads = numbered.groupBy(part.alias("part")).agg(
        F.min_by(F.struct("k1", "k2"), "at").alias("head"), F.max("at").alias("last")
    )
    line = Window.orderBy("part")
    ring = heads.select(
        F.col("last").alias("at"),
        F.coalesce(
            F.lead("head").over(line),
            F.first("head").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("head"),
    )
    follower = numbered.select((F.col("at") - 1).alias("at"), F.struct("k1", "k2").alias("next"))
    return (
        numbered.join(follower, "at", "left")
        .join(ring, "at", "left")
        .select("k1", "k2", "need", F.coalesce("next", "head").alias("n"))
        .select("k1", "k2", "need", F.col("n.k1").alias("n1"), F.col("n.k2").alias("n2"))
    )


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_chars, text, edited, sketch, edited_sketch, next_doc_id, next_sketch) of every document, where the
    last quarter of the edited text is replaced by the beginning of the next document."""
    base = docs.select(F.col(doc_id).alias("id"), whole_text(text).alias("text")).select(
        "*", F.xxhash64("id", "text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2")
    )
    size = F.char_length("text")
    quarter = F.floor(size / 4).cast("int")
    links = staged(next_documents(base.select("id", "k1", "k2", quarter.alias("need"))), "sketch-links")
    # Texts are moved once, to their keys; a quarter of them goes on to the document before.
    asked = links.select(
        F.col("n1").alias("k1"), F.col("n2").alias("k2"), F.struct(F.col("k1").alias("to1"), F.col("k2").alias("to2"), "need").alias("ask")
    )
    met = base.join(asked, ["k1", "k2"])
    sent = with_sketch(
        met.select("ask.to1", "ask.to2", F.col("id").alias("next_doc_id"), F.substring(F.col("text"), F.lit(1), F.col("ask.need")).alias("prefix"), "text"),
        {"sketch": F.col("text")},
    )
    # The id goes along for the result, and lets both joins read one shuffle of the texts.
    sent = sent.select(F.col("to1").alias("k1"), F.col("to2").alias("k2"), "next_doc_id", "prefix", F.col("sketch").alias("next_sketch"))
    sent = sent.dropDuplicates(["k1", "k2"])
    both = base.join(sent, ["k1", "k2"])
    kept = F.substring(F.col("text"), F.lit(1), size - quarter)
    edited = with_columns_once(both, {"edited": F.concat(kept, F.col("prefix"))})
    sketched = with_sketch(edited, {"sketch": F.col("text"), "edited_sketch": F.col("edited")})
    return sketched.select(
        F.col("id").alias("doc_id"), size.cast("long").alias("n_chars"), "text", "edited", "sketch", "edited_sketch", "next_doc_id", "next_sketch"
    )


def fingerprint_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The fingerprints as text, with their likeness."""
    found = with_columns_once(
        fingerprints(docs, doc_id, text),
        {
            "fingerprint": written("sketch"),
            "edited_fingerprint": written("edited_sketch"),
            "edited_sha256": F.sha2("edited", 256),
            "near_edited": likeness("sketch", "edited_sketch"),
            "near_next": likeness("sketch", "next_sketch"),
        },
    )
    return found.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
        "next_doc_id",
    )
