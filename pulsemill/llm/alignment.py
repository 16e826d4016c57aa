"""Tokens of two tokenizers over the same text, aligned by their byte ranges.

A is a byte-level tokenizer file that reads a blank and the text, B a sentencepiece model that adds the
blank itself. A text falls apart at blanks that surely begin a token, and each distinct part is encoded once. The tokens of both tile the same bytes. All tokens of a slice of documents are sorted by their
start; where a start reaches the running maximum of the ends, a group ends. Inside a group every A token is
linked to the B tokens whose range it overlaps.

How many documents hold a pair of ids linked is counted over all of them. Documents lie in blocks of about
BLOCK bytes. A block lists its distinct pairs with the number of its documents, so a pair that is in every
document is one row a block. The counts and the highest count of each A id come back to the blocks in the
same way, and a task meets one block and its pairs, never a whole group of documents.

Nulls: a null or empty text, or one whose joined tokens differ from the blank and the text (it holds the
mark that stands for blanks), has no tokens: zeros and an empty digest. Repeated rows and null ids are rows
like others and count as documents of their own. No rows give no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemill.llm.codec import PieceCodec
from pulsemill.llm.ragged import as_bytes, distinct, from_bytes, gather, text_slices
from pulsemill.llm.shared import staged

BLOCK = 1 << 20
# Text bytes that are encoded together.
SLICE = 2 << 20
# Chunks that the library reads as one text, and texts of one call.
JOINED, CALL = 512, 8


def _byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary shows for each byte: printable Latin-1 letters stand for
    themselves, all others follow from code 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def _plain(byte: np.ndarray) -> np.ndarray:
    return (byte > 0x20) & (byte < 0x7F)


def _lead(byte: np.ndarray) -> np.ndarray:
    """First bytes of letters of two bytes, without the block that has blanks."""
    return (byte >= 0xC3) & (byte <= 0xDF)


def _opens(byte: np.ndarray) -> np.ndarray:
    return _plain(byte) | _lead(byte)


def chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Parts of every text that a byte-level tokenizer reads one by one, and each text's offset into them.

    A token with a blank in front begins at every blank between two letters, digits or marks, whatever is
    before and behind it. Cuts are made where both neighbours are ASCII or of two bytes, none of them white.
    """
    flat, offsets = as_bytes(texts)
    n = len(flat)
    before, behind = np.zeros(n, bool), np.zeros(n, bool)
    before[1:] = _plain(flat[:-1])
    before[2:] |= _lead(flat[:-2])
    behind[:-1] = _opens(flat[1:])
    cut = np.zeros(n + 1, bool)
    cut[:-1] = (flat == 0x20) & before & behind
    cut[offsets] = True
    starts = np.flatnonzero(cut[:-1])
    counted = np.concatenate([[0], np.cumsum(cut[:-1])])
    return from_bytes(flat, np.append(starts, n)), counted[offsets]


class Tokenizers:
    """Both tokenizers with the bytes of every id."""

    def __init__(self, byte_file: str, piece_file: str):
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_file)
        self.a.encode_special_tokens = True
        self.b = PieceCodec(piece_file)
        letters = _byte_letters()
        vocab = self.a.get_vocab()
        self.bytes_a = np.full(max(vocab.values()) + 1, b"", object)
        for token, i in vocab.items():
            known = all(c in letters for c in token)
            self.bytes_a[i] = bytes(letters[c] for c in token) if known else token.encode()
        self.bytes_b = self.b.surface
        self.sizes_a = np.array([len(x) for x in self.bytes_a])
        self.sizes_b = np.array([len(x) for x in self.bytes_b])
        self.first_b = len(self.bytes_a)
        # An id with the mark that may follow it.
        numbers = [str(i) for i in range(len(self.bytes_a))] + [str(i) for i in range(len(self.bytes_b))]
        self.written = np.array([n + mark for mark in ("", ",", "|", ";") for n in numbers], object)

    def _encode_a(self, led: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts, offsets = chunks(led)
        index, known = distinct(parts)
        flat, ends = as_bytes(known)
        # Chunks that were cut off at both ends can be read as one text, cut by the lengths of its tokens.
        head, tail = flat[np.minimum(ends[:-1] + 1, ends[1:] - 1)], flat[ends[1:] - 1]
        inner = (flat[ends[:-1]] == 0x20) & (np.diff(ends) > 1) & _opens(head)
        inner &= _plain(tail) | (np.diff(ends) > 2) & _lead(flat[np.maximum(ends[1:] - 2, 0)])
        order = np.concatenate([np.flatnonzero(inner), np.flatnonzero(~inner)])
        joined = known.take(pa.array(order))
        n = int(inner.sum())
        size = np.diff(ends)[order]
        texts = ["".join(joined[i : min(i + JOINED, n)].to_pylist()) for i in range(0, n, JOINED)] + joined[n:].to_pylist()
        found = [np.empty(0, np.int64)]
        for i in range(0, len(texts), CALL):
            coded = self.a.encode_batch_fast(texts[i : i + CALL], add_special_tokens=False)
            found.append(np.fromiter(chain.from_iterable(e.ids for e in coded), np.int64))
        ids = np.concatenate(found)
        # The first token of every chunk begins where the chunk begins.
        begins = np.concatenate([[0], np.cumsum(self.sizes_a[ids])])
        places = np.searchsorted(begins, np.concatenate([[0], np.cumsum(size)]))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        ids, at = gather(ids, places, back[index])
        return ids, at[offsets]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both for all texts and each text's offset into them; none where the bytes differ."""
        texts = texts.cast(pa.large_string())
        space = pa.scalar(" ", pa.large_string())
        led = pc.binary_join_element_wise(space, texts, pa.scalar("", pa.large_string()))
        ids_a, at_a = self._encode_a(led)
        ids_b, at_b = self.b.encode(texts)
        flat, ends = as_bytes(led)
        whole = memoryview(flat)
        good = [
            j > i + 1
            and whole[i:j] == b"".join(self.bytes_a[ids_a[a:b]].tolist())
            and whole[i:j] == b"".join(self.bytes_b[ids_b[c:d]].tolist())
            for i, j, a, b, c, d in zip(*(x.tolist() for x in (ends[:-1], ends[1:], at_a[:-1], at_a[1:], at_b[:-1], at_b[1:])))
        ]
        if not all(good):
            ids_a, at_a = gather(*_without(ids_a, at_a, good))
            ids_b, at_b = gather(*_without(ids_b, at_b, good))
        return ids_a, at_a, ids_b.astype(np.int64), at_b


def _without(ids: np.ndarray, offsets: np.ndarray, good: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The groups, with one empty group behind them, and which of them each text keeps."""
    return ids, np.append(offsets, offsets[-1]), np.where(good, np.arange(len(good)), len(good))


@cache
def _tokenizers(byte_file: str, piece_file: str) -> Tokenizers:
    return Tokenizers(byte_file, piece_file)


def coalesce(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray):
    """(order, group): all intervals, A before B, sorted by start and side, and the group of each."""
    starts, ends = np.concatenate([starts_a, starts_b]), np.concatenate([ends_a, ends_b])
    side = np.repeat([0, 1], [len(starts_a), len(starts_b)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    return order, np.cumsum(breaks) - 1


def overlaps(starts_a, ends_a, starts_b, ends_b) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): indices of all pairs of intervals whose ranges overlap."""
    first = np.searchsorted(ends_b, starts_a, side="right")
    count = np.searchsorted(starts_b, ends_a, side="left") - first
    a = np.repeat(np.arange(len(starts_a)), count)
    inside = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
    return a, first[a] + inside


def _aligned(both: Tokenizers, ids_a: np.ndarray, at_a: np.ndarray, ids_b: np.ndarray, at_b: np.ndarray) -> dict:
    """Counts, digests and the distinct links of each text."""
    n = len(at_a) - 1
    # One line of bytes for all texts: groups and links cannot cross from one text to the next.
    ends_a, ends_b = np.cumsum(both.sizes_a[ids_a]), np.cumsum(both.sizes_b[ids_b])
    ranges = ends_a - both.sizes_a[ids_a], ends_a, ends_b - both.sizes_b[ids_b], ends_b

    order, group = coalesce(*ranges)
    # A tokens before B tokens within their group, each side in its order.
    side = order >= len(ids_a)
    by_group = np.argsort(2 * group + side, kind="stable")
    order, group, side = order[by_group], group[by_group], side[by_group]
    at = at_a + at_b
    marks = np.full(len(order), 3)
    marks[:-1][group[1:] == group[:-1]] = 2
    marks[:-1][(group[1:] == group[:-1]) & (side[1:] == side[:-1])] = 1
    marks[at[1:][np.diff(at) > 0] - 1] = 0
    groups = np.concatenate([[0], np.cumsum((marks == 3) | (marks == 0))])
    number = np.concatenate([ids_a, ids_b + both.first_b])[order]
    letters = both.written[marks * (len(both.written) // 4) + number].tolist()
    digests = [
        hashlib.sha256("".join(letters[i:j]).encode()).hexdigest() if j > i else ""
        for i, j in zip(at[:-1].tolist(), at[1:].tolist())
    ]

    a, b = overlaps(*ranges)
    pairs = len(both.bytes_a) * len(both.bytes_b)
    doc = np.repeat(np.arange(n), np.diff(at_a))[a]
    link = np.sort(doc * pairs + ids_a[a] * len(both.bytes_b) + ids_b[b])
    first = np.flatnonzero(np.append(True, link[1:] != link[:-1])[: len(link)])
    held = link[first]
    return {
        "n_a": np.diff(at_a),
        "n_b": np.diff(at_b),
        "n_groups": groups[at[1:]] - groups[at[:-1]],
        "n_links": np.bincount(doc, minlength=n),
        "digests": digests,
        "pair": held % pairs,
        "times": np.diff(np.append(first, len(link))),
        "at": np.searchsorted(held, np.arange(n + 1) * pairs),
    }


def aligned(docs: DataFrame, byte_file: str, piece_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: (block, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) with its
    distinct links, and one row per block without n_a: its distinct links and how many documents hold each.
    A pair is its A id times the number of B ids plus its B id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _tokenizers(byte_file, piece_file)
        block = TaskContext.get().partitionId() << 40
        for batch in batches:
            for begin, whole in text_slices(batch.column(1), SLICE):
                ids_a, at_a, ids_b, at_b = both.encode(whole)
                for first, texts in text_slices(whole, BLOCK):
                    of = slice(first, first + len(texts) + 1)
                    (a, *_, a_end), (b, *_, b_end) = at_a[of], at_b[of]
                    done = _aligned(both, ids_a[a:a_end], at_a[of] - a, ids_b[b:b_end], at_b[of] - b)
                    yield described(block, batch.column(0).slice(begin + first, len(texts)), done)
                    block += 1

    def described(block: int, ids: pa.Array, done: dict) -> pa.RecordBatch:
        pair, docs_with = np.unique(done["pair"], return_counts=True)
        n = len(ids)
        places = np.append(done["at"], done["at"][-1] + len(pair))
        lists = [
            pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(np.append(own, all_), kind))
            for own, all_, kind in ((done["pair"], pair, pa.int64()), (done["times"], docs_with, pa.int32()))
        ]
        counts = [pa.array([*done[c].tolist(), None], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
        keys = pa.concat_arrays([ids, pa.nulls(1, ids.type)])
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * (n + 1), pa.int64()), keys, *counts, pa.array([*done["digests"], None], pa.string()), *lists],
            names=["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
        )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(
        run,
        f"block long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, times array<int>",
    )


def pair_counts(blocks: DataFrame, n_b: int) -> DataFrame:
    """(pair, docs, best): how many documents hold the pair, and whether that is the most for its A id."""
    held = blocks.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    counts = staged(held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("docs")), "align-pairs")
    a = F.floor(F.col("pair") / F.lit(n_b)).alias("a")
    # One row per A id that occurs, so at most the size of its vocabulary.
    most = counts.groupBy(a).agg(F.max("docs").alias("most"))
    return counts.join(F.broadcast(most), a == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def _scored(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a block with the sums over their links."""
    order = np.argsort(right["pair"].to_numpy())
    pair = right["pair"].to_numpy()[order]
    docs, best = right["docs"].to_numpy()[order], right["best"].to_numpy()[order]
    pairs, times = left["pairs"].combine_chunks(), left["times"].combine_chunks()
    ends = np.cumsum(np.append(0, pc.list_value_length(pairs).to_numpy(zero_copy_only=False)))
    at = np.searchsorted(pair, pairs.flatten().to_numpy())
    weight = times.flatten().to_numpy().astype(np.int64)
    sums = [np.concatenate([[0], np.cumsum(weight * of[at])]) for of in (best.astype(np.int64), docs)]
    n_best, count_sum = (pa.array(s[ends[1:]] - s[ends[:-1]], pa.int64()) for s in sums)
    kept = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return kept.append_column("n_best", n_best).append_column("count_sum", count_sum).append_column("groups_sha256", left["groups_sha256"])


def align(docs: DataFrame, byte_file: str, piece_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    from sentencepiece import SentencePieceProcessor

    n_b = SentencePieceProcessor(model_file=piece_file).get_piece_size()
    rows = staged(aligned(docs, byte_file, piece_file, doc_id, text), "align-rows")
    blocks = rows.filter("n_a is null").select(F.col("block").alias("place"), "pairs", "times")
    counts = staged(pair_counts(blocks, n_b), "align-counts")
    wanted = blocks.select("place", F.explode("pairs").alias("pair")).join(counts, "pair")
    kind = docs.schema[doc_id].dataType.simpleString()
    return (
        rows.filter("n_a is not null")
        .groupBy("block")
        .cogroup(wanted.groupBy("place"))
        .applyInArrow(
            _scored,
            f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
        )
    )
