"""Best-fit packing of tokenized documents by a grouping genetic algorithm.

A document is tokenized, gets an end id, and is cut into pieces only where it exceeds the sequence
length. Pieces of full length are sequences of their own. All others are dealt to shards by hash, so a
shard holds about SHARD pieces whatever the input. Each shard is evolved on ISLANDS islands, tasks that
start from best-fit-decreasing packings of slightly disturbed sizes. Crossover puts whole well-filled
bins of one parent into the other, removes the bins that hold a piece twice, and best-fits the displaced
pieces, longest first. After each round an island's best packing migrates to the next island of the
shard. An island stops at the lower bound of its shard. What the best packings leave in poorly filled
bins meets once more, in shards of their own.

Nulls: a null text is empty and gives the end id alone; a null id is a value like any other. Repeated
rows are packed each for itself. No rows give no rows. Other columns of the input are not looked at.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.llm.merges import PairTable, merge_words
from pulsemill.llm.ragged import as_bytes, distinct, from_bytes, text_slices
from pulsemill.llm.shared import spread, staged

CAPACITY = 2048
SHARD = 8192
ISLANDS = 2
ROUNDS = 2
GENERATIONS = 3
PARENTS = 3
WELL_FILLED = 0.985

# Fixed value: how the tokenizer file cuts a text into words.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BLANK, LETTER, DIGIT, SIGN, ODD = range(5)


def _byte_classes() -> np.ndarray:
    """The class of each byte of plain text: ASCII and, behind 0xC3, the Latin letters with marks."""
    kind = np.full(256, ODD, np.uint8)
    for code in range(33, 127):
        letter = chr(code)
        kind[code] = LETTER if letter.isalpha() else DIGIT if letter.isdigit() else SIGN
    kind[[32, 10]] = BLANK
    kind[ord("'")] = ODD
    return kind


class WordTokenizer:
    """The ids of a tokenizer file of the merge type with word ends. Words of ASCII and Latin letters are
    lower-cased and cut by their bytes, and every distinct word of a slice is merged once; a chunk between
    blanks that holds anything else goes through the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] != WORD_PATTERN:
            raise ValueError("the tokenizer cuts words in another way")
        vocab = spec["model"]["vocab"]
        suffix = spec["model"]["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.table = PairTable(
            [vocab[a] for a, _ in pairs],
            [vocab[b] for _, b in pairs],
            range(len(pairs)),
            [vocab[a + b] for a, b in pairs],
        )
        shown = _byte_letters()
        self.inside = np.array([vocab[c] for c in shown], np.int32)
        self.last = np.array([vocab[c + suffix] for c in shown], np.int32)
        self.kind = _byte_classes()

    def words(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The words of all texts, whether each needs the library, and each text's offset into them."""
        flat, offsets = as_bytes(texts)
        n = len(flat)
        kind = self.kind[flat]
        lead = np.flatnonzero(flat[:-1] == 0xC3)
        tail = flat[lead + 1]
        lead = lead[(tail != 0x97) & (tail != 0xB7)]
        kind[lead] = kind[lead + 1] = LETTER
        special = np.flatnonzero((flat[:-1] == 0x3C) & (flat[1:] == 0x7C))
        kind[special] = ODD

        begins = np.zeros(n + 1, bool)
        begins[offsets] = True
        begins = begins[:n]
        begins[1:] |= kind[:-1] == BLANK
        starts = begins.copy()
        starts[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        odd_byte = np.zeros(n, bool)
        if (kind == ODD).any():
            # A chunk with any odd byte stays whole.
            heads = np.flatnonzero(begins)
            odd = np.logical_or.reduceat(kind == ODD, heads)
            odd_byte = np.repeat(odd, np.diff(np.append(heads, n)))
            starts &= begins | ~odd_byte

        small = flat.copy()
        small[(flat >= 65) & (flat <= 90) & ~odd_byte] += 32
        small[lead[(flat[lead + 1] < 0x9F) & ~odd_byte[lead]] + 1] += 32

        solid = kind != BLANK
        first = np.flatnonzero(starts & solid)
        blanks = np.flatnonzero(~solid)
        place = first - np.searchsorted(blanks, first)
        words = from_bytes(small[solid], np.append(place, n - len(blanks)))
        return words, odd_byte[first], np.searchsorted(first, offsets)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and each text's offset into them."""
        words, odd, text_offsets = self.words(texts)
        index, known = distinct(words)
        hard = np.zeros(len(known), bool)
        hard[index] = odd

        flat, ends = as_bytes(known.filter(pa.array(~hard)))
        symbols = self.inside[flat]
        symbols[ends[1:] - 1] = self.last[flat[ends[1:] - 1]]
        easy, easy_offsets = merge_words(symbols, ends, self.table)
        spelled = [
            self.library.encode(chunk, add_special_tokens=False).ids
            for chunk in known.filter(pa.array(hard)).to_pylist()
        ]
        # The ids of odd chunks lie behind the others.
        lengths = np.zeros(len(known), np.int64)
        starts = np.zeros(len(known), np.int64)
        lengths[~hard] = easy_offsets[1:] - easy_offsets[:-1]
        lengths[hard] = [len(ids) for ids in spelled]
        starts[~hard] = easy_offsets[:-1]
        starts[hard] = len(easy) + np.concatenate([[0], np.cumsum(lengths[hard])])[:-1]
        values = np.concatenate([easy, np.array([i for ids in spelled for i in ids], np.int32)])
        counts = lengths[index]
        done = np.concatenate([[0], np.cumsum(counts)])
        source = np.repeat(starts[index] - done[:-1], counts) + np.arange(done[-1])
        return values[source], done[text_offsets]


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if it is printable, else the next free one."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(own))}
    return [chr(other.get(b, b)) for b in range(256)]


@cache
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document, in one pass without a shuffle."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _tokenizer(tokenizer)
        for batch in batches:
            keys = batch.column(0)
            for first, texts in text_slices(batch.column(1)):
                ids, offsets = encoder.encode(texts)
                yield pieces_of(keys.slice(first, len(texts)), ids, offsets)

    def pieces_of(keys: pa.Array, ids: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        sizes = offsets[1:] - offsets[:-1] + 1
        counts = -(-sizes // capacity)
        doc = np.repeat(np.arange(len(sizes)), counts)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = piece * capacity
        length = np.minimum(sizes[doc] - start, capacity)
        parts = []
        for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist()):
            part = ids[offsets[d] + s : min(offsets[d] + s + n, offsets[d + 1])].astype("<u4")
            parts.append(np.append(part, np.uint32(end_id)) if len(part) < n else part)
        columns = [
            keys.take(pa.array(doc)),
            pa.array(piece, pa.int32()),
            pa.array(start, pa.int64()),
            pa.array(length, pa.int64()),
            pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()),
        ]
        if with_ids:
            columns.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names=names)

    key_type = docs.schema[doc_id].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = f"doc_id {key_type}, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(cut, schema + ", ids array<int>" * with_ids)


class Bins:
    """A packing in the making: the pieces of each bin, and its free space in order."""

    def __init__(self, sizes: list[int], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.members: list[list[int]] = []
        self.free: list[tuple[int, int]] = []

    def add(self, members: list[int]) -> None:
        room = self.capacity - sum(self.sizes[i] for i in members)
        insort(self.free, (room, len(self.members)))
        self.members.append(members)

    def best_fit(self, items: list[int]) -> None:
        """Put each piece, longest first, where it leaves least room; open a bin if none has room."""
        sizes, free, members = self.sizes, self.free, self.members
        for i in sorted(items, key=lambda i: -sizes[i]):
            size = sizes[i]
            at = bisect_left(free, (size, -1))
            if at == len(free):
                insort(free, (self.capacity - size, len(members)))
                members.append([i])
            else:
                room, held = free.pop(at)
                members[held].append(i)
                if room > size:
                    insort(free, (room - size, held))


def fitness(packing: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins are better; of as many, uneven filling is."""
    return -len(packing), sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in packing)


def crossover(
    into: list[list[int]], other: list[list[int]], sizes: list[int], capacity: int, rng: np.random.Generator
) -> list[list[int]]:
    """Inject about half of the well-filled bins of `other`, drop the bins of `into` that share a piece
    with them, and best-fit the displaced pieces."""
    full = [b for b in other if sum(sizes[i] for i in b) >= WELL_FILLED * capacity]
    chosen = [b for b, keep in zip(full, rng.random(len(full)) < 0.5) if keep]
    taken = {i for b in chosen for i in b}
    child = Bins(sizes, capacity)
    displaced: list[int] = []
    for b in chosen:
        child.add(list(b))
    for b in into:
        if taken.isdisjoint(b) and sum(sizes[i] for i in b) >= WELL_FILLED * capacity:
            child.add(list(b))
        else:
            displaced.extend(i for i in b if i not in taken)
    child.best_fit(displaced)
    return child.members


def evolve(
    sizes: list[int], capacity: int, seed: int, immigrants: list[list[list[int]]], generations: int = GENERATIONS
) -> list[list[int]]:
    """The best packing of one island after some generations."""
    rng = np.random.default_rng(seed)
    bound = -(-sum(sizes) // capacity)
    population = list(immigrants)
    while len(population) < PARENTS:
        start = Bins(sizes, capacity)
        if population or seed % ISLANDS:
            # Some bins are filled at random first; the rest is best-fit.
            order = rng.permutation(len(sizes))
            some, rest = order[: len(sizes) // 8], order[len(sizes) // 8 :]
            start.best_fit(some.tolist())
            start.best_fit(rest.tolist())
        else:
            start.best_fit(list(range(len(sizes))))
        population.append(start.members)
        if len(start.members) == bound:
            return start.members
    scored = sorted(((fitness(p, sizes, capacity), n, p) for n, p in enumerate(population)), reverse=True)
    born = len(scored)
    for _ in range(generations):
        if -scored[0][0][0] == bound:
            break
        a, b = rng.choice(len(scored), 2, replace=False)
        for into, other in ((scored[a][2], scored[b][2]), (scored[b][2], scored[a][2])):
            child = crossover(into, other, sizes, capacity, rng)
            scored.append((fitness(child, sizes, capacity), born, child))
            born += 1
        scored = sorted(scored, reverse=True)[:PARENTS]
    return scored[0][2]


def _labels(packing: list[list[int]], n: int) -> np.ndarray:
    out = np.empty(n, np.int32)
    for number, members in enumerate(packing):
        out[members] = number
    return out


def _bins(labels: np.ndarray) -> list[list[int]]:
    order = np.argsort(labels, kind="stable")
    cuts = np.flatnonzero(np.diff(labels[order])) + 1
    return [part.tolist() for part in np.split(order, cuts)] if len(labels) else []


def pack_shards(items: DataFrame, capacity: int, label: str) -> DataFrame:
    """(item, size, shard) -> (item, size, shard, bin): the islands of every shard."""
    shard_type = "shard long, island int, items array<long>, sizes array<int>, bins array<int>"

    def settle(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "item"], ascending=[False, True])
        row = (key[0], pdf["item"].to_numpy(), pdf["size"].to_numpy(np.int32), np.empty(0, np.int32))
        return pd.DataFrame(
            [(row[0], island, *row[1:]) for island in range(ISLANDS)],
            columns=["shard", "island", "items", "sizes", "bins"],
        )

    def generation(number: int):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                packings = []
                for row in pdf.itertuples(index=False):
                    sizes = [int(s) for s in row.sizes]
                    guests = [_bins(np.asarray(b)) for b in (row.bins, row.guest) if b is not None and len(b)]
                    seed = int(row.shard) * 1009 * ISLANDS + number * ISLANDS + int(row.island)
                    packings.append(_labels(evolve(sizes, capacity, seed, guests), len(sizes)))
                yield pdf.assign(bins=packings).drop(columns="guest")

        return run

    # One row for each island; few bytes, but much work.
    islands = items.groupBy("shard").applyInPandas(settle, shard_type)
    for number in range(ROUNDS):
        if number:
            # The best packing of an island migrates to the next one.
            guests = islands.select(
                "shard", ((F.col("island") + 1) % ISLANDS).alias("island"), F.col("bins").alias("guest")
            )
            islands = islands.join(guests, ["shard", "island"], "left")
        else:
            islands = islands.withColumn("guest", F.lit(None).cast("array<int>"))
        islands = islands.select("shard", "island", "items", "sizes", "bins", "guest")
        islands = staged(spread(islands, "shard", "island").mapInPandas(generation(number), shard_type), f"{label}-islands")
    used = F.array_max("bins")
    best = islands.groupBy("shard").agg(F.min_by(F.struct("items", "sizes", "bins"), F.struct(used, "island")).alias("b"))
    return best.select("shard", F.inline(F.arrays_zip("b.items", "b.sizes", "b.bins"))).toDF(
        "shard", "item", "size", "bin"
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """Add (sequence_id, offset) to pieces, which are numbered and staged first, so that every row keeps its number."""
    rows = staged(pieces.withColumn("_item", F.monotonically_increasing_id()), "pack-pieces")
    short = rows.filter(F.col(length) < capacity)
    shards = max(1, -(-short.count() // SHARD))
    dealt = short.select(
        F.col("_item").alias("item"),
        F.col(length).cast("int").alias("size"),
        F.pmod(F.xxhash64("_item"), F.lit(shards)).alias("shard"),
    )
    first = staged(pack_shards(dealt, capacity, "pack-first"), "pack-first")
    fill = first.groupBy("shard", "bin").agg(F.sum("size").alias("fill"))
    poor = fill.filter(F.col("fill") < WELL_FILLED * capacity)
    loose = first.join(poor.select("shard", "bin"), ["shard", "bin"], "left_semi")
    kept = first.join(poor.select("shard", "bin"), ["shard", "bin"], "left_anti")
    loose = staged(loose, "pack-loose")
    groups = max(1, -(-loose.count() // SHARD))
    again = pack_shards(
        loose.select("item", "size", (F.lit(shards) + F.pmod(F.xxhash64("item", F.lit(1)), F.lit(groups))).alias("shard")),
        capacity,
        "pack-again",
    )
    placed = kept.select("item", "size", "shard", "bin").unionByName(again)
    # A bin holds at most `capacity` pieces, so its window is bounded.
    inside = Window.partitionBy("shard", "bin").orderBy(F.desc("size"), "item")
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.select(
        F.col("item").alias("_item"),
        (F.shiftleft(F.col("shard"), 32) + F.col("bin")).alias("sequence_id"),
        before.cast("long").alias("offset"),
    )
    whole = rows.filter(F.col(length) >= capacity).select(
        "*", (-F.col("_item") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return short.join(placed, "_item").unionByName(whole).drop("_item")
