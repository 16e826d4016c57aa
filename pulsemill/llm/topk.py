"""Exact top-k search by inner product over vectors sorted by length.

Every component becomes floor(scale * x). Vectors are cut into at most SLABS slabs of falling length by
quantiles, and each slab by hash into chunks of about CHUNK vectors; queries are packed into blocks of
about BLOCK. The chunk of the longest vectors gives every query a first threshold, its k-th best score
there. A query block then meets the chunks of those slabs only whose longest vector can still reach a
threshold (Cauchy-Schwarz). There all vectors are turned by the right singular vectors of the whole table,
so most of a product lies in the first components: a part of the product, plus the product of the residual
lengths, bounds the score. Vectors below the bound are skipped; the rest are scored in whole numbers,
longest first, which raises the thresholds of the block as it goes.

Matrices collected on the driver have as many rows as a vector has components; everything else that is
collected has at most SLABS rows or one chunk.

Vectors that are null or hold a null or non-finite component, and rows without an id, take no part. A
vector that is shorter than others counts as filled up with zeros. Rows of the same id and vector count
once; rows of the same id and other vectors are candidates of other ids only. Ties go to the smaller id. No
rows give no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemill.llm.shared import staged

SCALE = 256
SLABS = 256
CHUNK = 4096
BLOCK = 512
GROUP = 64
STEP = 1024

PACKED = "ids binary, hashes binary, ints binary, wide boolean, size int"


def whole_vectors(vectors: DataFrame, vec_id: str, embedding: str, scale: int = SCALE) -> DataFrame:
    """(id, key, v, norm) of the vectors that take part, once each."""
    sound = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ints = F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & sound).select(
        F.col(vec_id).cast("long").alias("id"), ints.alias("v")
    )
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return rows.distinct().select("id", F.xxhash64("v").alias("key"), "v", F.sqrt(squares).alias("norm"))


def _pack(pdf: pd.DataFrame, dim: int) -> dict:
    matrix = np.zeros((len(pdf), dim), np.int64)
    for row, vector in enumerate(pdf["v"]):
        matrix[row, : len(vector)] = vector
    wide = bool(len(matrix)) and int(np.abs(matrix).max(initial=0)) >= 2**31
    return {
        "ids": pdf["id"].to_numpy(np.int64).tobytes(),
        "hashes": pdf["key"].to_numpy(np.int64).tobytes(),
        "ints": matrix.astype(np.int64 if wide else np.int32).tobytes(),
        "wide": wide,
        "size": len(pdf),
    }


class Pack:
    """Vectors of one chunk or block, turned and with residual lengths."""

    def __init__(self, row, turn: np.ndarray):
        dim = len(turn)
        self.ids = np.frombuffer(row.ids, np.int64)
        self.keys = np.frombuffer(row.hashes, np.int64)
        self.ints = np.frombuffer(row.ints, np.int64 if row.wide else np.int32).reshape(row.size, dim).astype(np.int64)
        floats = self.ints.astype(np.float64)
        head = max(1, dim // 4)
        self.lengths = np.sqrt((floats**2).sum(1))
        turned = floats @ turn
        self.head = turned[:, :head]
        self.rest = np.sqrt((turned[:, head:] ** 2).sum(1))
        self.floats = floats
        self.largest = float(np.abs(floats).max(initial=0.0))


def scores_of(queries: Pack, chunk: Pack, columns: np.ndarray) -> np.ndarray:
    """Whole-number inner products of all queries with some vectors of a chunk."""
    dim = queries.ints.shape[1]
    if queries.largest * chunk.largest * dim < 2.0**53:
        return (queries.floats @ chunk.floats[columns].T).astype(np.int64)
    return queries.ints @ chunk.ints[columns].T


def search(queries: Pack, chunk: Pack, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, vector row, score) of all that may be among the k best; `floor` holds each query's
    threshold and is raised. The chunk lies in order of falling length."""
    lowest = -np.iinfo(np.int64).max
    best = np.full((len(queries.ids), k), lowest)
    found = []
    for start in range(0, len(chunk.ids), STEP):
        part = np.arange(start, min(start + STEP, len(chunk.ids)))
        product = queries.lengths[:, None] * chunk.lengths[part]
        if not (product.max(1, initial=0.0) * (1 + 1e-9) + 1 >= floor).any():
            break
        bound = queries.head @ chunk.head[part].T + queries.rest[:, None] * chunk.rest[part]
        open_ = bound + product * 1e-9 + 1 >= floor[:, None]
        open_ &= queries.ids[:, None] != chunk.ids[part]
        columns = np.flatnonzero(open_.any(0))
        if not len(columns):
            continue
        open_ = open_[:, columns]
        score = np.where(open_, scores_of(queries, chunk, part[columns]), lowest)
        best = -np.partition(-np.concatenate([best, score], 1), k - 1, axis=1)[:, :k] if k else best
        kth = best.min(1)
        floor = np.maximum(floor, np.where(kth == lowest, -np.inf, kth.astype(np.float64)))
        q, c = np.nonzero(open_ & (score >= floor[:, None]))
        found.append((q, part[columns[c]], score[q, c]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    q, c, s = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((chunk.ids[c], -s, q))
    q, c, s = q[order], c[order], s[order]
    first = np.searchsorted(q, q)
    keep = np.arange(len(q)) - first < k
    return q[keep], c[keep], s[keep]


def _gram(rows: DataFrame, dim: int) -> np.ndarray:
    """Sum of the outer products of all vectors with themselves, summed up in every task first."""

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dim, dim))
        for pdf in frames:
            matrix = np.zeros((len(pdf), dim))
            for row, vector in enumerate(pdf["v"]):
                matrix[row, : len(vector)] = vector
            total += matrix.T @ matrix
        i, j = np.triu_indices(dim)
        yield pd.DataFrame({"i": i, "j": j, "s": total[i, j]})

    cells = rows.select("v").mapInPandas(partial, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    out = np.zeros((dim, dim))
    for i, j, s in cells.collect():
        out[i, j] = out[j, i] = s
    return out


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other ids of every row of the condition `is_query`,
    which reads the column `id`."""
    rows = staged(whole_vectors(vectors, vec_id, embedding, scale), "topk-vectors")
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"), F.count(F.when(is_query, 1)).alias("asked")
    ).first()
    dim = max(1, facts["dim"] or 1)
    slabs = max(1, min(SLABS, -(-facts["n"] // CHUNK)))
    turn = np.linalg.eigh(_gram(rows, dim))[1][:, ::-1].copy()
    cuts = rows.agg(F.percentile_approx("norm", [1 - i / slabs for i in range(1, slabs)] or [0.0], 10_000)).first()[0]
    cuts = sorted(set(cuts or []), reverse=True) if slabs > 1 else []
    slab = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c > F.col("norm"))) if cuts else F.lit(0)
    slabbed = rows.withColumn("slab", slab)
    parts = {r["slab"]: r for r in slabbed.groupBy("slab").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("top")).collect()}
    counts = [-(-parts[s]["n"] // CHUNK) if s in parts else 1 for s in range(len(cuts) + 1)]
    tops = [(parts[s]["top"] if s in parts else 0.0) for s in range(len(cuts) + 1)]

    deal = F.pmod(F.xxhash64("id", "key"), F.element_at(F.array(*map(F.lit, counts)), F.col("slab") + 1))

    def chunk_of(key, pdf: pd.DataFrame) -> pd.DataFrame:
        packed = _pack(pdf.sort_values(["norm", "id"], ascending=[False, True]), dim)
        return pd.DataFrame([{"slab": key[0], "chunk": key[1], **packed}])

    chunks = slabbed.withColumn("chunk", deal).groupBy("slab", "chunk").applyInPandas(
        chunk_of, f"slab int, chunk long, {PACKED}"
    )
    chunks = staged(chunks, "topk-chunks")
    longest = chunks.filter("slab = 0").orderBy("chunk").limit(1).collect()

    blocks = max(1, -(-facts["asked"] // BLOCK))

    def block_of(key, pdf: pd.DataFrame) -> pd.DataFrame:
        queries = {"block": key[0], **_pack(pdf, dim)}
        held = Pack(SimpleNamespace(**queries), turn)
        floor = np.full(len(held.ids), -np.inf)
        if longest:
            q, _, s = search(held, Pack(longest[0], turn), floor, k)
            sizes = np.bincount(q, minlength=len(floor))
            lows = np.full(len(floor), np.inf)
            np.minimum.at(lows, q, s.astype(np.float64))
            floor = np.where(sizes >= k, lows, -np.inf)
        needed = [s for s, top in enumerate(tops) if (held.lengths * top * (1 + 1e-9) + 1 >= floor).any()]
        return pd.DataFrame([{**queries, "floors": floor.tobytes(), "slabs": needed}])

    asked = rows.filter(is_query).withColumn("block", F.pmod(F.xxhash64("id", "key", F.lit(7)), F.lit(blocks)))
    asked = asked.groupBy("block").applyInPandas(block_of, f"block long, {PACKED}, floors binary, slabs array<int>")
    # A task holds one chunk and at most about GROUP blocks.
    groups = -(-blocks // GROUP)
    asked = staged(asked.withColumn("part", F.pmod("block", F.lit(groups))), "topk-asked")
    meets = asked.withColumn("slab", F.explode("slabs")).drop("slabs")
    meets = meets.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.element_at(F.array(*[F.lit(c - 1).cast("long") for c in counts]), F.col("slab") + 1))))
    # A chunk travels only to the parts with a block that needs its slab; one row per slab says which.
    needed = asked.select(F.explode("slabs").alias("slab"), "part").groupBy("slab").agg(F.collect_set("part").alias("parts"))
    spread = chunks.join(needed, "slab").withColumn("part", F.explode("parts")).drop("parts")

    def compare(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in right.itertuples(index=False) if len(left) else []:
            chunk = Pack(next(left.itertuples(index=False)), turn)
            queries = Pack(row, turn)
            q, c, s = search(queries, chunk, np.frombuffer(row.floors, np.float64), k)
            out.append(pd.DataFrame({"query_id": queries.ids[q], "key": queries.keys[q], "vec_id": chunk.ids[c], "score": s}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "key", "vec_id", "score")})

    on = ["slab", "chunk", "part"]
    near = spread.groupBy(*on).cogroup(meets.groupBy(*on)).applyInPandas(
        compare, "query_id long, key long, vec_id long, score long"
    )
    best = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
