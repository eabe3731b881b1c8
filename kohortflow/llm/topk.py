"""Exact top-k by inner product: columnar branch and bound.

Candidates are dealt to blocks of bounded size; every block meets all queries, which stream past it in batches. A
block is held as vertical slices of eight dimensions. For a query the partial scores grow slice by slice; what the
remaining dimensions can add is at most the product of the two vectors' remaining norms, so candidates whose upper
bound is below the k-th best lower bound leave, and the survivors are compacted. The best k of each block are merged
by a window whose groups have k rows per block.

Components become floor(1024 * x). Scores are exact: doubles while they fit 53 bits, else 64-bit integers.

Defined results: vectors that are null or empty, or hold a null or non-finite component, and rows with a null id take no
part. A vector shorter than another counts 0 for what it lacks. Rows that repeat an id are candidates each; as a
query the smallest vector of an id counts, and no row of its id is its candidate. Ties go to the smaller id. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kohortflow.llm.common import small_batches

SLICE = 8
LEAST_BLOCK, MOST_BLOCK = 4096, 1 << 18  # candidates of a block
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def integers(embedding: str = "embedding") -> str:
    """SQL of the integer vector, null where the vector takes no part."""
    fine = f"size({embedding}) > 0 AND forall({embedding}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    return f"CASE WHEN {fine} THEN transform({embedding}, x -> floor(1024D * double(x))) END"


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), max(width, int(sizes.max(initial=0)))), np.int64)
    rows = np.repeat(np.arange(len(column)), sizes)
    places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, places] = column.flatten().to_numpy(zero_copy_only=False)
    return out


class Block:
    """Candidates in vertical slices, with the norm of what follows each slice."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids = ids
        self.vectors = vectors
        self.most = int(np.abs(vectors).max(initial=0))
        self.slices = [np.ascontiguousarray(vectors[:, i : i + SLICE]) for i in range(0, vectors.shape[1], SLICE)]
        squares = np.stack([(s.astype(float) ** 2).sum(axis=1) for s in self.slices])
        self.rest = np.sqrt(np.concatenate([np.cumsum(squares[::-1], axis=0)[::-1][1:], np.zeros((1, len(ids)))]))
        self.floats = [s.astype(float) for s in self.slices]

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        width = len(self.slices) * SLICE
        q = np.zeros(max(width, len(query)), np.int64)
        q[: len(query)] = query
        exact = self.most * int(np.abs(q).max(initial=0)) * width < 1 << 53
        slices = self.floats if exact else self.slices
        parts = [q[i : i + SLICE][: s.shape[1]] for i, s in zip(range(0, width, SLICE), slices, strict=True)]
        norms = np.sqrt(np.cumsum([(p.astype(float) ** 2).sum() for p in parts][::-1])[::-1])
        alive = np.flatnonzero(self.ids != query_id)
        score = np.zeros(len(alive), float if exact else np.int64)
        for i, (part, s) in enumerate(zip(parts, slices, strict=True)):
            score = score + s[alive] @ part.astype(s.dtype)
            if len(alive) > k and i + 1 < len(parts):
                most = self.rest[i, alive] * norms[i + 1] * (1 + 1e-9) + 1e-3
                least = np.partition(score - most, len(alive) - k)[len(alive) - k]
                keep = score + most >= least
                if keep.mean() < 0.9:
                    alive, score = alive[keep], score[keep]
        score = score.astype(np.int64)
        order = np.lexsort((self.ids[alive], -score))[:k]
        return self.ids[alive[order]], score[order]


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows (block, asks, vec_id, vector), sorted by block with candidates first."""
    now, ids, vectors, block = None, [], [], None
    for batch in batches:
        blocks, asks, own = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        edges = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(asks) != 0)) + 1
        for a, b in zip([0, *edges], [*edges, len(blocks)], strict=True):
            if a == b:
                continue
            part = _matrix(batch.column(3).slice(a, b - a), 0)
            if blocks[a] != now:
                now, ids, vectors, block = blocks[a], [], [], None
            if not asks[a]:
                ids.append(own[a:b])
                vectors.append(part)
                continue
            if not ids:
                continue
            if block is None:
                width = -(-max(v.shape[1] for v in vectors) // SLICE) * SLICE
                block = Block(np.concatenate(ids), np.concatenate([np.pad(v, ((0, 0), (0, width - v.shape[1]))) for v in vectors]))
                vectors = []
            out: list[list[np.ndarray]] = [[], [], []]
            for query_id, query in zip(own[a:b], part, strict=True):
                found, scores = block.best(query_id, query, k)
                for column, value in zip(out, (np.full(len(found), query_id), found, scores), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out], schema=FOUND)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest of ``vectors`` (vec_id, embedding) for each of ``queries``."""
    small_batches(vectors.sparkSession)
    valid = "vec_id IS NOT NULL AND vector IS NOT NULL"
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.expr(integers()).alias("vector")).where(valid)
    asked = queries.select(F.col("vec_id").cast("long").alias("vec_id"), F.expr(integers()).alias("vector")).where(valid)
    asked = asked.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n = vectors.count()
    blocks = max(1, -(-n // min(MOST_BLOCK, max(LEAST_BLOCK, n // 64))))
    held = whole.select(F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks)).alias("block"), F.lit(False).alias("asks"), "vec_id", "vector")
    passing = asked.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), F.lit(True).alias("asks"), "vec_id", "vector")
    rows = held.union(passing).repartition(blocks, "block").sortWithinPartitions("block", "asks")
    found = rows.mapInArrow(lambda b: _search(b, k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
