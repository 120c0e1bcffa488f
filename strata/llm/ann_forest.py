"""Approximate nearest neighbours by a hash-prefix forest.

Each tree is a sorted array of long hash strings (signs of random projections, 64 to a string).
A query descends to its longest prefix match in every tree; then all trees ascend together, one
level at a time, until the rows that share that long a prefix with the query in some tree
are numerous enough.  Those candidates are ranked by exact cosine.

Rows are dealt by a hash of their id into shards of bounded size, each with a forest of its own;
blocks of queries meet every shard, and the shards' best are merged.  Any executor's loss costs
one shard and block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a shard and queries of a block, on average.
SHARD_ROWS, BLOCK_QUERIES = 12_288, 2_048


class Forest:
    """Hash-prefix trees over the rows of one shard."""

    def __init__(self, vectors: np.ndarray, trees: int, seed: int):
        rng = np.random.default_rng(seed)
        self.planes = rng.standard_normal((trees, vectors.shape[1], 64))
        self.trees = []
        for plane in self.planes:
            keys = self.strings(vectors, plane)
            order = np.argsort(keys, kind="stable")
            self.trees.append((keys[order], order))

    @staticmethod
    def strings(vectors: np.ndarray, plane: np.ndarray) -> np.ndarray:
        bits = np.packbits(vectors @ plane > 0, axis=1)
        return bits.view(">u8").ravel().astype(np.uint64)

    def candidates(self, queries: np.ndarray, wanted: int, size: int) -> Iterator[np.ndarray]:
        """For each query a mask of the rows found."""
        keys = [self.strings(queries, plane) for plane in self.planes]
        level = np.full(len(queries), -1)
        spans = {}
        for depth in range(64, -1, -1):  # the synchronous ascent
            open_ = level < 0
            if not open_.any():
                break
            found, span = np.zeros(len(queries), np.int64), []
            for (ordered, _), key in zip(self.trees, keys, strict=True):
                shift = np.uint64(64 - depth)
                low = (key >> shift) << shift if depth else np.zeros_like(key)
                rest = (np.uint64(1) << shift) - np.uint64(1) if depth else ~np.uint64(0)
                a = np.searchsorted(ordered, low, "left")
                b = np.searchsorted(ordered, low | rest, "right")
                span.append((a, b))
                found += b - a
            spans[depth] = span
            level[open_ & (found >= wanted)] = depth
        level[level < 0] = 0
        for q in range(len(queries)):
            mask = np.zeros(size, bool)
            for (_, order), (a, b) in zip(self.trees, spans[level[q]], strict=True):
                mask[order[a[q] : b[q]]] = True
            yield mask


def _nearest(rows, queries, k: int, trees: int, share: float, seed: int):
    """The k best of one shard for each query of a block, as (query, row, score)."""
    ids, vectors = rows
    query_ids, query_vectors = queries
    # Of equal vectors only the k + 1 smallest ids can be among anyone's k nearest.
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    distinct, which = np.unique(vectors, axis=0, return_inverse=True)
    by = np.argsort(which.ravel(), kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(which.ravel(), minlength=len(distinct)))])
    norms = np.sqrt((distinct * distinct).sum(axis=1))
    unit = distinct / norms[:, None]
    forest = Forest(unit, trees, seed)
    wanted = max(50 * k, int(np.ceil(share * trees * len(distinct))))
    own = np.sqrt((query_vectors * query_vectors).sum(axis=1))
    for q, mask in enumerate(forest.candidates(query_vectors / own[:, None], wanted, len(unit))):
        found = np.flatnonzero(mask)
        rough = unit[found] @ (query_vectors[q] / own[q])
        if len(found) > k + 1:
            # Rows this near to the last that counts are all scored again, one by one alike.
            edge = np.partition(rough, len(rough) - k - 1)[len(rough) - k - 1]
            found = found[rough >= edge - 1e-9]
        score = (distinct[found] * query_vectors[q]).sum(axis=1) / (norms[found] * own[q])
        best: list[tuple[float, int]] = []
        for i in np.argsort(-score, kind="stable"):
            if len(best) >= k and score[i] < best[k - 1][0]:
                break
            members = ids[by[starts[found[i]] : min(starts[found[i] + 1], starts[found[i]] + k + 1)]]
            best += [(float(score[i]), int(m)) for m in members if m != query_ids[q]]
            best.sort(key=lambda x: (-x[0], x[1]))
        for s, m in best[:k]:
            yield int(query_ids[q]), m, s


def search(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    trees: int = 24,
    share: float = 0.035,
    seed: int = 11,
) -> DataFrame:
    """The k nearest found for each query: ``query_id, rank, <id>, score`` (exact cosine).

    The trees ascend until they hold, counted tree by tree, at least ``share`` of the shard's
    rows each on average (and 50 k in all).  Vectors of each length are searched among their
    own.  Vectors that are NULL, zero, or hold NULL or non-finite components take no part, nor do
    rows without an id, nor those whose squared length leaves the range of a double.  A row is never its own neighbour; rows
    that repeat an id count once (the smallest vector); equal scores go to the smaller id; an
    empty table gives an empty result, and fewer than k candidates give fewer rows.
    """
    norm = F.aggregate(
        F.col("vector"), F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    finite = (norm > 0) & (norm < F.lit(float("inf"))) & ~F.isnan(norm)

    def usable(df: DataFrame) -> DataFrame:
        kept = df.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
        )
        kept = kept.where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))
        return kept.groupBy("id").agg(F.min("vector").alias("vector"))

    rows, asked = usable(vectors), usable(queries)
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = rows.withColumn("shard", shard).withColumn("block", every(blocks)).withColumn("length", F.size("vector"))
    asked = asked.withColumn("block", block).withColumn("shard", every(shards)).withColumn("length", F.size("vector"))

    def unpacked(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        lists = t.column("vector").combine_chunks()
        return t.column("id").to_numpy(), lists.flatten().to_numpy().reshape(t.num_rows, -1)

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            out = list(_nearest(unpacked(left), unpacked(right), k, trees, share, seed))
        return pa.table(
            {
                "query_id": pa.array([x[0] for x in out], pa.int64()),
                "id": pa.array([x[1] for x in out], pa.int64()),
                "score": pa.array([x[2] for x in out], pa.float64()),
            }
        )

    found = (
        rows.groupBy("shard", "block", "length")
        .cogroup(asked.groupBy("shard", "block", "length"))
        .applyInArrow(pair, "query_id long, id long, score double")
    )
    rank = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    )
    return (
        found.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )
