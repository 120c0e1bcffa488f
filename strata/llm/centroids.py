"""Centroid clustering of integer vectors by scalar lookup tables.

Every component is an integer, so in a block of vectors a dimension takes few values.  Vectors are
written once as blocks: per dimension the values that occur in the block, and for every vector the
position of its value among them.  A round tabulates, per dimension, the squared difference of
each occurring value and each centroid; all distances of the block are then gathers from those
small tables, added up.  The sums of a cluster come from the same tables: how often each value
fell to a cluster, times the value.  All is exact in integers.

A round is one map over the blocks; of each task, a row per centroid leaves, so what the driver
receives is one row per centroid, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written

DIMENSIONS = 64
SCALE = 1024
#: Vectors of a block; a position among a block's values fits two bytes.
BLOCK = 4096
#: Below it, sums of 64 squared differences fit 64 bits.
LARGEST = 1 << 27

Centroids = list[list[int]]


def blocks(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``ids, sizes, occurring, codes``: blocks of integer vectors.

    Without ``codes``: ids whose integers are too large for exact distances in 64 bits.
    """
    kind = dict(vectors.dtypes)[id_col]
    names = ["ids", "sizes", "occurring", "codes"]

    def block(ids: pa.Array, values: np.ndarray | None) -> pa.RecordBatch:
        sizes, occurring, codes = [], b"", None
        if values is not None:
            found = [np.unique(column, return_inverse=True) for column in values.T]
            sizes = [len(v) for v, _ in found]
            occurring = np.concatenate([v for v, _ in found]).tobytes()
            codes = np.concatenate([c.astype(np.uint16).ravel() for _, c in found]).tobytes()
        offsets = pa.array([0, len(ids)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(offsets, ids),
                pa.array([sizes], pa.list_(pa.int32())),
                pa.array([occurring], pa.binary()),
                pa.array([codes], pa.binary()),
            ],
            names=names,
        )

    def cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting_ids, waiting, held = [], [], 0
        for frame in frames:
            ids, column = frame.column(0), frame.column(1)
            full = pc.fill_null(pc.equal(pc.list_value_length(column), DIMENSIONS), False)
            ids, column = ids.filter(full), column.filter(full)
            flat = pc.cast(pc.list_flatten(column), pa.float64())
            x = flat.to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
            with np.errstate(over="ignore", invalid="ignore"):
                finite = np.isfinite(x).all(axis=1)
                scaled = np.floor(SCALE * x)
                small = finite & (np.abs(scaled) < LARGEST).all(axis=1)
            if (finite & ~small).any():
                yield block(ids.filter(pa.array(finite & ~small)), None)
            kept = ids.filter(pa.array(small))
            values = scaled[small].astype(np.int64)
            while len(values):
                room = BLOCK - held
                waiting_ids.append(kept.slice(0, room))
                waiting.append(values[:room])
                held += len(waiting[-1])
                kept, values = kept.slice(room), values[room:]
                if held == BLOCK:
                    yield block(pa.concat_arrays(waiting_ids), np.concatenate(waiting))
                    waiting_ids, waiting, held = [], [], 0
        if held:
            yield block(pa.concat_arrays(waiting_ids), np.concatenate(waiting))

    picked = vectors.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{vector_col}`").alias("v"))
    return picked.mapInArrow(
        cut, f"ids array<{kind}>, sizes array<int>, occurring binary, codes binary"
    )


def unpacked(sizes: Sequence[int], occurring: bytes, codes: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """Per dimension the occurring values, and the codes as dimensions by vectors."""
    values = np.split(np.frombuffer(occurring, np.int64), np.cumsum(sizes)[:-1])
    return values, np.frombuffer(codes, np.uint16).reshape(len(values), -1)


def nearest(values: list[np.ndarray], codes: np.ndarray, centroids: Centroids) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid; ties to the smaller."""
    centres = np.array(centroids, np.int64)
    total = np.zeros((codes.shape[1], len(centres)), np.int64)
    for dimension, (occurring, code) in enumerate(zip(values, codes, strict=True)):
        table = (occurring[:, None] - centres[None, :, dimension]) ** 2
        total += table[code]
    best = total.argmin(axis=1)
    return best, np.take_along_axis(total, best[:, None], 1)[:, 0]


def _first_vectors(table: DataFrame, k: int, seed: int) -> Centroids:
    """The k vectors whose ids have the smallest hashes; of equal ids, the smaller vector."""

    def candidates(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[str, list[int]]] = []
        for frame in frames:
            for ids, sizes, occurring, codes in zip(*(frame.column(c).to_pylist() for c in range(4)), strict=True):
                if codes is None:
                    continue
                values, code = unpacked(sizes, occurring, codes)
                texts = (f"{seed}:{'' if i is None else i}" for i in ids)
                hashes = np.array([hashlib.sha256(t.encode()).hexdigest() for t in texts])
                limit = np.partition(hashes, k - 1)[k - 1] if len(hashes) > k else max(hashes)
                limit = min(limit, best[-1][0]) if len(best) == k else limit
                found = [
                    (str(hashes[r]), [int(v[c]) for v, c in zip(values, code[:, r], strict=True)])
                    for r in np.flatnonzero(hashes <= limit)
                ]
                best = sorted(best + found)[:k]
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, _ in best], pa.string()), pa.array([v for _, v in best], pa.list_(pa.int64()))],
            names=["hash", "vector"],
        )

    found = table.mapInArrow(candidates, "hash string, vector array<long>")
    return [list(r.vector) for r in found.orderBy("hash", "vector").limit(k).collect()]


def _tallied(table: DataFrame, centroids: Centroids) -> dict[int, tuple[int, int, list[int]]]:
    """Per non-empty cluster: vectors, summed distance and component sums."""
    k = len(centroids)

    def tally(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, inertia = [0] * k, [0] * k
        sums = [[0] * DIMENSIONS for _ in range(k)]
        for frame in frames:
            for sizes, occurring, codes in zip(*(frame.column(c).to_pylist() for c in range(3)), strict=True):
                if codes is None:
                    continue
                values, code = unpacked(sizes, occurring, codes)
                best, distance = nearest(values, code, centroids)
                for c in np.flatnonzero(np.bincount(best, minlength=k)):
                    mine = distance[best == c]
                    counts[c] += len(mine)
                    # In halves of 31 bits, so that no sum of a block overflows.
                    inertia[c] += (int((mine >> 31).sum()) << 31) + int((mine & 0x7FFFFFFF).sum())
                for d, (v, column) in enumerate(zip(values, code, strict=True)):
                    fell = np.bincount(column * np.int64(k) + best, minlength=len(v) * k)
                    for c, s in enumerate(v @ fell.reshape(len(v), k)):
                        sums[c][d] += int(s)
        some = [c for c in range(k) if counts[c]]
        large = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some, pa.int32()),
                pa.array([counts[c] for c in some], large),
                pa.array([inertia[c] for c in some], large),
                pa.array([sums[c] for c in some], pa.list_(large)),
            ],
            names=["cluster", "n", "inertia", "sums"],
        )

    schema = "cluster int, n decimal(38,0), inertia decimal(38,0), sums array<decimal(38,0)>"
    rows = table.select("sizes", "occurring", "codes").mapInArrow(tally, schema)
    added = [F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(DIMENSIONS)]
    found = rows.groupBy("cluster").agg(F.sum("n").alias("n"), F.sum("inertia").alias("inertia"), *added)
    return {
        r.cluster: (int(r.n), int(r.inertia), [int(r[f"s{d}"]) for d in range(DIMENSIONS)])
        for r in found.collect()
    }


def cluster(
    vectors: DataFrame, *, k: int = 8, rounds: int = 10, seed: int = 3,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of each vector kept.

    Kept are vectors of exactly 64 components, none NULL or non-finite.  NULL and repeated ids
    are kept row by row; a NULL id hashes as an empty one.  With fewer than ``k`` vectors there
    are as many centroids; an empty table, or one without such a vector, gives an empty result.
    A finite vector with a component of 2^17 or more has no distance that surely fits a long: its
    row has NULL in all columns but the id, and it moves no centroid.  An inertia beyond a long is
    NULL.  Other columns are not read.
    """
    kind = dict(vectors.dtypes)[id_col]
    table = written(blocks(vectors, id_col, vector_col), "centroids")
    centroids = _first_vectors(table, k, seed)
    for _ in range(rounds if centroids else 0):
        tallies = _tallied(table, centroids)
        moved = [
            [s // tallies[c][0] for s in tallies[c][2]] if c in tallies else old
            for c, old in enumerate(centroids)
        ]
        if moved == centroids:
            break  # the rounds left would change nothing
        centroids = moved
    tallies = _tallied(table, centroids) if centroids else {}
    fits = lambda n: n if n < 1 << 63 else None
    inertia = [fits(tallies[c][1]) if c in tallies else 0 for c in range(len(centroids))]
    whole = fits(sum(t[1] for t in tallies.values()))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    names = ["i", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]

    def assign(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for row in range(frame.num_rows):
                ids = frame.column(0).slice(row, 1).flatten()
                codes = frame.column(3)[row].as_py()
                if codes is None:
                    empty = [pa.nulls(len(ids), t) for t in (pa.int32(), *[pa.int64()] * 3, pa.string())]
                    yield pa.RecordBatch.from_arrays([ids, *empty], names=names)
                    continue
                sizes, occurring = frame.column(1)[row].as_py(), frame.column(2)[row].as_py()
                best, distance = nearest(*unpacked(sizes, occurring, codes), centroids)
                at = pa.array(best, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        ids, at, pa.array(distance, pa.int64()),
                        pa.array(inertia, pa.int64()).take(at), pa.array([whole] * len(ids), pa.int64()),
                        pa.array(digests, pa.string()).take(at),
                    ],
                    names=names,
                )

    schema = f"i {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    return table.mapInArrow(assign, schema).withColumnRenamed("i", id_col)


def duckdb_twin(table: str, k: int = 8, rounds: int = 10, seed: int = 3) -> str:
    """The same rows by DuckDB: the rounds written one after the other."""
    parts = [
        f"""v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS r,
  list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM {table}
  WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIMENSIONS})""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, e) - 1 AS k, e
  FROM (SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, e FROM v ORDER BY h, e LIMIT {k}))""",
    ]
    far = f"CAST(list_sum(list_transform(range(1, {DIMENSIONS + 1}), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))) AS BIGINT)"
    for n in range(rounds + 1):
        parts.append(
            f"""a{n} AS MATERIALIZED (SELECT r, min(struct_pack(d := {far}, k := c.k)) AS best
  FROM v CROSS JOIN c{n} AS c GROUP BY r)"""
        )
        if n < rounds:
            parts.append(
                f"""c{n + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.e, c.e) AS e FROM c{n} AS c LEFT JOIN (
  SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM (
    SELECT a.best.k AS k, i, sum(v.e[i]) AS s, count(*) AS n
    FROM v JOIN a{n} AS a USING (r) CROSS JOIN range(1, {DIMENSIONS + 1}) AS g(i) GROUP BY a.best.k, i)
  GROUP BY k) AS m ON m.k = c.k)"""
            )
    return f"""WITH {", ".join(parts)}
SELECT v.vec_id, CAST(a.best.k AS INTEGER) AS cluster, a.best.d AS distance,
  CAST(sum(a.best.d) OVER (PARTITION BY a.best.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM v JOIN a{rounds} AS a USING (r) JOIN c{rounds} AS c ON c.k = a.best.k"""
