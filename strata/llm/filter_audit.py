"""Filter interaction audit by wide packed counters.

Five filters fail or pass a document, which makes a mask of five bits.  What happens to a mask is
known for every order of the filters and every step: kept, removed, redundant, and so on.  All of
that, 600 steps with several outcomes each, is written into one big integer, a field per outcome;
documents are counted by adding the integers of their masks.  Fields are 64 bits wide, so no
count of rows can run into the next field.  Every task adds up the integers of its own rows per
part; the sums are added again in two levels and unpacked once per part.

Texts are read once.  Equality with an earlier document needs the only shuffle of narrow rows: the
earliest id of each digest.  Digests with many copies are looked up from a small table instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = [(order, step) for order in ORDERS for step in range(len(FILTERS))]
#: Outcomes with a field for each of the 600 steps.
OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD = 8  # bytes
#: The limits of the filters.
FEWEST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SIGNS = 200, 50, 2, b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A digest held by more than this share of the documents is one of a broadcast table, which
#: therefore has fewer rows than its inverse.
HOT_SHARE = 1 / 2000
#: Parts a task adds up at once, and tasks that share a part before its last addition.
PARTS_AT_ONCE, SALTS = 512, 64


def outcome_fields(mask: int, good: bool, toxic: bool) -> np.ndarray:
    """Zeros and ones, steps by outcomes, of a document with this mask and these labels."""
    fields = np.zeros((len(STEPS), len(OUTCOMES)), np.uint64)
    for row, (order, step) in enumerate(STEPS):
        fails = [bool(mask >> FILTERS.index(f) & 1) for f in order[: step + 1]]
        removed = fails[-1] and not any(fails[:-1])
        fields[row] = (
            not any(fails), removed, fails[-1] and not removed,
            mask == 1 << FILTERS.index(order[step]), removed and good, removed and toxic,
        )
    return fields


def packed_counters() -> list[int]:
    """The big integer of every (mask, good, toxic), by ``mask + 32 * good + 64 * toxic``."""
    masks = 1 << len(FILTERS)
    return [
        int.from_bytes(outcome_fields(i % masks, bool(i & masks), bool(i & 2 * masks)).tobytes(), "little")
        for i in range(4 * masks)
    ]


def unpack(total: int) -> np.ndarray:
    """Counts of a sum of packed counters, steps by outcomes."""
    data = total.to_bytes(len(STEPS) * len(OUTCOMES) * FIELD, "little")
    return np.frombuffer(data, "<u8").reshape(len(STEPS), len(OUTCOMES)).astype(np.int64)


def text_mask(text: bytes, n_chars: int) -> int:
    """Failures of the filters that look at the text alone, A to D."""
    words = text.split()  # on what ASCII calls white space
    fails = (
        len(words) < FEWEST_WORDS,
        100 * len(set(words)) < DISTINCT_PERCENT * len(words),
        100 * (len(text) - len(text.translate(None, CAPITALS))) > CAPITAL_PERCENT * n_chars,
        len(text.translate(None, SIGNS)) < len(text),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def text_failures(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``id, part, mask, digest`` of each document, in one pass over the texts."""
    kind = dict(docs.dtypes)[id_col]

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            texts = pc.cast(pc.fill_null(frame.column(2), ""), pa.string())
            lengths = pc.utf8_length(texts).to_pylist()
            masks, digests = [], []
            for text, n in zip(pc.cast(texts, pa.binary()), lengths, strict=True):
                data = text.as_py()
                masks.append(text_mask(data, n))
                digests.append(hashlib.sha256(data).digest())
            yield pa.RecordBatch.from_arrays(
                [frame.column(0), frame.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                names=["id", "part", "mask", "digest"],
            )

    col = lambda name: F.col(f"`{name}`")
    rows = docs.select(
        col(id_col).alias("id"),
        F.coalesce(col(part_col).cast("string"), F.lit("")).alias("part"),
        col(text_col).alias("text"),
    )
    return rows.mapInArrow(read, f"id {kind}, part string, mask int, digest binary")


def with_earliest(rows: DataFrame) -> DataFrame:
    """Adds ``first``: the smallest id that holds the same digest, NULL where the row is the only one.

    No digest that is joined by shuffle has more than ``HOT_SHARE`` of the rows.
    """
    held = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    held = written(held.where("n > 1"), "audit-copies")
    limit = max(rows.count() * HOT_SHARE, 1)
    hot = held.where(F.col("n") > limit).select("digest", F.col("first").alias("hot_first"))
    cold = held.where(F.col("n") <= limit).select("digest", F.col("first").alias("cold_first"))
    marked = rows.join(F.broadcast(hot), "digest", "left")
    # Rows answered by the small table take no key with them into the second join.
    alone = F.when(F.col("hot_first").isNull(), F.col("digest"))
    spread = F.coalesce(alone, F.xxhash64("id", "part").cast("string").cast("binary"))
    found = marked.withColumn("key", spread).join(cold.withColumnRenamed("digest", "key"), "key", "left")
    return found.select("id", "part", "mask", F.coalesce("hot_first", "cold_first").alias("first"))


def labelled(rows: DataFrame, labels: DataFrame, id_col: str, good: Column, toxic: Column) -> DataFrame:
    """Adds ``good`` and ``toxic``: whether any label row of the id says so."""
    known = labels.select(F.col(f"`{id_col}`").alias("id"), good.alias("g"), toxic.alias("t"))
    known = known.where("id IS NOT NULL").groupBy("id").agg(
        F.max(F.coalesce("g", F.lit(False))).alias("good"), F.max(F.coalesce("t", F.lit(False))).alias("toxic")
    )
    return rows.join(known.where("good OR toxic"), "id", "left").select(
        *rows.columns, F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )


def _added(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int]]:
    """Sums of neighbouring rows of one part."""
    part, total = None, 0
    for frame in frames:
        for name, packed in zip(frame.column(0).to_pylist(), frame.column(1), strict=True):
            if part is not None and name != part:
                yield part, total
                total = 0
            part, total = name, total + int.from_bytes(packed.as_py(), "little")
    if part is not None:
        yield part, total


def _as_batch(sums: list[tuple[str, int]], salt: int) -> pa.RecordBatch:
    data = [t.to_bytes((t.bit_length() + 7) // 8, "little") for _, t in sums]
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in sums], pa.string()), pa.array(data, pa.binary()), pa.array([salt] * len(sums), pa.int32())],
        names=["part", "packed", "salt"],
    )


def audit(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "source", quality_col: str = "quality", toxic_col: str = "toxic",
) -> DataFrame:
    """One row per part, order of the filters and step, zeros included.

    Columns: ``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley``.  NULL texts count as empty ones, a NULL source is the part ``''``.  A row
    with a NULL id has no labels, and is neither earlier than another row nor repeats one; rows of
    one id are not earlier than each other.  A document has a label if any of its label rows says
    so.  An empty table gives an empty result.  Other columns are not read.
    """
    rows = written(text_failures(docs, id_col, text_col, part_col), "audit-texts")
    rows = labelled(with_earliest(rows), labels, id_col, F.col(f"`{quality_col}`") == 1, F.col(f"`{toxic_col}`") == 1)
    repeats = F.coalesce(F.col("first") < F.col("id"), F.lit(False))
    outcome = F.col("mask") + 16 * repeats.cast("int") + 32 * F.col("good").cast("int") + 64 * F.col("toxic").cast("int")
    schema = "part string, packed binary, salt int"

    def add_rows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % SALTS
        counters, sums = packed_counters(), {}
        for frame in frames:
            names = frame.column(0).dictionary_encode()
            known, cells = names.dictionary.to_pylist(), len(counters)
            at = names.indices.to_numpy().astype(np.int64) * cells + frame.column(1).to_numpy()
            for cell, n in zip(*np.unique(at, return_counts=True), strict=True):
                part = known[cell // cells]
                sums[part] = sums.get(part, 0) + int(n) * counters[cell % cells]
                if len(sums) > PARTS_AT_ONCE:
                    yield _as_batch([*sums.items()], salt)
                    sums = {}
        if sums:
            yield _as_batch([*sums.items()], salt)

    def add_sums(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in _added(frames):
            yield _as_batch([one], 0)

    def report(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = np.array([FILTERS.index(order[step]) for order, step in STEPS])
        for part, total in _added(frames):
            counts = unpack(total)
            shares = np.array([counts[letters == f, OUTCOMES.index("removed")].sum() for f in range(len(FILTERS))])
            columns = [pa.array(counts[:, i], pa.int64()) for i in range(len(OUTCOMES))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(STEPS), pa.string()),
                    pa.array([order for order, _ in STEPS], pa.string()),
                    pa.array([step + 1 for _, step in STEPS], pa.int32()),
                    *columns, pa.array(shares[letters], pa.int64()),
                ],
                names=["part", "filter_order", "step", *OUTCOMES, "shapley"],
            )

    by_task = rows.select("part", outcome.alias("outcome")).mapInArrow(add_rows, schema)
    by_salt = by_task.repartition("part", "salt").sortWithinPartitions("part").select("part", "packed")
    by_salt = by_salt.mapInArrow(add_sums, schema)
    whole = by_salt.repartition("part").sortWithinPartitions("part").select("part", "packed")
    counts = ", ".join(f"{name} long" for name in OUTCOMES)
    return whole.mapInArrow(report, f"part string, filter_order string, step int, {counts}, shapley long")


def duckdb_twin(docs: str, labels: str) -> str:
    """The same rows by DuckDB."""
    word = r"[^\x20\x09-\x0D]+"
    steps = ", ".join(f"('{order}', {step + 1}, '{order[:step]}', '{order[step]}')" for order, step in STEPS)
    fails = {
        "A": f"len(w) < {FEWEST_WORDS}",
        "B": f"100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w)",
        "C": f"100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {CAPITAL_PERCENT} * length(t)",
        "D": "regexp_matches(t, '[#$%&*|]')",
        "E": "coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)",
    }
    failed = " || ".join(f"CASE WHEN {sql} THEN '{f}' ELSE '' END" for f, sql in fails.items())
    return f"""WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '{word}') AS w FROM {docs}
), l AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM {labels} GROUP BY doc_id
), f AS (
  SELECT d.doc_id, part, {failed} AS failed FROM d
), g AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS x
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, failed
), s(filter_order, step, before, letter) AS (VALUES {steps}
), o AS (
  SELECT part, filter_order, step, letter, n, g, x, failed,
    translate(failed, before, '') = failed AS reached, contains(failed, letter) AS fails FROM g CROSS JOIN s
), c AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (WHERE reached AND NOT fails), 0) AS kept,
    coalesce(sum(n) FILTER (WHERE reached AND fails), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE NOT reached AND fails), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE failed = letter), 0) AS unique_fails,
    coalesce(sum(g) FILTER (WHERE reached AND fails), 0) AS good_lost,
    coalesce(sum(x) FILTER (WHERE reached AND fails), 0) AS toxic_lost
  FROM o GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM c"""
