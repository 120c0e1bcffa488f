"""Line dedup by pairwise alignment.

Two documents can share a block only if they share one of its windows, the fewest neighbouring
lines of enough words from or up to a line; windows and whole documents are hashed.  A
document's shared windows name its partners: for each of them the first document that holds it.
Each pair is aligned by patience diff on the line hashes, whose anchors are the lines that each of
the two holds once, and blocks of aligned neighbouring lines that are long enough are deleted from
the later document.  Where a window's lines are left, because the first holder repeats or moves
them, the next holders become partners, four times as many in each round, until the lines are
deleted or every earlier holder was tried: the result is that of aligning all pairs.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, written

#: Base of the windows' hashes.
ODD = 0x9E3779B97F4A7C15


def patience(a: list[int], b: list[int], low_a=0, high_a=None, low_b=0, high_b=None) -> list[tuple[int, int]]:
    """Aligned positions of two sequences: common ends, then lines unique in both, recursively."""
    found: list[tuple[int, int]] = []
    spans = [(low_a, len(a) if high_a is None else high_a, low_b, len(b) if high_b is None else high_b)]
    while spans:
        i, m, j, n = spans.pop()
        while i < m and j < n and a[i] == b[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            found.append((m, n))
        if i >= m or j >= n:
            continue
        once_a, once_b = _unique(a, i, m), _unique(b, j, n)
        anchors = _increasing([(once_a[h], once_b[h]) for h in once_a if h in once_b])
        if not anchors:
            continue
        edge_a, edge_b = i, j
        for x, y in anchors:
            spans.append((edge_a, x, edge_b, y))
            found.append((x, y))
            edge_a, edge_b = x + 1, y + 1
        spans.append((edge_a, m, edge_b, n))
    return sorted(found)


def _unique(lines: list[int], low: int, high: int) -> dict[int, int]:
    place: dict[int, int] = {}
    for k in range(low, high):
        place[lines[k]] = -1 if lines[k] in place else k
    return {h: k for h, k in place.items() if k >= 0}


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs that increases in both."""
    pairs.sort()
    ends, tops, back = [], [], [-1] * len(pairs)
    for k, (_, y) in enumerate(pairs):
        at = bisect_left(tops, y)
        back[k] = ends[at - 1] if at else -1
        if at == len(tops):
            tops.append(y)
            ends.append(k)
        else:
            tops[at], ends[at] = y, k
    chain, k = [], ends[-1] if ends else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def common_blocks(own: list[int], other: list[int], words: list[int], least: int) -> list[int]:
    """Lines of ``own`` in aligned blocks of at least ``least`` words."""
    deleted, block, size, before = [], [], 0, (-2, -2)
    for x, y in [*patience(own, other), (-9, -9)]:
        if (x, y) != (before[0] + 1, before[1] + 1):
            if size >= least:
                deleted += block
            block, size = [], 0
        if x >= 0:
            block.append(x)
            size += words[x]
        before = (x, y)
    return deleted


def windows_of(hashes: np.ndarray, words: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(document, low, high, hash, document's hash) of the windows of documents behind one another."""
    total = len(hashes)
    begins = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    power, back = np.full((2, total + 1), 1, np.uint64)
    power[1:], back[1:] = ODD, pow(ODD, -1, 1 << 64)
    power, back = np.cumprod(power), np.cumprod(back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes.astype(np.uint64) * power[:-1], dtype=np.uint64)])
    value = lambda low, high: (sums[high] - sums[low]) * back[low]
    seen = np.concatenate([[0], np.cumsum(words)])
    line = np.arange(total)
    onward = np.searchsorted(seen, seen[:-1] + least)
    upward = np.searchsorted(seen, seen[1:] - least, "right") - 1
    ahead = onward <= (begins + sizes)[doc]
    behind = upward >= begins[doc]
    enough = np.flatnonzero((seen[begins + sizes] - seen[begins] >= least) & (sizes > 0))
    low = np.concatenate([line[ahead], upward[behind], begins[enough]])
    high = np.concatenate([onward[ahead], line[behind] + 1, (begins + sizes)[enough]])
    own = value(begins, begins + sizes)
    owner = doc[low]
    # Copies must meet as such, so a whole document has a hash apart from that of a window.
    hashed = value(low, high)
    hashed[len(low) - len(enough) :] ^= np.uint64(0x5555555555555555)
    signed = lambda x: x.view(np.int64)
    return owner, low - begins[owner], high - begins[owner], signed(hashed), signed(own)[owner]


def aligned_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 6,
) -> DataFrame:
    """The columns of ``docs`` with ``__deleted`` (sorted line numbers from 0) and ``__lines``.

    Lines are what line breaks separate, compared without white space at their ends; a block
    counts from ``min_words`` words.  Of two rows the one of larger id is the later; rows without
    an id come last, and rows that share an id are ordered by the SHA-256 of their texts.  Rows
    equal in id and text get the same result, as if they were one.  NULL and empty texts have
    no lines and lose nothing; an empty table gives an empty result.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(body, "\n")
    keyed = docs.withColumn("__sha", F.unhex(F.sha2(body, 256)))
    narrow = keyed.select(
        F.col(id_col).alias("id"),
        "__sha",
        F.transform(lines, lambda x: F.xxhash64(F.btrim(x, F.lit(" \t\r\x0b\x0c")))).alias("h"),
        F.transform(lines, lambda x: F.regexp_count(x, F.lit(WORD))).alias("w"),
    ).dropDuplicates(["id", "__sha"])
    heads = written(narrow, "line-heads")
    order = F.struct(F.col("id").isNull().alias("n"), "id", "__sha")
    of = heads.select(order.alias("key"), "h", "w")
    kind = of.schema["key"].dataType.simpleString()

    def windowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            h, w = batch.column(1), batch.column(2)
            sizes = np.diff(h.offsets.to_numpy()).astype(np.int64)
            owner, *columns = windows_of(h.flatten().to_numpy(), w.flatten().to_numpy(), sizes, min_words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), *map(pa.array, columns)],
                names=["key", "low", "high", "s", "whole"],
            )

    windows = written(
        of.mapInArrow(windowed, f"key {kind}, low long, high long, s long, whole long"), "line-windows"
    )
    shared = (
        windows.groupBy("s")
        .agg(F.min("key").alias("first"), F.max("key").alias("last"))
        .where("first != last")
        .select("s", "first")
    )
    left = windows.drop("whole").join(shared, "s").where(F.col("first") != F.col("key"))
    left = written(left.distinct(), "line-shared")

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (1, 2, 3)]
            found = [common_blocks(h, o, w, min_words) for h, o, w in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int32()))], names=["key", "gone"]
            )

    def gone_by(pairs: DataFrame) -> DataFrame:
        """Lines that documents lose by their partners (``key, other``)."""
        texts = pairs.join(of, "key").join(of.select(F.col("key").alias("other"), F.col("h").alias("theirs")), "other")
        found = texts.select("key", "h", "theirs", "w").mapInArrow(aligned, f"key {kind}, gone array<int>")
        return merged(found.where(F.size("gone") > 0))

    def merged(found: DataFrame) -> DataFrame:
        every = F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone"))))
        return found.groupBy("key").agg(every.alias("gone"))

    gone = written(gone_by(left.select("key", F.col("first").alias("other")).distinct()), "line-gone")
    left = left.drop("first")
    holders, low, high = None, 1, 5
    while True:
        stays = F.col("gone").isNull() | F.expr(
            "exists(sequence(low, high - 1), x -> NOT array_contains(gone, cast(x AS int)))"
        )
        left = written(left.join(gone, "key", "left").where(stays).drop("gone"), "line-left")
        if holders is None:
            # Of equal documents the first is a partner for all of them.
            each = windows.join(left.select("s").distinct(), "s", "left_semi")
            each = each.groupBy("s", "whole").agg(F.min("key").alias("other"))
            rank = F.row_number().over(Window.partitionBy("s").orderBy("other")) - 1
            holders = written(each.select("s", "other", rank.alias("rank")), "line-holders")
        tried = holders.where((F.col("rank") >= low) & (F.col("rank") < high))
        pairs = left.select("key", "s").distinct().join(tried, "s").where(F.col("other") < F.col("key"))
        pairs = written(pairs.select("key", "other").distinct(), "line-pairs")
        if not pairs.limit(1).count():
            break
        gone = written(merged(gone.unionByName(gone_by(pairs))), "line-gone")
        low, high = high, high + 4 * (high - low)
    gone = gone.select(
        F.col("key.id").alias("__id"), F.col("key.__sha").alias("__gone_sha"), F.col("gone").alias("__deleted")
    )
    same = F.col(f"a.{id_col}").eqNullSafe(F.col("b.__id")) & (F.col("a.__sha") == F.col("b.__gone_sha"))
    return (
        keyed.alias("a")
        .join(gone.alias("b"), same, "left")
        .select(*[f"a.`{c}`" for c in docs.columns], "b.__deleted", F.size(lines).alias("__lines"))
    )


def kept_text(text, deleted):
    """The text without its deleted lines."""
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda x, i: ~F.array_contains(deleted, i))
    return F.when(deleted.isNull(), text).otherwise(F.array_join(kept, "\n"))


def dedup(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the lines that earlier documents hold.

    A row of which no words are left goes with them; a row that loses nothing stays as it is.
    """
    text = options.get("text_col", "text")
    found = aligned_lines(docs, **options)
    left = kept_text(F.col(text), F.col("__deleted"))
    found = found.where(F.col("__deleted").isNull() | left.rlike(WORD))
    return found.withColumn(text, kept_text(F.col(text), F.col("__deleted"))).select(*docs.columns)
