"""Language-model scoring by prediction by partial matching.

The model holds the contexts of up to ``ORDER`` bytes that precede each byte of the training
texts, across word breaks; before a text stand ``ORDER`` marks and behind it one, a byte that
UTF-8 never uses.  A symbol is coded at the longest known context; escapes are estimated from the
number of distinct followers (method C), and what a longer context has offered is excluded in the
shorter ones.

What a symbol costs depends on itself and the ``ORDER`` bytes before it alone, a gram of six bytes
that fits a number exactly.  Grams are counted over all texts into a table that grows with the
corpus, and each distinct one is costed once: grams whose contexts end in the same two bytes hold
all that their contexts of two bytes and more need, and shorter contexts have 65,536 cells at
most.  The texts' grams are then joined to their costs.  The at most ``max_cells`` most frequent
grams and ``hot_words`` most frequent words are sent to the executors as a cache in front of the
joins; results do not depend on either.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written

ORDER = 5
#: Stands before and behind a text.
MARK = b"\xff"
#: Bytes of text that are turned into grams at once, and grams a task remembers.
PIECE, GRAMS = 1 << 20, 1 << 20
#: Distinct words a task counts before it hands them on.
REMEMBERED = 200_000


def hash_of(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def pieces_of(texts: Iterable[str | None]) -> Iterator[tuple[int, bytes]]:
    """(text's number, ``ORDER`` bytes of context and the symbols behind them)."""
    for row, text in enumerate(texts):
        data = MARK * ORDER + (text or "").encode() + MARK
        for begin in range(0, len(data) - ORDER, PIECE):
            yield row, data[begin : begin + PIECE + ORDER]


def grams_of(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The gram of each symbol (context << 8 | symbol), and the number of each piece's symbols."""
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.array([len(p) - ORDER for p in pieces], np.int64)
    gram = flat[ORDER:].astype(np.int64)
    for back in range(1, ORDER + 1):
        gram |= flat[ORDER - back : len(flat) - back].astype(np.int64) << (8 * back)
    return gram[np.arange(sizes.sum()) + ORDER * np.repeat(np.arange(len(sizes)), sizes)], sizes


def _in_chunks(texts: Iterable[str | None]) -> Iterator[tuple[list[int], list[bytes]]]:
    rows, pieces, size = [], [], 0
    for row, piece in pieces_of(texts):
        rows.append(row)
        pieces.append(piece)
        size += len(piece)
        if size >= PIECE:
            yield rows, pieces
            rows, pieces, size = [], [], 0
    if pieces:
        yield rows, pieces


def gram_counts(docs: DataFrame) -> DataFrame:
    """``gram, count, uses`` of ``docs(text, held_out)``: occurrences in training and in all."""

    def merged(parts: list[np.ndarray]) -> np.ndarray:
        every = np.concatenate(parts, axis=1)
        every = every[:, np.argsort(every[0], kind="stable")]
        first = np.flatnonzero(np.diff(every[0], prepend=-1))
        return np.stack([every[0][first], *(np.add.reduceat(x, first) for x in every[1:])])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []

        def flushed():
            columns = [pa.array(x) for x in merged(parts)]
            parts.clear()
            yield pa.RecordBatch.from_arrays(columns, names=["gram", "count", "uses"])

        for batch in batches:
            texts, held = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            for trains in (True, False):
                chosen = texts.filter(pa.array(held != trains))
                some = (t.as_py() for t in chosen)
                for _, pieces in _in_chunks(some):
                    gram, times = np.unique(grams_of(pieces)[0], return_counts=True)
                    parts.append(np.stack([gram, times * trains, times]))
                    if sum(x.shape[1] for x in parts) > GRAMS:
                        parts[:] = [merged(parts)]
                        if parts[0].shape[1] > GRAMS // 2:
                            yield from flushed()
        if parts:
            yield from flushed()

    partial = docs.select("text", "held_out").mapInArrow(counted, "gram long, count long, uses long")
    return partial.groupBy("gram").agg(F.sum("count").alias("count"), F.sum("uses").alias("uses"))


def _level(order: int, cells: np.ndarray, counts: np.ndarray, shorter):
    """Of one order: cells, counts, contexts, and each context's total, followers and what these
    count in the shorter context."""
    contexts, at = np.unique(cells >> 8, return_inverse=True)
    at, seen = at.ravel(), counts > 0
    below = np.zeros(len(cells))
    if shorter is not None:
        below = shorter[1][np.searchsorted(shorter[0], cells & ((1 << (8 * order)) - 1))]
    of = lambda weight: np.bincount(at, weight, len(contexts))
    return cells, counts, contexts, of(counts), of(seen.astype(float)), of(below * seen)


def short_levels(pairs: np.ndarray) -> list:
    """The contexts of no and of one byte, of the counts of all 65,536 pairs of bytes."""
    none = _level(0, np.arange(256), pairs.reshape(256, 256).sum(axis=0), None)
    return [none, _level(1, np.arange(65_536), pairs, none)]


def gram_costs(gram: np.ndarray, count: np.ndarray, short: list) -> np.ndarray:
    """log10 probability of each gram's symbol.

    The distinct grams are all of those whose contexts end in the same two bytes, for any such.
    """
    levels = list(short)
    for order in range(2, ORDER + 1):
        cells, at = np.unique(gram & ((1 << (8 * order + 8)) - 1), return_inverse=True)
        levels.append(_level(order, cells, np.bincount(at.ravel(), count, len(cells)), levels[-1]))
    cost = np.zeros(len(gram))
    open_ = np.arange(len(gram))
    # Of each open gram: what the longer context excludes here, and its followers there.
    less, fewer = np.zeros(len(gram)), np.zeros(len(gram))
    for order in range(ORDER, -1, -1):
        cells, counts, contexts, totals, followers, excluded = levels[order]
        cell = gram[open_] & ((1 << (8 * order + 8)) - 1)
        context = np.searchsorted(contexts, cell >> 8)
        times = counts[np.searchsorted(cells, cell)]
        rest = followers[context] - fewer[open_]
        mass = totals[context] - less[open_] + rest
        seen = times > 0
        cost[open_[seen]] += np.log10(times[seen] / mass[seen])
        # Where the longer context has offered everything there is, the escape is certain.
        escape = ~seen & (rest > 0)
        cost[open_[escape]] += np.log10(rest[escape] / mass[escape])
        less[open_], fewer[open_] = excluded[context], followers[context]
        open_ = open_[~seen]
    known = int((short[0][1] > 0).sum())
    cost[open_] -= np.log10(max(256 - known, 1))
    return cost


def costed(grams: DataFrame) -> DataFrame:
    """``gram, uses, cost`` of every distinct gram of ``grams(gram, count, uses)``."""
    pairs = np.zeros(65_536)
    cell = F.col("gram").bitwiseAND(F.lit(0xFFFF))
    for r in grams.groupBy(cell.alias("cell")).agg(F.sum("count").alias("n")).collect():
        pairs[r["cell"]] = r["n"]
    shared = grams.sparkSession.sparkContext.broadcast(pairs)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        short = short_levels(shared.value)
        open_: list[np.ndarray] = []

        def closed(parts: list[np.ndarray]):
            gram, count, uses = np.concatenate(parts, axis=1)
            cost = pa.array(gram_costs(gram, count, short))
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram), pa.array(uses), cost], names=["gram", "uses", "cost"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(i).to_numpy() for i in range(3)])
            ends = (rows[0] >> 8) & 0xFFFF
            cut = np.searchsorted(ends, ends[-1])
            if open_ and not cut and (open_[-1][0, -1] >> 8) & 0xFFFF == ends[0]:
                open_.append(rows)
                continue
            if open_ or cut:
                yield from closed([*open_, rows[:, :cut]])
            open_ = [rows[:, cut:]]
        if open_:
            yield from closed(open_)

    end = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))
    dealt = grams.withColumn("end", end).repartition("end").sortWithinPartitions("end")
    return dealt.select("gram", "count", "uses").mapInArrow(each, "gram long, uses long, cost double")


def most_frequent(df: DataFrame, column: str, most: int) -> DataFrame:
    """Rows down to the smallest power of 2 ** 0.25 of ``column`` that leaves at most ``most``."""
    step = F.floor(F.log2(column) * 4).cast("int")
    steps = df.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    least, kept = None, 0
    for row in steps:
        kept += row["count"]
        if kept > most:
            break
        least = row["step"]
    return df.where(step >= least) if least is not None else df.limit(0)


def word_counts(docs: DataFrame) -> DataFrame:
    """``hash, word, count`` of every distinct word of ``docs(text)``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def flushed():
            keys = list(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([hash_of(k) for k in keys], pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(list(total.values()), pa.int64()),
                ],
                names=["hash", "word", "count"],
            )
            total.clear()

        for batch in batches:
            for text in batch.column(0):
                total.update(words_of(text.as_py()))
                if len(total) > REMEMBERED:
                    yield from flushed()
        yield from flushed()

    partial = docs.select("text").mapInArrow(counted, "hash long, word binary, count long")
    return partial.groupBy("hash", "word").agg(F.sum("count").alias("count"))


def score(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    held_out_of: int = 10,
    hot_words: int = 1 << 18,
    max_cells: int = 1 << 20,
) -> DataFrame:
    """Scores every row of ``docs`` by a model of those whose crc32 (of the id) mod
    ``held_out_of`` is not 0.

    Columns: the id, ``held_out, n_tokens, n_known, train_tokens, base_score, score``.  ``score``
    is log10 of the text's probability, its bytes as they are and an end; ``base_score`` that of
    its ASCII-lower-cased words, each on its own, and an end.  NULL and empty texts are the end
    alone; rows without an id train; repeated rows each train and each are scored; an empty table
    gives an empty result.  Without training rows only uniform costs remain.
    """
    spark = docs.sparkSession
    held = F.coalesce(
        F.crc32(F.col(id_col).cast("string").cast("binary")) % held_out_of == 0, F.lit(False)
    )
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"), held.alias("held_out"))
    training = rows.where(~F.col("held_out"))
    ends_all = training.count()
    counts = written(word_counts(training), "ppm-words")
    sums = counts.agg(F.coalesce(F.sum("count"), F.lit(0)), F.count("*")).first()
    total, distinct = sums[0] + ends_all, sums[1] + (1 if ends_all else 0)
    scale = total + 0.1 * (distinct + 1)
    table = most_frequent(counts, "count", hot_words).select("word", "count").toArrow()

    costs = written(costed(written(gram_counts(rows), "ppm-grams")), "ppm-costs")
    cached = most_frequent(costs, "uses", max_cells).select("gram", "cost").toArrow()
    gram, cost = (cached.column(i).to_numpy() for i in range(2))
    by = np.argsort(gram)
    model = spark.sparkContext.broadcast(
        {
            "words": table.column(0).to_pylist(),
            "base": np.log10((table.column(1).to_numpy() + 0.1) / scale),
            "end_base": float(np.log10((ends_all + 0.1) / scale)),
            "grams": gram[by],
            "costs": cost[by],
        }
    )
    id_kind = dict(rows.dtypes)["__id"]
    names = ["__row", "__id", "held_out", "n_tokens", "known", "base", "score", "words", "times", "grams", "gram_times"]

    def coded(texts: list[str | None], grams: np.ndarray, costs: np.ndarray):
        """Each of some texts' cost by the cached grams, and (text, gram, times) of the others."""
        score, others = np.zeros(len(texts)), []
        for owners, pieces in _in_chunks(texts):
            every, sizes = grams_of(pieces)
            owner = np.repeat(owners, sizes)
            distinct, at = np.unique(every, return_inverse=True)
            found = np.searchsorted(grams, distinct)
            hit = np.zeros(len(distinct), bool)
            inside = found < len(grams)
            hit[inside] = grams[found[inside]] == distinct[inside]
            cost = np.zeros(len(distinct))
            cost[hit] = costs[found[hit]]
            at = at.ravel()
            score += np.bincount(owner, cost[at], len(texts))
            missed = ~hit[at]
            # A gram has 48 bits, so there is room for the text's number above it.
            others.append((owner[missed] << 48) | every[missed])
        pairs, times = np.unique(np.concatenate(others), return_counts=True)
        return score, pairs >> 48, pairs & ((1 << 48) - 1), times

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        m = model.value
        place = {w: i for i, w in enumerate(m["words"])}
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                part = batch.slice(begin, 64)
                n = part.num_rows
                texts = part.column(1).to_pylist()
                found = [Counter(words_of(t)) for t in texts]
                hot = [[place[w] for w in c if w in place] for c in found]
                hot_n = [[k for w, k in c.items() if w in place] for c in found]
                cold = [[w for w in c if w not in place] for c in found]
                cold_n = [[c[w] for w in ws] for c, ws in zip(found, cold, strict=True)]
                at = np.repeat(np.arange(n), [len(x) for x in hot])
                which = np.array([i for x in hot for i in x], np.int64)
                times = np.array([i for x in hot_n for i in x], np.int64)
                rare = np.array([sum(x) for x in cold_n], np.int64)
                base = m["end_base"] + np.bincount(at, m["base"][which] * times, n)
                shown = np.bincount(at, times, n).astype(np.int64)
                score, owner, grams, gram_times = coded(texts, m["grams"], m["costs"])
                offsets = pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row, row + n)),
                        part.column(0),
                        part.column(2),
                        pa.array(shown + rare + 1),
                        pa.array(shown + (1 if ends_all else 0)),
                        pa.array(base),
                        pa.array(score),
                        pa.array([[hash_of(w) for w in x] for x in cold], pa.list_(pa.int64())),
                        pa.array(cold_n, pa.list_(pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(grams)),
                        pa.ListArray.from_arrays(offsets, pa.array(gram_times.astype(np.int32))),
                    ],
                    names=names,
                )
                row += n

    scores = written(
        rows.select("__id", "text", "held_out").mapInArrow(
            scored,
            f"__row long, __id {id_kind}, held_out boolean, n_tokens long, known long, base double, "
            "score double, words array<long>, times array<int>, grams array<long>, gram_times array<int>",
        ),
        "ppm-scores",
    )
    rare = scores.select("__row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "__row", F.col("w.words").alias("hash"), F.col("w.times").alias("times")
    )
    cold = rare.join(counts.select("hash", "count"), "hash", "left").groupBy("__row").agg(
        F.sum(F.when(F.col("count") > 0, F.col("times")).otherwise(0)).alias("more"),
        F.sum(
            F.col("times") * F.log10((F.coalesce("count", F.lit(0)) + 0.1) / F.lit(float(scale)))
        ).alias("rest"),
    )
    others = scores.select("__row", F.explode(F.arrays_zip("grams", "gram_times")).alias("g")).select(
        "__row", F.col("g.grams").alias("gram"), F.col("g.gram_times").alias("times")
    )
    spelt = others.join(costs.select("gram", "cost"), "gram").groupBy("__row").agg(
        F.sum(F.col("times") * F.col("cost")).alias("spelt")
    )
    whole = scores.drop("words", "times", "grams", "gram_times")
    return whole.join(cold, "__row", "left").join(spelt, "__row", "left").select(
        F.col("__id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("spelt", F.lit(0.0))).alias("score"),
    )
