"""Toxicity by nearest labelled examples.

A bounded sample of labelled rows is the classifier: its terms (words, and words' beginnings) are
selected by how their presence goes with the label, weighed by TF-IDF with document frequencies of
all documents, and the examples' unit vectors are held in a block-max inverted index.  A text's
nearest examples by exact cosine are found block by block, in the order of the blocks' upper
bounds, until no block left can hold a nearer one.  They vote by nearness; the votes are
calibrated on the examples themselves, each without its own vote.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS = re.compile(r"[^\W\d_]+")
BEGINNING = 5
BLOCK = 32
#: Nearest examples that vote, and votes for nothing that stand beside them.
NEAREST, DOUBT = 12, 1.0


def terms_of(text: str | None) -> Counter[str]:
    return Counter(LETTERS.findall((text or "").lower()))


def features(words, wanted=None):
    """(term, times) of words and, marked by a hyphen, of longer words' beginnings."""
    for word, n in words.items():
        if wanted is None or word in wanted:
            yield word, n
        if len(word) > BEGINNING:
            start = word[:BEGINNING] + "-"
            if wanted is None or start in wanted:
                yield start, n


class BlockMaxIndex:
    """Unit vectors of examples; the nearest to a query by exact cosine."""

    def __init__(self, vectors: list[dict[int, float]], terms: int):
        self.vectors, self.terms, self.lists = vectors, terms, None
        self.blocks = max(1, -(-len(vectors) // BLOCK))

    def __getstate__(self):
        return self.__dict__ | {"lists": None}  # made anew by each task from the vectors

    def _open(self) -> None:
        """Each term's weights, block after block, and their maxima."""
        self.lists = np.zeros((self.terms, self.blocks * BLOCK), np.float32)
        for i, vector in enumerate(self.vectors):
            self.lists[list(vector), i] = list(vector.values())
        self.bounds = self.lists.reshape(self.terms, self.blocks, BLOCK).max(axis=2)

    def nearest(self, query: dict[int, float], k: int, without: int = -1) -> list[tuple[float, int]]:
        """(cosine, example), nearest first, equals by number; none that shares no term."""
        if self.lists is None:
            self._open()
        terms, weights = np.fromiter(query, np.int64), np.fromiter(query.values(), np.float32)
        bound = weights @ self.bounds[terms]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        near, scores, least = np.zeros(0, np.int64), np.zeros(0, np.float32), 0.0
        for begin in range(0, len(order), 16):  # so many blocks at a time
            chosen = order[begin : begin + 16]
            if bound[chosen[0]] < least:
                break
            rows = (chosen[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            found = weights @ self.lists[terms[:, None], rows]
            keep = (found > 0) & (found >= least) & (rows != without)
            near, scores = np.append(near, rows[keep]), np.append(scores, found[keep])
            if len(scores) >= k:  # single precision, so a little below the last that counts
                least = float(np.partition(scores, len(scores) - k)[len(scores) - k]) - 1e-5
        exact = []
        for i in near[scores >= least].tolist():
            vector = self.vectors[i]
            exact.append((-sum(w * vector[t] for t, w in query.items() if t in vector), i))
        return [(-s, i) for s, i in sorted(exact)[:k]]


class Model:
    """What is sent to the executors; its size is bounded by the parameters of ``fit``."""

    def __init__(self, idf: dict[str, float], examples, rates, base: float, bare: float):
        """examples: (id, label, {term: times}); rates: weight of an example of each label."""
        self.number = {t: i for i, t in enumerate(idf)}
        self.idf = np.array(list(idf.values()))
        self.bare, self.base = bare, base
        self.ids = [x[0] for x in examples]
        self.place = {x[0]: i for i, x in enumerate(examples) if x[0] is not None}
        self.labels = [x[1] for x in examples]
        vectors = [self.vector(x[2]) for x in examples]
        self.index = BlockMaxIndex(vectors, len(idf)) if examples else None
        votes = [self.vote(self.index.nearest(v, NEAREST, i)) for i, v in enumerate(vectors)]
        self.steps, self.levels = _isotonic(
            np.array(votes), np.array(self.labels, float), np.array([rates[y] for y in self.labels])
        )

    def vector(self, times: dict[str, int]) -> dict[int, float]:
        found = {}
        for term, n in times.items():
            t = self.number[term]
            found[t] = (1 + np.log(n)) * self.idf[t]
        norm = sum(w * w for w in found.values()) ** 0.5
        return {t: w / norm for t, w in found.items()} if norm else {}

    def vote(self, nearest: list[tuple[float, int]]) -> float:
        weight = sum(s for s, _ in nearest)
        return sum(s for s, i in nearest if self.labels[i]) / (weight + DOUBT)

    def score(self, row_id, text: str | None) -> tuple[float, list[tuple]]:
        times = dict(features(terms_of(text), self.number))
        vector = self.vector(times) if times else {}
        if not vector:
            return self.bare, []
        nearest = self.index.nearest(vector, NEAREST, self.place.get(row_id, -1))
        at = np.searchsorted(self.steps, self.vote(nearest), "right") - 1
        evidence = [(self.ids[i], float(s), int(self.labels[i])) for s, i in nearest[:3]]
        return float(self.levels[max(at, 0)]), evidence


def _isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the increasing function nearest to y (pool adjacent violators, slightly smoothed)."""
    if not len(x):
        return np.zeros(1), np.zeros(1)
    pools: list[list[float]] = []
    for k in np.argsort(x, kind="stable"):
        if pools and pools[-1][0] == x[k]:
            pools[-1][1] += y[k] * w[k]
            pools[-1][2] += w[k]
        else:
            pools.append([x[k], y[k] * w[k], w[k]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, a, b = pools.pop()
            pools[-1][1] += a
            pools[-1][2] += b
    rate = (y * w).sum() / w.sum()
    return np.array([p[0] for p in pools]), np.array([(p[1] + rate) / (p[2] + 1) for p in pools])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    training: Column | None = None,
    max_positive: int = 4000,
    max_negative: int = 16000,
    max_terms: int = 4096,
    max_examples: int = 2000,
    min_gain: float = 18.0,
) -> Model:
    """The model of the labelled rows that ``training`` (over the labels) lets in.

    The sample holds at most ``max_positive`` and ``max_negative`` labelled rows, by a hash of
    their ids; at most ``max_terms`` terms are kept, those with a likelihood ratio of at least
    ``min_gain`` between the labels; at most ``max_examples`` rows of each label become examples.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known if training is None else known.where(training)
    known = known.select(F.col(id_col).alias("__id"), (F.col(label_col) > 0).cast("int").alias("__label"))
    sizes = {r["__label"]: r["count"] for r in known.groupBy("__label").count().collect()}
    order = F.xxhash64(F.lit(3), F.col("__id"))
    chosen = [
        known.where(F.col("__label") == y).orderBy(order, "__id").limit(most)
        for y, most in ((1, max_positive), (0, max_negative))
    ]
    # Bounded by max_positive + max_negative rows of an id and a label.
    sample = F.broadcast(chosen[0].unionByName(chosen[1]).dropDuplicates(["__id"]))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).join(sample, "__id")

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        n = [0, 0]
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counts[label].update({t for t, _ in features(terms_of(text.as_py()))})
                n[label] += 1
        terms = list(counts[0] | counts[1]) + [""]
        for y in (0, 1):
            counts[y][""] = n[y]
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms)] + [pa.array([counts[y][t] for t in terms], pa.int64()) for y in (1, 0)],
            names=["term", "p", "n"],
        )

    found = (
        rows.select("__text", "__label")
        .mapInArrow(met, "term string, p long, n long")
        .groupBy("term")
        .agg(F.sum("p").alias("p"), F.sum("n").alias("n"))
        .where("term = '' or p + n >= 3")
    )
    (total_p, total_n) = (found.where("term = ''").agg(F.sum("p"), F.sum("n")).first()) or (0, 0)
    total_p, total_n = total_p or 0, total_n or 0
    if not total_p or not total_n:
        rate = total_p / max(total_p + total_n, 1)
        return Model({}, [], (1, 1), rate, rate)
    # Likelihood ratio of the two-by-two table of presence and label.
    share_p = F.lit(total_p / (total_p + total_n))
    hit, miss = F.col("p") + F.col("n"), F.lit(total_p + total_n) - F.col("p") - F.col("n")
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    gain = 2 * (
        part(F.col("p"), hit * share_p) + part(F.col("n"), hit * (1 - share_p))
        + part(total_p - F.col("p"), miss * share_p) + part(total_n - F.col("n"), miss * (1 - share_p))
    )
    kept = (
        found.where("term != ''").withColumn("gain", gain)
        .where((F.col("gain") >= min_gain) & (F.col("p") * total_n > F.col("n") * total_p))
        .orderBy(F.desc("gain"), "term").limit(max_terms)
    )
    wanted = {r["term"] for r in kept.collect()}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, n = Counter(), 0
        for batch in batches:
            n += batch.num_rows
            for text in batch.column(0):
                words = dict.fromkeys(LETTERS.findall((text.as_py() or "").lower()), 1)
                count.update({t for t, _ in features(words, wanted)})
        count[""] = n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(count)), pa.array(list(count.values()), pa.int64())], names=["term", "n"]
        )

    df = docs.select(F.col(text_col)).mapInArrow(counted, "term string, n long").groupBy("term").agg(F.sum("n"))
    df = dict(df.collect())
    every = df.pop("")
    idf = {t: float(np.log((every + 1) / (df.get(t, 0) + 1)) + 1e-3) for t in sorted(wanted)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times = [list(features(terms_of(t.as_py()), wanted)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([[t for t, _ in x] for x in times], pa.list_(pa.string())),
                    pa.array([[n for _, n in x] for x in times], pa.list_(pa.int64())),
                ],
                names=["__id", "__label", "terms", "times"],
            )

    kind = dict(rows.dtypes)["__id"]
    told = rows.select("__id", "__text", "__label").mapInArrow(
        vectors, f"__id {kind}, __label int, terms array<string>, times array<long>"
    )
    told = told.dropDuplicates(["__id"]).withColumn("bare", F.size("terms") == 0)
    seen = told.groupBy("__label", "bare").count().collect()
    seen = {(r["__label"], r["bare"]): r["count"] for r in seen}
    examples, rates = [], [1.0, 1.0]
    for y, total in ((0, total_n), (1, total_p)):
        mine = told.where((F.col("__label") == y) & ~F.col("bare"))
        taken = [
            (r["__id"], y, dict(zip(r["terms"], r["times"], strict=True)))
            for r in mine.orderBy(order, "__id").limit(max_examples).collect()
        ]
        examples += taken
        # An example stands for the labelled rows that the samples have left out.
        rates[y] = sizes.get(y, 0) / total * seen.get((y, False), 0) / max(len(taken), 1)
    scale = {y: sizes.get(y, 0) / total for y, total in ((0, total_n), (1, total_p))}
    bare = {y: seen.get((y, True), 0) * scale[y] for y in (0, 1)}
    base = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    return Model(idf, examples, rates, base, (bare[1] + base) / (bare[0] + bare[1] + 1))


def score(
    docs: DataFrame,
    model: Model,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.3,
) -> DataFrame:
    """For each row the id, ``score, predicted, evidence`` (id, cosine and label of the nearest).

    A text that shares no term with the model (NULL, empty, plain) has the calibrated score of
    such texts.  Without labelled rows of both labels every score is the rate of what there is,
    0 if there is nothing.  Only the text is read; an example never votes on its own row.  Rows
    without an id and repeated rows are ordinary; an empty table gives an empty result.
    """
    kind = dict(docs.dtypes)[id_col]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            found = [
                model.score(i, t.as_py())
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
            ]
            evidence = pa.struct(
                [("id", batch.schema.field(0).type), ("cosine", pa.float64()), ("label", pa.int32())]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s for s, _ in found], pa.float64()),
                    pa.array([int(s >= threshold) for s, _ in found], pa.int32()),
                    pa.array(
                        [[{"id": i, "cosine": s, "label": y} for i, s, y in e] for _, e in found],
                        pa.list_(evidence),
                    ),
                ],
                names=[id_col, "score", "predicted", "evidence"],
            )

    return docs.select(F.col(id_col), F.col(text_col).alias("__text")).mapInArrow(
        scored,
        f"`{id_col}` {kind}, score double, predicted int, "
        f"evidence array<struct<id: {kind}, cosine: double, label: int>>",
    )


def accepted(
    docs: DataFrame,
    model: Model,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.3,
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, as they are; nothing is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    columns = docs.columns
    at_id, at_text = columns.index(id_col), columns.index(text_col)

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            pairs = zip(batch.column(at_id).to_pylist(), batch.column(at_text), strict=True)
            yield batch.filter(pa.array([model.score(i, t.as_py())[0] < threshold for i, t in pairs], pa.bool_()))

    return docs.mapInArrow(passed, docs.schema)
