"""URL filters: rules first, then logistic regression on hashed character n-grams.

A rule is ``host/path-prefix`` with a verdict.  It fits its host and all subdomains of it when the
URL's path starts with the rule's; of those that fit, the longest holds.  All other URLs are
judged by a logistic regression whose features are the character n-grams of host and path, hashed
into a fixed number of slots (no dictionary, so its size does not depend on the URLs).  It is
trained from a small labelled URL table; scoring is a map over the URLs, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower
from strata.llm.url_examples import ALLOWED, BLOCKED

#: The rules of the registered query.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
SIZES = (3, 4, 5)
SLOTS = 1 << 16
#: Labelled rows the regression learns from; of a larger table, those with the smallest hashes.
MAX_LABELLED = 20_000
#: Characters whose n-grams are held at once; a longer URL is taken alone and whole.
CHUNK = 1 << 20
_START, _END = "\x02", "\x03"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.coalesce(ascii_lower(F.regexp_extract(_behind_scheme(url), r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end, its case kept."""
    return F.coalesce(F.regexp_extract(_behind_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The rule that fits and its verdict, NULL where none does.

    Of rules of one length the one with the longer host holds, of equal rules the first listed.
    """
    rule = verdict = F.lit(None).cast("string")
    # Built from the inside out: what is wrapped last is tried first.
    for name, text in sorted(reversed(rules), key=lambda r: (len(r[1]), r[1].find("/"))):
        wanted, slash, rest = text.partition("/")
        fits = (host == wanted) | host.endswith("." + wanted)
        fits &= path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(name)).otherwise(verdict)
    return rule, verdict


def ngram_slots(texts: Sequence[str], salt: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all n-grams of the texts, and the number of n-grams of each text.

    Digits count as one character: which numbers a URL holds says nothing.
    """
    framed = [f"{_START}{t}{_END}" for t in texts]
    lengths = np.fromiter(map(len, framed), np.int64, len(framed))
    chars = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = np.where((chars >= ord("0")) & (chars <= ord("9")), np.uint32(ord("0")), chars)
    owner = np.repeat(np.arange(len(framed)), lengths)
    found, owners = [], []
    for size in SIZES:
        n = max(len(chars) - size + 1, 0)
        whole = owner[:n] == owner[size - 1 : size - 1 + n]
        value = np.full(n, np.uint64(salt * 8 + size))
        for k in range(size):
            value = value * np.uint64(0x9E3779B97F4A7C15) + chars[k : k + n]
            value ^= value >> np.uint64(29)
        value *= np.uint64(0xBF58476D1CE4E5B9)
        found.append((value >> np.uint64(40))[whole] % np.uint64(slots))
        owners.append(owner[:n][whole])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(found)[order].astype(np.int64), np.bincount(owners, minlength=len(framed))


def features(hosts: Sequence[str], paths: Sequence[str], slots: int) -> tuple[np.ndarray, ...]:
    """Row, slot and value of each n-gram.  Host and path each have length one at most, so a
    long path does not outweigh a short host."""
    rows, cols, values = [], [], []
    for salt, texts in enumerate((hosts, paths)):
        found, counts = ngram_slots(texts, salt, slots)
        rows.append(np.repeat(np.arange(len(texts)), counts))
        cols.append(found)
        values.append(np.repeat(1 / np.sqrt(np.maximum(counts, 1)), counts))
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(values)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    intercept: float

    def score(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        """Probability of a block; one half where nothing was learnt."""
        out, start = np.empty(len(hosts)), 0
        ends = np.cumsum(np.fromiter((len(h) + len(p) for h, p in zip(hosts, paths, strict=True)), np.int64, len(hosts)))
        while start < len(hosts):
            done = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, done + CHUNK, "right")), start + 1)
            rows, cols, values = features(hosts[start:stop], paths[start:stop], len(self.weights))
            sums = np.bincount(rows, self.weights[cols] * values, stop - start)
            out[start:stop] = 1 / (1 + np.exp(-np.clip(sums + self.intercept, -500, 500)))
            start = stop
        return out


def train(
    hosts: Sequence[str], paths: Sequence[str], labels: Sequence[int], *,
    slots: int = SLOTS, penalty: float = 1e-4, steps: int = 400,
) -> Model:
    """Full-batch gradient descent with momentum on the mean logistic loss plus ``penalty``/2 times
    the squared weights; the classes weigh the same.  Without both classes nothing is learnt."""
    y = np.asarray(labels, float)
    weights, intercept = np.zeros(slots), 0.0
    if not 0 < y.sum() < len(y):
        return Model(weights, intercept)
    rows, cols, values = features(hosts, paths, slots)
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    speed, speed0 = np.zeros(slots), 0.0
    for _ in range(steps):
        sums = np.bincount(rows, weights[cols] * values, len(y)) + intercept
        miss = share * (1 / (1 + np.exp(-np.clip(sums, -500, 500))) - y)
        slope = np.bincount(cols, miss[rows] * values, slots) + penalty * weights
        speed, speed0 = 0.9 * speed - slope, 0.9 * speed0 - miss.sum()
        weights, intercept = weights + speed, intercept + speed0
    return Model(weights, float(intercept))


def labelled_table(spark: SparkSession) -> DataFrame:
    """The labelled URLs that ship with the operator: ``url, blocked``."""
    rows = [(u, 1) for u in BLOCKED] + [(u, 0) for u in ALLOWED]
    return spark.createDataFrame(rows, "url string, blocked int")


def fit(labelled: DataFrame, *, max_rows: int = MAX_LABELLED, **settings) -> Model:
    """Learns from ``url, blocked`` rows; rows where either is NULL teach nothing.

    At most ``max_rows`` rows come to the driver, by the hash of the URL, so reruns agree.  A URL
    that is listed several times, or with both labels, counts as often as it is listed.
    """
    known = labelled.where(F.col("url").isNotNull() & F.col("blocked").isNotNull())
    known = known.select(
        F.col("url").alias("u"), host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"),
        (F.col("blocked").cast("int") != 0).cast("int").alias("y"),
    )
    rows = known.orderBy(F.xxhash64("u"), "u", "y").limit(max_rows).collect()
    return train([r.h for r in rows], [r.p for r in rows], [r.y for r in rows], **settings)


def judge(
    pages: DataFrame, model: Model, *, rules: Iterable[tuple[str, str]] = RULES,
    id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``: one row for each row of ``pages``.

    A NULL URL, or one without ``://``, has an empty host and path, no rule, and the verdict the
    regression gives to nothing at all.  A URL above the threshold is blocked, so everything is
    allowed where nothing was learnt.  NULL ids and repeated rows stay as they are; an empty table
    gives an empty result; other columns are not read.
    """

    @F.pandas_udf("double")
    def scored(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series(model.score(hosts.tolist(), paths.tolist()))

    url = F.col(f"`{url_col}`")
    cut = pages.select(F.col(f"`{id_col}`").alias(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), list(rules))
    judged = cut.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("ruled"), scored("host", "path").alias("score"))
    by_score = F.when(F.col("score") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        id_col, "host", "path", "rule", F.coalesce("ruled", by_score).alias("verdict"), "score"
    )
