"""URL filter, centroid clustering and filter audit against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from strata.llm import centroids, filter_audit, url_filter
from strata.llm.url_examples import ALLOWED, BLOCKED

# ---------------------------------------------------------------- URL filter

URLS = [
    None, "", "no scheme/en/1", "http://", "http://ORG", "http://org/", "http://sub.Org/x?y#z",
    "http://notorg/", "http://example.org/en/1", "http://example.org/en/199/a", "http://example.org/en/2",
    "http://a.example.org/es/", "http://example.org/es", "http://com/fr/1", "http://shop.com/de/?q=/fr/",
    "http://shop.com?x=://other.org/", "http://ÄÖ.example.net/Pfad/ß", "ftp://user@host:80/De/x", "http://a.org#/es/",
    "http://x.com/DE/1", "http://casino.example.net/" + "long/" * 40_000,
]


def expected_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in url_filter.RULES:
        at = rule.index("/")
        if (host == rule[:at] or host.endswith("." + rule[:at])) and path.startswith(rule[at:]):
            fits.append((len(rule), rule, verdict))
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict


def slow_score(model, host, path):
    """The regression one n-gram after the other, in Python integers."""
    total, word = model.intercept, (1 << 64) - 1
    for salt, text in enumerate((host, path)):
        chars = [ord("0") if "0" <= c <= "9" else ord(c) for c in f"\x02{text}\x03"]
        slots = []
        for size in url_filter.SIZES:
            for at in range(len(chars) - size + 1):
                value = salt * 8 + size
                for c in chars[at : at + size]:
                    value = (value * 0x9E3779B97F4A7C15 + c) & word
                    value ^= value >> 29
                slots.append(((value * 0xBF58476D1CE4E5B9 & word) >> 40) % len(model.weights))
        total += sum(model.weights[s] for s in slots) / math.sqrt(max(len(slots), 1))
    return 1 / (1 + math.exp(-total))


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.fit(url_filter.labelled_table(spark))


def pages_of(spark, urls):
    rows = [(i, u, "h", 1, 0.5) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, score int, verdict double")


def test_rules_and_scores_equal_brute_force(spark, model):
    found = {r.page_id: r for r in url_filter.judge(pages_of(spark, URLS), model).collect()}
    assert len(found) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule, verdict = expected_rule(url)
        row = found[i]
        assert (row.host, row.path, row.rule) == (host, path, rule), url
        assert row.score == pytest.approx(slow_score(model, host, path), rel=1e-9)
        assert row.verdict == (verdict or ("block" if row.score > 0.5 else "allow")), url


def test_chunks_change_no_score(monkeypatch, model):
    hosts, paths = ["a.b", "", "casino.example.net", "x" * 50] * 5, ["/1", "", "/en/22", "/y"] * 5
    whole = model.score(hosts, paths)
    monkeypatch.setattr(url_filter, "CHUNK", 25)
    assert model.score(hosts, paths) == pytest.approx(whole, rel=1e-12)
    assert len(model.score([], [])) == 0


def test_held_out_urls_of_the_labelled_table():
    """Whole hosts are held out, and many of their words occur only once in the table."""
    rows = [(u, 1) for u in BLOCKED] + [(u, 0) for u in ALLOWED]
    random.Random(3).shuffle(rows)
    cut = [(*expected_rule(u)[:2], y) for u, y in rows]
    right = 0
    for fold in range(5):
        h, p, y = zip(*[r for i, r in enumerate(cut) if i % 5 != fold], strict=True)
        learnt = url_filter.train(h, p, y)
        h, p, y = zip(*[r for i, r in enumerate(cut) if i % 5 == fold], strict=True)
        right += int(((learnt.score(h, p) > 0.5) == np.array(y)).sum())
    assert right / len(cut) >= 0.85
    assert len({h for h, _, _ in cut}) == len(cut)  # no host is on both sides


def test_junk_hosts_of_the_given_pages(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    found = url_filter.judge(pages, model, rules=()).collect()
    assert not {r.host for r in found} & {expected_rule(u)[0] for u in BLOCKED + ALLOWED}
    junk = [bool(re.search("adult|bets|ads-|casino|pills|spam", r.host)) for r in found]
    assert 0 < sum(junk) < len(found) / 2
    assert np.mean([r.verdict == "block" for r, j in zip(found, junk, strict=True) if j]) >= 0.95
    assert np.mean([r.verdict == "block" for r, j in zip(found, junk, strict=True) if not j]) <= 0.03


def test_training_ignores_unlabelled_rows_and_has_a_bound(spark):
    rows = [(u, 1) for u in BLOCKED] + [(u, 0) for u in ALLOWED]
    clean = url_filter.fit(spark.createDataFrame(rows, "url string, blocked int"))
    more = [(None, 1), ("http://x.example/", None)]
    noisy = url_filter.fit(spark.createDataFrame([*more, *reversed(rows)], "url string, blocked int"))
    assert np.array_equal(clean.weights, noisy.weights) and clean.intercept == noisy.intercept
    one = url_filter.fit(spark.createDataFrame(rows[:5], "url string, blocked int"))
    nothing = url_filter.fit(spark.createDataFrame([], "url string, blocked int"))
    assert not one.weights.any() and not nothing.weights.any()
    verdicts = url_filter.judge(pages_of(spark, ["http://casino.example.net/"]), nothing, rules=())
    assert verdicts.first().verdict == "allow"
    few = url_filter.fit(spark.createDataFrame(rows, "url string, blocked int"), max_rows=10)
    assert not np.array_equal(few.weights, clean.weights)
    assert url_filter.judge(pages_of(spark, []), clean).count() == 0


def test_url_filter_keeps_repeats_and_null_ids(spark, model):
    rows = [(None, "http://a.org/"), (None, "http://a.org/"), (1, None), (1, None)]
    found = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), model).collect()
    assert sorted((str(r.page_id), r.verdict) for r in found)[2:] == [("None", "allow")] * 2


# ---------------------------------------------------------------- centroids


def clusters_by_brute_force(rows, k=8, rounds=10, seed=3):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * float(x)) for x in v]))
    hashed = sorted((hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centres = [v for _, v in hashed[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        mine = defaultdict(list)
        for _, v in kept:
            mine[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(x) for x in zip(*mine[j], strict=True)] if mine[j] else c for j, c in enumerate(centres)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, j, d in found:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, j, d, inertia[j], sum(inertia.values()), digest[j]) for i, j, d in found]


def vectors_of(rng, n, kinds=5):
    means = rng.normal(size=(kinds, 64))
    return [(i, [float(np.float32(x)) for x in means[i % kinds] + rng.normal(size=64) / 3]) for i in range(n)]


VECTOR_SCHEMA = "vec_id long, embedding array<float>, cluster string, ids int"


def cluster_rows(spark, rows, parts=3, **settings):
    made = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], VECTOR_SCHEMA).repartition(parts)
    return [tuple(r) for r in centroids.cluster(made, **settings).collect()]


@pytest.mark.parametrize("block", [7, 4096])
def test_centroids_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(centroids, "BLOCK", block)
    rows = vectors_of(np.random.default_rng(2), 150)
    rows += [(200, None), (201, []), (202, [1.0] * 63), (203, [1.0] * 63 + [None]), (204, [1.0] * 63 + [math.inf]),
             (205, [math.nan] * 64), (206, [0.0] * 64), (207, [-0.0] * 64), (None, rows[3][1]), (9, rows[9][1]), (9, rows[10][1])]
    assert sorted(cluster_rows(spark, rows), key=str) == sorted(clusters_by_brute_force(rows), key=str)


def test_centroids_with_ties_few_vectors_and_empty_clusters(spark):
    same = [(i, [0.5] * 64) for i in range(20)]
    assert sorted(cluster_rows(spark, same)) == sorted(clusters_by_brute_force(same))
    few = vectors_of(np.random.default_rng(1), 3)
    assert sorted(cluster_rows(spark, few)) == sorted(clusters_by_brute_force(few))
    assert cluster_rows(spark, []) == cluster_rows(spark, [(1, None), (2, [1.0])]) == []


def test_vectors_too_large_for_exact_distances_move_nothing(spark):
    rows = vectors_of(np.random.default_rng(4), 40)
    far = [(77, [3e38] * 64), (78, [131072.0] + [0.0] * 63)]
    near = [(79, [131071.0, -131071.0] * 32)]
    found = sorted(cluster_rows(spark, rows + far + near), key=str)
    expected = clusters_by_brute_force(rows + near) + [(i, *[None] * 5) for i, _ in far]
    assert found == sorted(expected, key=str)


def test_lookup_tables_equal_direct_distances():
    rng = np.random.default_rng(7)
    vectors = rng.integers(-50, 50, (300, 64))
    centres = rng.integers(-50, 50, (5, 64)).tolist()
    found = [np.unique(c, return_inverse=True) for c in vectors.T]
    best, distance = centroids.nearest([v for v, _ in found], np.array([c for _, c in found]), centres)
    direct = ((vectors[:, None, :] - np.array(centres)[None]) ** 2).sum(axis=2)
    assert best.tolist() == direct.argmin(axis=1).tolist() and distance.tolist() == direct.min(axis=1).tolist()


# ---------------------------------------------------------------- filter audit


def audit_by_brute_force(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for i, text, source in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs),
        }
        rows.append((source or "", i, {f for f in "ABCDE" if fails[f]}))
    out, shapley = Counter(), Counter()
    for order in map("".join, permutations("ABCDE")):
        for part, i, fails in rows:
            gone = False
            for step, f in enumerate(order, 1):
                key = (part, order, step)
                out[key, "removed"] += (removed := f in fails and not gone)
                out[key, "redundant"] += f in fails and gone
                out[key, "unique_fails"] += fails == {f}
                out[key, "good_lost"] += removed and i in good
                out[key, "toxic_lost"] += removed and i in toxic
                shapley[part, f] += removed
                gone |= f in fails
                out[key, "kept"] += not gone
    return {
        (part, order, step): (*(out[(part, order, step), c] for c in filter_audit.OUTCOMES), shapley[part, f])
        for part in {p for p, _, _ in rows} for order in map("".join, permutations("ABCDE"))
        for step, f in enumerate(order, 1)
    }


def audit_rows(spark, docs, labels):
    made = spark.createDataFrame([(i, t, s, 1, "x", 0.5) for i, t, s in docs], "doc_id long, text string, source string, mask int, part string, digest double")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(made.repartition(3), known).collect()
    assert len(found) == len({tuple(r[:3]) for r in found})
    return {tuple(r[:3]): tuple(r[3:]) for r in found}


@pytest.fixture(scope="module")
def audited():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(60):
        text = " ".join(rng.choices(words[: rng.choice([40, 400])], k=rng.choice([50, 199, 200, 260])))
        if rng.random() < 0.3:
            text = text.upper()
        docs.append((i, text + rng.choice(["", " #", " |", "\n\x0b"]), rng.choice(["a", "b", None, ""])))
    docs += [(100 + i, docs[i % 7][1], "a") for i in range(20)]
    docs += [(200, None, "a"), (201, "", "b"), (199, " ", "b"), (None, docs[0][1], "c"), (None, None, None)]
    docs += [(5, docs[5][1], "a"), (5, docs[5][1], "a"), (300, "É\U0001F600 " * 500, "long"), (301, "word " * 60_000, "long")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 130, 2)] + [(4, 0, 0), (4, None, 1), (None, 1, 1), (999, 1, 1)]
    return docs, [(i, None if q is None else int(q), int(t)) for i, q, t in labels]


@pytest.mark.parametrize(("share", "parts"), [(1 / 2000, 512), (1 / 10, 1)])
def test_audit_equals_brute_force(spark, monkeypatch, audited, share, parts):
    monkeypatch.setattr(filter_audit, "HOT_SHARE", share)
    monkeypatch.setattr(filter_audit, "PARTS_AT_ONCE", parts)
    assert audit_rows(spark, *audited) == audit_by_brute_force(*audited)


def test_audit_of_nothing(spark, audited):
    assert audit_rows(spark, [], audited[1]) == {}
    some = audited[0][:4]
    assert audit_rows(spark, some, []) == audit_by_brute_force(some, [])


def test_packed_counters_do_not_run_over():
    counters = filter_audit.packed_counters()
    many = (1 << 62) - 1
    total = many * counters[3] + many * counters[3 + 32] + counters[0]
    counts = filter_audit.unpack(total)
    one, two = filter_audit.outcome_fields(3, False, False), filter_audit.outcome_fields(3, True, False)
    expected = one.astype(object) * many + two.astype(object) * many + filter_audit.outcome_fields(0, False, False)
    assert (counts.astype(object) == expected).all() and counts.shape == (600, len(filter_audit.OUTCOMES))
