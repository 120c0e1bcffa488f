"""Corpus operators against brute force, and on the awkward rows each must handle."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import (
    ann_forest, graph, licences, line_dedup, mixing, ngram_join, ppm, sentencepiece_bpe, spotsigs,
    suffix_dedup, toxicity,
)
from strata.llm.common import written

SCHEMA = "doc_id long, text string, lang string, source string, score double, key string, n long"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    stems = "the of and her ation ing ble ent or st ea he wh nd".split()
    made = ["".join(rng.choices(stems, k=rng.randint(1, 3))) for _ in range(words)]
    return "".join(w + ("\n" if rng.random() < 0.1 else " ") for w in made).strip()


@pytest.fixture(scope="module")
def texts():
    base = [prose(i, 60 + 7 * i) for i in range(24)]
    rows = dict(enumerate(base))
    rows[40] = base[3]  # an exact copy
    rows[41] = base[4].replace("the", "a", 1)  # near copies
    rows[42] = base[4] + " more"
    rows[43] = base[5][:300] + "\n" + base[6][:400]
    rows[44], rows[45], rows[46] = "", None, " \n\t "
    rows[47] = "short"
    rows[48] = "ab" * 400  # repeats itself
    rows[49] = prose(99, 12_000)
    rows[50] = "Ünïcode — ‘naïve’ 😀 \x00 end"
    return rows


def docs_of(spark, texts, extra=()):
    rows = [(i, t, "en", f"s{(i or 0) % 3}", 0.5, "k", 1) for i, t in [*texts.items(), *extra]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark, texts):
    return docs_of(spark, texts).repartition(3)


@pytest.fixture(scope="module")
def awkward(spark, texts):
    """Rows without an id, and rows that repeat."""
    more = [(None, texts[3]), (None, None), (7, texts[7]), (7, texts[8]), (9, texts[9]), (None, texts[3])]
    return docs_of(spark, texts, more)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables_give_empty_results(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(nothing, labels)
    path = sentencepiece_bpe.default_model()
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for found in (
        toxicity.score(nothing, model), toxicity.accepted(nothing, model), line_dedup.dedup(nothing),
        spotsigs.compare_edited(nothing), ppm.score(nothing), licences.scan(nothing),
        suffix_dedup.dedup(nothing), ngram_join.similar_components(nothing),
        ngram_join.representatives(nothing), ann_forest.search(vectors, vectors),
        mixing.mix(nothing), mixing.mixed(nothing), sentencepiece_bpe.encode(nothing, path),
    ):
        assert found.count() == 0


def test_sentencepiece_equals_the_library(spark, docs, awkward, texts):
    path = sentencepiece_bpe.default_model()
    library = sentencepiece_bpe.Vocabulary(path).library
    for r in sentencepiece_bpe.encode(docs, path).collect():
        ids = library.encode(texts[r.doc_id] or "") + [library.eos_id()]
        assert (r.ids, r.decoded, r.n_corrected) == (ids, library.decode(ids), 0)
        assert r.n_tokens == len(ids)
    assert sentencepiece_bpe.encode(awkward, path, digests=True).count() == awkward.count()


def test_sentencepiece_of_random_text():
    vocabulary = sentencepiece_bpe.Vocabulary(sentencepiece_bpe.default_model())
    rng = random.Random(5)
    for _ in range(300):
        text = "".join(rng.choices("ab the\n\t▁éß中😀. ", k=rng.randint(1, 40)))
        ids = [i for s in vocabulary.split(text) for i in vocabulary.merge(s)]
        assert ids == vocabulary.library.encode(text), repr(text)


def test_suffix_dedup_equals_brute_force(docs, texts):
    seen, expected = set(), {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        spans = len(bytes(gone).replace(b"\0", b" ").split())
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        expected[i] = (len(data), sum(gone), spans, kept)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.dedup(docs).collect()}
    assert found == expected
    assert expected[40][3] == b"" and 0 < len(expected[48][3]) <= 102


def test_suffix_dedup_orders_awkward_rows(awkward, texts):
    rows = suffix_dedup.dedup(awkward).collect()
    assert len(rows) == awkward.count()
    nine = sorted(r.n_removed for r in rows if r.doc_id == 9)
    assert nine == [0, len(texts[9].encode())]
    assert all(r.n_removed == r.n_bytes for r in rows if r.doc_id is None)


def test_deep_shallow_sort_on_hard_strings():
    rng = np.random.default_rng(1)
    raw = np.concatenate([rng.integers(0, 2, 3000), np.zeros(500), np.tile([1, 2, 3], 300)]).astype(np.uint8)
    at = rng.integers(0, len(raw) - 110, 2000)
    seen, expected = set(), []
    for p in at:
        expected.append(raw[p : p + 100].tobytes() in seen)
        seen.add(raw[p : p + 100].tobytes())
    assert suffix_dedup.repeated(raw, at, 100).tolist() == expected


def roots_by_brute_force(texts, size, num, den):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(max(len(w) - size + 1, 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and both * den >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("size,num,few", [(4, 85, 12), (5, 80, 12), (3, 50, 1)])
def test_ngram_join_equals_brute_force(monkeypatch, docs, texts, size, num, few):
    monkeypatch.setattr(ngram_join, "FEW", few)  # 1: all by the blocked product
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 2)
    found = ngram_join.similar_components(docs, size=size, threshold=(num, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == roots_by_brute_force(texts, size, num, 100)


def test_ngram_join_without_stars_loses_nothing(spark, monkeypatch):
    base = prose(1, 120).split()
    rng = random.Random(2)
    chain = {}
    for i in range(40):  # each a little further from the first
        base[rng.randrange(len(base))] = f"w{i}"
        chain[i] = " ".join(base)
    monkeypatch.setattr(ngram_join, "STAR_TURNS", 1)
    found = ngram_join.similar_components(docs_of(spark, chain), size=4, threshold=(85, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == roots_by_brute_force(chain, 4, 85, 100)


def test_ngram_join_moves_no_text_and_no_lone_ngram(spark, monkeypatch, docs, texts):
    plans, tables = [], {}

    def seen(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        tables[label] = written(df, label)
        return tables[label]

    monkeypatch.setattr(ngram_join, "written", seen)
    monkeypatch.setattr(ngram_join, "FEW", 2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ngram_join.similar_components(docs, size=4, threshold=(85, 100)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == roots_by_brute_force(texts, 4, 85, 100)
    exchanged = [re.findall(r"hashpartitioning\((\w+)#", plan) for label, plan in plans if label == "join-sets"]
    assert exchanged and all(set(keys) <= {"__bucket"} for keys in exchanged)
    moved = Counter(s for r in tables["join-shared"].collect() for s in r.ids)
    assert moved and min(moved.values()) > 1


def test_ids_found_by_bitmaps(spark):
    rows = spark.range(100_000).withColumn("id", F.when(F.col("id") != 5, F.col("id")))
    wanted = spark.createDataFrame([(i,) for i in [*range(0, 100_000, 37), None]], "rep long")
    found = [r.id for r in ngram_join.with_id_among(rows, "id", wanted, "rep").collect()]
    assert {r.rep for r in wanted.collect()} <= set(found)
    assert len(found) < wanted.count() + 0.02 * rows.count()
    nothing = ngram_join.with_id_among(rows, "id", wanted.limit(0), "rep")
    assert nothing.columns == ["id"] and not nothing.count()


@pytest.mark.parametrize("num,den", [(85, 100), (80, 100), (1, 2), (1, 1)])
def test_sizes_alike_are_in_neighbouring_bands(spark, num, den):
    bands = dict(spark.range(1, 5000).select("id", ngram_join.size_band(F.col("id"), num, den)).collect())
    for n in bands:  # the bands rise with the sizes, so the largest tells
        assert abs(bands[min(n * den // num, 4999)] - bands[n]) <= 1


def test_representatives(awkward, texts):
    kept = Counter(r.doc_id for r in ngram_join.representatives(awkward).collect())
    assert kept[3] == 1 and not kept[40] and not kept[41] and not kept[42]
    assert kept[4] == kept[9] == kept[44] == kept[45] == 1 and kept[None] == 2


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 30)] + [(100, 50), (50, 77), (5, 5)]
    found = dict(graph.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {i: 0 for i in range(31)} | {100: 50, 50: 50, 77: 50}


def test_components_start_few_jobs(spark):
    """Each job takes memory of the driver, whatever its size."""
    links = spark.createDataFrame([(i % 7, i) for i in range(7, 300)], "a long, b long")
    context = spark.sparkContext
    context.setJobGroup("stars", "components of stars")
    try:
        found = graph.components(links)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    jobs = len(context.statusTracker().getJobIdsForGroup("stars"))
    assert dict(found.collect()) == {i: i % 7 for i in range(300)}
    assert 0 < jobs <= 10, jobs


def test_line_dedup(docs, awkward, texts):
    found = {r.doc_id: r for r in line_dedup.aligned_lines(docs).collect()}
    assert len(found) == len(texts) and found[3]["__deleted"] is None
    lines = texts[3].split("\n")
    assert found[40]["__deleted"] == list(range(len(lines)))
    kept = {r.doc_id: r.text for r in line_dedup.dedup(docs).collect()}
    assert 40 not in kept and kept[3] == texts[3] and kept[45] is None and kept[44] == ""
    # A kept line of at least min_words words is in no earlier document.
    first: dict[str, int] = {}
    for i in sorted(texts):
        for line in (texts[i] or "").split("\n"):
            first.setdefault(line.strip(" \t\r\x0b\x0c"), i)
    for i, text in kept.items():
        for line in (text or "").split("\n"):
            if len(line.split()) >= 6:
                assert first[line.strip(" \t\r\x0b\x0c")] == i or i in (41, 42, 43)
    assert line_dedup.aligned_lines(awkward).count() == awkward.count()


def test_line_dedup_equals_all_pairs(spark):
    rng = random.Random(3)
    passage = "one passage that many later documents hold once"
    rows = {
        0: f"{passage}\nsome other line of six words\n{passage}",  # repeats it: no anchor
        1: f"a b\n{passage}\nc d",
        2: f"e f\n{passage}\ng h",
        3: "first small\nalone", 4: "apart\nsecond small", 5: "third small\nhere",
        6: "x\nfirst small\nsecond small\nthird small\ny", 7: "z\nfirst small\nsecond small\nthird small\nv",
    }
    pool = [f"line {i} of six words {i}" for i in range(6)] + ["a b c", "d e f", "g", "", "  "]
    for i in range(8, 60):
        rows[i] = "\n".join(rng.choices(pool, k=rng.randint(1, 9)))
    lines = {i: [x.strip() for x in t.split("\n")] for i, t in rows.items()}
    expected = {}
    for i in rows:
        words = [len(x.split()) for x in lines[i]]
        every = [line_dedup.common_blocks(lines[i], lines[j], words, 6) for j in range(i)]
        expected[i] = sorted({k for gone in every for k in gone})
    found = line_dedup.aligned_lines(docs_of(spark, rows).repartition(3)).collect()
    assert {r.doc_id: r["__deleted"] or [] for r in found} == expected
    assert expected[2] == [1] and expected[7] == [1, 2, 3]


def test_patience_aligns_moved_and_repeated_lines():
    a, b = [1, 2, 3, 9, 4, 5, 9], [7, 2, 3, 4, 9, 5, 8]
    pairs = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(set(pairs))
    assert [i for i, _ in pairs][:2] == [1, 2] and (5, 5) in pairs
    assert line_dedup.common_blocks([1, 2, 3], [0, 1, 2], [3, 3, 9], 6) == [0, 1]
    assert line_dedup.common_blocks([1, 2, 3], [0, 1, 2], [3, 2, 9], 6) == []


def test_spotsigs(docs, awkward, texts):
    found = {r.doc_id: r for r in spotsigs.compare_edited(docs).collect()}
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        text, after = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        sets = [set(x.split()) for x in (found[i].fingerprint, found[i].edited_fingerprint)]
        union = len(sets[0] | sets[1])
        assert found[i].near_edited == pytest.approx(len(sets[0] & sets[1]) / union if union else 1.0)
    assert found[3].fingerprint == found[40].fingerprint and found[44].fingerprint == ""
    assert spotsigs.compare_edited(awkward).count() == awkward.count()
    members, links = spotsigs.near_pairs(spotsigs.fingerprints(docs), threshold=0.7)
    of = {r.doc_id: r["class"] for r in members.collect()}
    pairs = {(r.a, r.b) for r in links.collect()}
    expected = set()
    for i in texts:
        for j in texts:
            a, b = set(found[i].fingerprint.split()), set(found[j].fingerprint.split())
            if of[i] < of[j] and a and b and len(a & b) >= 0.7 * len(a | b):
                expected.add((of[i], of[j]))
    assert pairs == expected and pairs


def test_ppm_counts_and_scores(docs, awkward, texts):
    import zlib

    tokens = {i: (t or "").encode().lower().split() for i, t in texts.items()}
    training = [i for i in texts if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(w for i in training for w in tokens[i])
    total = sum(counts.values()) + len(training)
    scale = total + 0.1 * (len(counts) + 2)
    for hot in (1 << 18, 4):
        rows = ppm.score(docs, hot_words=hot).collect()
        assert len(rows) == len(texts)
        for r in rows:
            base = sum(math.log10((counts[w] + 0.1) / scale) for w in tokens[r.doc_id])
            base += math.log10((len(training) + 0.1) / scale)
            assert r.base_score == pytest.approx(base) and r.train_tokens == total
            assert r.n_tokens == len(tokens[r.doc_id]) + 1
            assert r.n_known == sum(w in counts for w in tokens[r.doc_id]) + 1
            assert r.held_out == (r.doc_id not in training) and r.score < 0
    assert ppm.score(awkward, max_cells=50).count() == awkward.count()


def test_ppm_spells_a_distribution():
    """Behind any context the probabilities of all 256 bytes sum to one."""
    text = ppm.MARK * ppm.ORDER + b"the other there; then the ratio of the other bathes " + ppm.MARK
    seen, counts = np.unique(ppm.grams_of([text])[0], return_counts=True)
    pairs = np.bincount(seen & 0xFFFF, counts, 65_536)
    short = ppm.short_levels(pairs)
    for context in (b"n the", b"zzthe", b"zzzhe"):
        every = (int.from_bytes(context, "big") << 8) + np.arange(256)
        alike = seen[(seen >> 8) & 0xFFFF == int.from_bytes(context[-2:], "big")]
        grams = np.union1d(every, alike)
        known = np.isin(grams, seen)
        times = np.zeros(len(grams))
        times[known] = counts[np.searchsorted(seen, grams[known])]
        cost = ppm.gram_costs(grams, times, short)
        assert (10 ** cost[np.isin(grams, every)]).sum() == pytest.approx(1)


def test_ppm_scores_the_order_of_words(spark):
    rows = {i: "one two three four five six" for i in range(30)} | {100: "six five four three two one"}
    found = {r.doc_id: r.score for r in ppm.score(docs_of(spark, rows)).collect()}
    assert found[100] < found[1] - 5


def test_ppm_equals_brute_force_over_the_bytes(spark, docs, texts):
    import zlib

    swapped = {**texts, 60: "the other one is there", 61: "there is one other the"}
    rows = docs_of(spark, swapped).repartition(3)
    data = {i: b"\xff" * 5 + (t or "").encode() + b"\xff" for i, t in swapped.items()}
    followers: dict[bytes, Counter[int]] = {}
    for i, d in data.items():
        if zlib.crc32(str(i).encode()) % 10:
            for p in range(5, len(d)):
                for order in range(6):
                    followers.setdefault(d[p - order : p], Counter())[d[p]] += 1

    def cost(context: bytes, symbol: int) -> float:
        gone, found = set(), 0.0
        for order in range(5, -1, -1):
            here = followers.get(context[5 - order :], {})
            left = {s: n for s, n in here.items() if s not in gone}
            mass = sum(left.values()) + len(left)
            if symbol in left:
                return found + math.log10(left[symbol] / mass)
            found += math.log10(len(left) / mass) if left else 0
            gone = set(here) or gone
        return found - math.log10(256 - len(gone))

    expected = {i: sum(cost(d[p - 5 : p], d[p]) for p in range(5, len(d))) for i, d in data.items()}
    for limits in ({}, {"hot_words": 4, "max_cells": 50}):
        found = {r.doc_id: r.score for r in ppm.score(rows, **limits).collect()}
        assert found == pytest.approx(expected)
    assert found[60] != pytest.approx(found[61])


def test_mixing_meets_targets(spark, docs, awkward, texts):
    rows = mixing.mix(awkward).collect()
    assert len(rows) == awkward.count()
    again = mixing.mix(awkward.repartition(5)).collect()
    shape = lambda rows: sorted((str(r.doc_id), r["__size"], r["__taken"]) for r in rows)
    assert Counter(x[0] for x in shape(rows)) == Counter(x[0] for x in shape(again))
    by: dict = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
        assert r["__size"] == len((r.text or "").encode().split()) and r["__taken"] <= 3 * r["__size"]
    sizes = [sum(r["__size"] for r in by[s]) for s in sorted(by)]
    targets = [by[s][0]["__target"] for s in sorted(by)]
    assert sum(targets) == pytest.approx(sum(sizes))
    for s, target in zip(sorted(by), targets, strict=True):
        assert abs(sum(r["__taken"] for r in by[s]) - target) <= 0.5
    open_ = [t / w for t, w, n in zip(targets, (1, 2, 3), sizes, strict=True) if t < 3 * n - 1e-6]
    assert max(open_) == pytest.approx(min(open_))
    words = Counter()
    for r in mixing.mixed(awkward).collect():
        words[r.source] += len(r.text.encode().split())
    assert words == {s: sum(r["__taken"] for r in by[s]) for s in by}


def test_mixing_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 4)
    rows = [(i, "w " * (i % 7), "en", None if i % 2 else "a", 0.0, "", 0) for i in range(300)]
    found = mixing.mix(spark.createDataFrame(rows, SCHEMA), cap=1.4).collect()
    for source in ("a", None):
        mine = [r for r in found if r.source == source]
        assert abs(sum(r["__taken"] for r in mine) - mine[0]["__target"]) <= 0.5


def test_licences(docs, spark):
    mit = licences.KNOWN_TEXTS["MIT"]
    rows = {
        1: "Copyright (c) 2020 Some One\n\n" + mit.replace("sublicense", "sub­license"),
        2: "copyright 1999 A\n# Copyright (C) 2001 B\n" + mit.upper(),
        3: "text\nReleased under the MIT Licence!\nmore", 4: None, 5: mit[:-20],
    }
    found = {r.doc_id: r for r in licences.scan(docs_of(spark, rows)).collect()}
    assert [found[i].licence for i in rows] == [None, "MIT", None, None, None]
    assert found[3].line_licences == "MIT" and found[4].line_licences == ""
    assert licences.scan(docs).count() == docs.count()


def test_licences_of_whole_texts_headings_and_notices(spark, tmp_path):
    from strata.llm.licence_texts import FOLDER

    with open(f"{FOLDER}/Apache-2.0.txt") as f:
        apache = f.read()
    with open(f"{FOLDER}/GPL-2.0.txt") as f:
        gpl = f.read()
    (tmp_path / "House-1.0.txt").write_text("Use it in our house.")
    mit = licences.KNOWN_TEXTS["MIT"]
    rows = {
        1: apache, 2: apache.split("APPENDIX:")[0], 3: gpl,
        4: "The MIT License (MIT)\n\nCopyright (c) 2020 A\n" + mit,
        5: "licensed under the GNU General Public License, version 2",
        6: "Released under the Apache License", 7: "use it in OUR house",
    }
    found = {r.doc_id: r.licence for r in licences.scan(docs_of(spark, rows), folder=str(tmp_path)).collect()}
    assert found == {
        1: "Apache-2.0", 2: "Apache-2.0", 3: "GPL-2.0", 4: "MIT", 5: "GPL-2.0", 6: "Apache", 7: "House-1.0"
    }


def test_forest_recall_and_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    data = rng.standard_normal((1500, 32))
    data[1] = data[0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(data)]
    rows += [(2000, None), (2001, [0.0] * 32), (2002, [float("nan")] * 32), (2003, [1.0, None] * 16), (None, [1.0] * 32)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann_forest.search(vectors, vectors.where("vec_id % 50 = 0")).collect()
    unit = data / np.linalg.norm(data, axis=1)[:, None]
    hits = 0
    for q in range(0, 1500, 50):
        mine = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        cosine = unit @ unit[q]
        cosine[q] = -2
        assert all(abs(cosine[m[1]] - m[2]) < 1e-9 for m in mine)
        hits += len({m[1] for m in mine} & set(np.argsort(-cosine)[:5].tolist()))
    assert hits / 150 >= 0.9
    assert not any(r.query_id == 2000 or r.vec_id >= 2000 for r in found)
    assert next(r.vec_id for r in found if r.query_id == 0 and r.rank == 1) == 1


def test_forest_searches_every_length(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(2 + i % 3)]) for i in range(60)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann_forest.search(vectors, vectors, k=3).collect()
    assert Counter(r.query_id for r in found) == {i: 3 for i in range(60)}
    assert all(r.query_id % 3 == r.vec_id % 3 for r in found)


def test_toxicity(spark):
    rng = random.Random(4)
    texts = {i: prose(i, 80) + (" idiot scum" if i % 5 == 0 else "") for i in range(400)}
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in texts if rng.random() < 0.6] + [(None, 1)], "doc_id long, toxic int")
    docs = docs_of(spark, texts, [(None, "what an idiot, you scum"), (1000, None), (7, texts[7])])
    model = toxicity.fit(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == 403 and all(0 <= r.score <= 1 for r in rows)
    toxic = {r.doc_id for r in rows if r.predicted}
    assert toxic == {i for i in texts if i % 5 == 0} | {None}
    assert all(e.label == 1 and e.id != r.doc_id for r in rows if r.doc_id in toxic for e in r.evidence[:1])
    kept = toxicity.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == 403 - 81


def test_block_max_search_is_exact():
    rng = random.Random(6)
    vectors = []
    for _ in range(300):
        v = {rng.randrange(20): rng.random() for _ in range(4)}
        norm = sum(x * x for x in v.values()) ** 0.5
        vectors.append({t: x / norm for t, x in v.items()})
    index = toxicity.BlockMaxIndex(vectors, 20)
    for q in vectors[:40]:
        every = [(sum(w * v.get(t, 0) for t, w in q.items()), i) for i, v in enumerate(vectors)]
        best = sorted((x for x in every if x[0] > 0), key=lambda x: (-round(x[0], 9), x[1]))[:7]
        found = index.nearest(q, 7)
        assert [round(s, 9) for s, _ in found] == [round(s, 9) for s, _ in best]


def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, folder)
        assert found.columns == docs.columns, name
        docs = spark.createDataFrame(found.toPandas(), docs.schema)
        assert docs.count() > 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_pipeline_keeps_the_decoded_texts(spark):
    import corpus_pipeline

    found = corpus_pipeline.encode_texts(spark, docs_of(spark, {1: "some text", 2: ""}), "").collect()
    assert {r.doc_id: r.decoded for r in found} == {1: "some text", 2: ""}
