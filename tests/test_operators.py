from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strata.functions.casts import safe_cast
from strata.operators.dedup import deduplicate, with_group_size
from strata.operators.flatten import flatten_payload
from strata.operators.joins import (
    constant_lookup,
    orphans,
    resolve_key,
    with_exists_flag,
)
from strata.operators.quality import (
    DataQualityChecker,
    add_dq_columns,
    apply_rules,
    issue_breakdown,
    issues_by_check,
    summarize,
)
from strata.operators.sets import common_column_union, missing_values, union_all
from strata.operators.shaping import add_metadata_columns, conform, select_available
from strata.specs.bronze import payload_schema
from strata.specs.rules import load_rules, rules_for


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- deduplication ----------------------------------------------------------------------


def test_deduplicate_newest_with_null_order_and_ties(spark):
    data = [
        ("a", 1, "old"), ("a", 2, "new"),
        ("b", 2, "z"), ("b", 2, "y"),
        ("c", None, "none"), ("c", 0, "zero"),
        ("d", None, "only"),
        (None, 1, "k1"), (None, 2, "k2"),
    ]
    df = spark.createDataFrame(data, "k string, t int, v string")
    got = {r.k: r.v for r in deduplicate(df, ["k"], "t").collect()}
    assert got == {"a": "new", "b": "y", "c": "zero", "d": "only", None: "k2"}


def test_dedup_that_keeps_null_keys_reads_its_input_once(spark, plan, tmp_path):
    spark.range(9).selectExpr("if(id > 5, null, id % 2) AS k", "id AS t").write.parquet(str(tmp_path / "in"))
    got = deduplicate(spark.read.parquet(str(tmp_path / "in")), ["k"], "t", keep_null_keys=True)
    text = plan(got)
    assert rows(got) == sorted([(0, 4), (1, 5), (None, 6), (None, 7), (None, 8)], key=repr)
    # One scan, one shuffle, and the first rows are picked before it as well.
    assert (text.count("FileScan"), text.count("Exchange"), text.count("WindowGroupLimit")) == (1, 1, 2)


def test_deduplicate_can_keep_all_rows_without_a_key(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), (None, 1), (None, 1), (None, 3)], "k string, t int"
    )
    got = rows(deduplicate(df, ["k"], "t", keep_null_keys=True))
    assert got == rows(spark.createDataFrame([("a", 2), (None, 1), (None, 1), (None, 3)], "k string, t int"))


def test_deduplicate_ascending_takes_null_first(spark):
    df = spark.createDataFrame([("a", None), ("a", "x")], "k string, n string")
    assert deduplicate(df, ["k"], "n", ascending=True).first().n is None


def test_deduplicate_does_not_depend_on_partitioning(spark):
    rng = random.Random(5)
    data = [(rng.randrange(40), rng.randrange(3), rng.randrange(1000)) for _ in range(3000)]
    df = spark.createDataFrame(data, "k int, t int, v int")
    results = [rows(deduplicate(df.repartition(n), ["k"], "t")) for n in (1, 3, 11)]
    best = {}
    for k, t, v in data:
        best[k] = min(best.get(k, (9, 9)), (-t, v))
    assert results[0] == results[1] == results[2]
    assert results[0] == sorted(((k, -t, v) for k, (t, v) in best.items()), key=repr)


def test_deduplicate_limits_groups_before_the_shuffle(spark, plan):
    df = spark.range(10).selectExpr("id % 2 AS k", "id AS t")
    text = plan(deduplicate(df, ["k"], "t"))
    before = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before


def test_deduplicate_needs_an_order(spark):
    df = spark.createDataFrame([(1, {"a": 1})], "k int, m map<string,int>")
    with pytest.raises(ValueError, match="missing"):
        deduplicate(df, ["k"])
    with pytest.raises(ValueError, match="no order"):
        deduplicate(df, ["k"], "k")


def test_group_size_with_hot_and_null_keys(spark):
    keys = ["hot"] * 500 + [None] * 3 + ["single"]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    got = with_group_size(df, ["k"], "n").groupBy("k", "n").count()
    assert rows(got) == sorted([("hot", 500, 500), (None, 3, 3), ("single", 1, 1)], key=repr)


# --- quality ----------------------------------------------------------------------------


def test_checks_keep_order_and_null_passes(spark):
    df = spark.createDataFrame(
        [(1, None, -1, "x"), (2, "n", 0, None), (3, "n", None, "a"), (4, None, 5, "a")],
        "id int, name string, amount int, code string",
    )
    checked = (
        DataQualityChecker(df)
        .check_in_set("code", ["a"])
        .check_not_null("name", "missing_name")
        .check_positive("amount")
        .apply()
    )
    got = {r.id: (r._is_valid, r._dq_issues) for r in checked.collect()}
    assert got == {
        1: (False, "invalid_code; missing_name; non_positive_amount"),
        2: (True, ""),
        3: (True, ""),
        4: (False, "missing_name"),
    }


def test_no_checks_means_valid_and_null_issues(spark):
    row = add_dq_columns(spark.range(1), []).first()
    assert row._is_valid is True and row._dq_issues is None


def test_date_range_bounds_are_inclusive(spark):
    days = ["1899-12-31", "1900-01-01", "2100-12-31", "2101-01-01", None]
    df = spark.createDataFrame([(d,) for d in days], "d string").selectExpr("cast(d as date) d")
    got = [r._is_valid for r in DataQualityChecker(df).check_date_range("d").apply().collect()]
    assert got == [False, True, True, False, True]


def test_regex_range_and_cross_field(spark):
    df = spark.createDataFrame(
        [("12345", 5, 6), ("1234", 11, 6), (None, None, 6)], "z string, a int, b int"
    )
    checker = DataQualityChecker(df).check_regex("z", r"^\d{5}$").check_range("a", 0, 10)
    got = [r._dq_issues for r in checker.check_less_than_or_equal("a", "b").apply().collect()]
    assert got == ["", "pattern_z; range_a; a_exceeds_b", ""]


def test_two_uniqueness_checks_do_not_disturb_each_other(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (3, "z")], "a int, b string")
    checker = DataQualityChecker(df).check_unique(["a"]).check_unique(["b"])
    checked = checker.apply()
    assert checked.columns == ["a", "b", "_is_valid", "_dq_issues"]
    got = {(r.a, r.b): r._dq_issues for r in checked.collect()}
    assert got == {
        (1, "x"): "duplicate_a; duplicate_b",
        (1, "y"): "duplicate_a",
        (2, "x"): "duplicate_b",
        (3, "z"): "",
    }


def test_integrity_with_one_name_on_both_sides_and_two_checks(spark):
    df = spark.createDataFrame([("p1", "a"), ("p9", "a"), (None, "b")], "policy string, agent string")
    policies = spark.createDataFrame([("p1",), ("p1",), (None,)], "policy string")
    agents = spark.createDataFrame([("a",)], "agent string")
    checker = DataQualityChecker(df)
    checker.check_referential_integrity("policy", policies, "policy")
    checker.check_referential_integrity("agent", agents, "agent")
    checked = checker.apply()
    assert checked.columns == ["policy", "agent", "_is_valid", "_dq_issues"]
    got = {r.policy: r._dq_issues for r in checked.collect()}
    assert got == {"p1": "", "p9": "orphan_policy", None: "orphan_policy; orphan_agent"}
    lenient = DataQualityChecker(df).check_referential_integrity(
        "policy", policies, "policy", allow_null=True
    )
    assert {r.policy: r._is_valid for r in lenient.apply().collect()} == {
        "p1": True, "p9": False, None: True,
    }


def test_summary_and_breakdowns(spark):
    df = spark.createDataFrame([(1, -1), (None, -1), (2, 1)], "a int, b int")
    checked = DataQualityChecker(df).check_not_null("a").check_positive("b").apply()
    assert tuple(summarize(checked).first()) == (3, 1, 2, 33.33)
    assert rows(issue_breakdown(checked)) == [
        ("non_positive_b", 1), ("null_a; non_positive_b", 1),
    ]
    assert rows(issues_by_check(checked)) == [("non_positive_b", 2), ("null_a", 1)]
    empty = DataQualityChecker(df.filter("a > 9")).check_not_null("a").get_summary()
    assert tuple(empty.first()) == (0, 0, 0, 0.0)


def test_rules_file_and_unknown_rules(spark):
    rules = load_rules()
    names = [r["name"] for r in rules_for("auto_claims", ["policy_id", "claim_id"], rules)]
    assert names[0] == "policy_id_not_null" and "effective_date_valid" not in names
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="unknown column"):
        apply_rules(df, [{"name": "x", "column": "b", "type": "not_null"}])
    with pytest.raises(ValueError, match="unknown type"):
        apply_rules(df, [{"name": "x", "column": "a", "type": "odd"}])


# --- joins ------------------------------------------------------------------------------


def test_resolve_key_unmatched_null_and_absent(spark):
    df = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "k string, i int")
    lookup = spark.createDataFrame([("a", "A"), (None, "N")], "code string, key string")
    for spread in ((), ("i",)):
        got = resolve_key(df, "k", lookup, "code", ["key"], spread_nulls=spread)
        assert rows(got) == sorted([("a", 1, "A"), ("z", 2, None), (None, 3, None)], key=repr)
    absent = resolve_key(df, "k", None, "code", ["key"])
    assert absent.schema["key"].dataType.simpleString() == "string"
    assert {r.key for r in absent.collect()} == {None}


def test_resolve_key_rejects_a_repeated_lookup_key(spark):
    df = spark.createDataFrame([("a",)], "k string")
    lookup = spark.createDataFrame([("a", 1), ("a", 2)], "code string, key int")
    with pytest.raises(PySparkException, match="not unique"):
        resolve_key(df, "k", lookup, "code", ["key"]).collect()


def test_null_keys_are_spread_over_partitions(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(4000).selectExpr("id", "cast(null as string) AS k")
        lookup = spark.createDataFrame([("a", "A")], "code string, key string")
        joined = resolve_key(df, "k", lookup, "code", ["key"], False, ["id"])
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_constant_lookup_is_bounded(spark):
    df = spark.createDataFrame([("TX",), ("??",)], "s string")
    got = constant_lookup(df, "s", [("TX", "Texas")], "name")
    assert rows(got) == [("??", None), ("TX", "Texas")]
    with pytest.raises(ValueError, match="literal rows"):
        constant_lookup(df, "s", [(str(i), "x") for i in range(2000)], "name")


def test_orphans_and_exists_flag(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    refs = spark.createDataFrame([("a",), (None,)], "r string")
    assert rows(orphans(df, "k", refs, "r")) == [("b",)]
    assert rows(orphans(df, "k", refs, "r", allow_null=False)) == [("b",), (None,)]
    flags = with_exists_flag(df, "k", refs, "r", "known")
    assert {r.k: r.known for r in flags.collect()} == {"a": True, "b": False, None: False}


# --- sets and shaping -------------------------------------------------------------------


def test_union_all_skips_absent(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    assert rows(union_all([None, a, None, b])) == [(1, "x"), (2, "y")]
    assert union_all([None]) is None


def test_common_column_union_keeps_order_and_text(spark):
    left = spark.createDataFrame([("007", "N/A", 1)], "id string, amount string, extra int")
    right = spark.createDataFrame([(2.5, "008")], "amount double, id string")
    both = common_column_union(left, None, right)
    assert both.columns == ["id", "amount"]
    assert rows(both) == [("007", "N/A"), ("008", "2.5")]
    with pytest.raises(ValueError, match="no column"):
        common_column_union(left, spark.range(1).toDF("other"))
    assert common_column_union(None) is None


def test_missing_values(spark):
    df = spark.createDataFrame([("PROP",), (None,)], "lob string")
    assert rows(missing_values(df, "lob", ["PROP", "WC"])) == [("WC",)]


def test_conform_and_select_available(spark):
    df = spark.createDataFrame([("x", "12")], "b string, a string")
    out = conform(df, "a int, c date, b string")
    assert out.schema.simpleString() == "struct<a:int,c:date,b:string>"
    assert tuple(out.first()) == (12, None, "x")
    assert select_available(df, ["z", "a", "b"]).columns == ["a", "b"]


def test_metadata_columns(spark):
    df = add_metadata_columns(spark.range(2), "f", "csv", "b1", datetime(2024, 1, 2))
    assert df.columns[-4:] == [
        "_ingestion_timestamp", "_source_file", "_source_format", "_batch_id",
    ]
    assert {r._batch_id for r in df.collect()} == {"b1"}
    one_batch = {r._batch_id for r in add_metadata_columns(spark.range(3)).collect()}
    assert len(one_batch) == 1 and None not in one_batch


def test_flatten_keeps_rows_without_claims(spark):
    data = [
        ("p1", "n1", {"employer_name": "E"}, {}, [{"claim_id": "c1"}, {"claim_id": "c2"}], []),
        ("p2", "n2", None, {}, [], []),
        ("p3", "n3", {}, {}, None, []),
    ]
    df = spark.createDataFrame(data, payload_schema("workers_comp"))
    flat = flatten_payload(
        df,
        {"policy_id": "policy_id", "employer_name": "employer_info.employer_name"},
        "claims",
        {"claim_id": "claim_id", "missing": "nothing"},
    )
    assert rows(flat) == [
        ("p1", "E", "c1", None), ("p1", "E", "c2", None),
        ("p2", None, None, None), ("p3", None, None, None),
    ]
    assert flatten_payload(df, {"id": "policy_id"}).count() == 3


def test_checks_and_casts_of_malformed_text(spark):
    df = spark.createDataFrame([("3.0", "x"), ("2.7", "-5"), ("1e30", "7"), ("-1.", "2020-13-01")], "a string, b string")
    whole = [r[0] for r in df.select(safe_cast(F.col("a"), "int")).collect()]
    assert whole == [3, 2, None, -1]
    checked = DataQualityChecker(df).check_positive("b").check_range("b", 0, 9).check_date_range("b")
    assert checked.apply().count() == 4


def test_exists_flag_spreads_rows_without_a_value(spark):
    df = spark.range(4000).selectExpr("id", "if(id % 4 > 0, null, id % 40) AS k")
    reference = spark.createDataFrame([(0,), (8,), (None,), (8,)], "r bigint")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        flagged = with_exists_flag(df, "k", reference, "r", "hit")
        sizes = [r["count"] for r in flagged.groupBy(F.spark_partition_id()).count().collect()]
        hits = {r.id for r in flagged.where("hit").collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    # Three rows in four have no value, and four partitions share them.
    assert len(sizes) == 4 and max(sizes) < 2000
    assert hits == {i for i in range(4000) if i % 4 == 0 and i % 40 in (0, 8)}
    assert flagged.where("hit IS NULL").count() == 0 and flagged.columns == ["id", "k", "hit"]
