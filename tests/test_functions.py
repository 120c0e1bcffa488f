from __future__ import annotations

import hashlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions.casts import guarded_ratio, safe_cast, share
from strata.functions.keys import (
    content_id,
    date_to_key,
    foreign_key,
    generate_surrogate_key,
    key_to_date,
    murmur_bucket,
    stable_bucket,
    stable_label,
)
from strata.functions.names import snake_case, standardize_column_names


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("dateOfLoss", "date_of_loss"),
        ("amountPaidOnBuildingClaim", "amount_paid_on_building_claim"),
        ("reportedZipCode", "reported_zip_code"),
        ("numberOfFloorsInTheInsuredBuilding", "number_of_floors_in_the_insured_building"),
        ("policyEffectiveDate", "policy_effective_date"),
        ("totalBuildingInsuranceCoverage", "total_building_insurance_coverage"),
        ("originalNBDate", "original_nb_date"),
        ("policy_id", "policy_id"),
        ("claim_status", "claim_status"),
        ("date_of_loss", "date_of_loss"),
        ("Paid Amount ($)", "paid_amount"),
        ("a--b..c", "a_b_c"),
        ("_ingestion_timestamp", "_ingestion_timestamp"),
    ],
)
def test_snake_case(name, expected):
    assert snake_case(name) == expected


def test_name_collision_raises(spark):
    with pytest.raises(ValueError, match="collide"):
        standardize_column_names(spark.createDataFrame([(1, 2)], "dateOfLoss int, date_of_loss int"))


def test_surrogate_key_keeps_null_and_empty_apart(spark):
    rows = spark.createDataFrame([("a", None), ("a", ""), ("a||b", "c")], "x string, y string")
    keys = [r.k for r in generate_surrogate_key(rows, "x", "y", key_name="k").collect()]
    assert keys == [md5("a||__NULL__"), md5("a||"), md5("a||b||c")]


def test_separator_collision_is_a_known_limit(spark):
    rows = spark.createDataFrame([("a", "b||c"), ("a||b", "c")], "x string, y string")
    keys = {r.k for r in generate_surrogate_key(rows, "x", "y", key_name="k").collect()}
    assert len(keys) == 1


def test_foreign_key_and_content_id(spark):
    rows = spark.createDataFrame([("x",), (None,)], "a string")
    got = rows.select(foreign_key("a").alias("f"), content_id("a", F.lit(1)).alias("c")).collect()
    assert [(r.f, r.c) for r in got] == [(md5("x"), md5("x||1")), (None, md5("||1"))]


def test_date_keys(spark):
    rows = spark.createDataFrame([(date(2024, 2, 29),), (None,)], "d date")
    keyed = rows.select("d", date_to_key("d").alias("k"))
    back = keyed.select("d", "k", key_to_date("k").alias("b")).collect()
    assert [(r.k, r.b) for r in back] == [(20240229, date(2024, 2, 29)), (None, None)]


def test_buckets_and_labels(spark):
    rows = spark.range(200).select(F.col("id").cast("string").alias("k"))
    got = rows.select(
        "k",
        stable_bucket("k", 3).alias("b"),
        murmur_bucket("k", 3).alias("m"),
        stable_label("k", ["x", "y", "z"]).alias("l"),
    ).collect()
    for r in got:
        assert r.b == int(md5(r.k)[:8], 16) % 3
        assert 0 <= r.m < 3
        assert r.l == "xyz"[r.b]
    none = spark.createDataFrame([(None,)], "k string").select(stable_label("k", ["x"]).alias("l"))
    assert none.first().l is None


def test_safe_cast_gives_null_for_malformed_text(spark):
    texts = ["N/A", "", " 12.50 ", "1e3", None, "12345678901234567.00", "1.005"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in rows.select(safe_cast(F.col("t"), "decimal(18,2)")).collect()]
    expected = [None, None, "12.50", "1000.00", None, None, "1.01"]
    assert got == [None if e is None else Decimal(e) for e in expected]


def test_safe_cast_of_dates_flags_and_text(spark):
    rows = spark.createDataFrame(
        [(" 2024-01-05 ", "yes", " tx "), ("05/01/2024", "maybe", "")], "d string, b string, s string"
    )
    got = rows.select(
        safe_cast(F.col("d"), "date").alias("d"),
        safe_cast(F.col("b"), "boolean").alias("b"),
        safe_cast(F.col("s"), "string", upper=True).alias("s"),
    ).collect()
    assert [tuple(r) for r in got] == [(date(2024, 1, 5), True, "TX"), (None, None, "")]


def test_share_rounds_half_up_in_decimal(spark):
    rows = spark.createDataFrame([(Decimal("0.10"),), (Decimal("1.23"),)], "p decimal(18,2)")
    got = [r[0] for r in rows.select(share(F.col("p"), "0.15")).collect()]
    assert got == [Decimal("0.02"), Decimal("0.18")]


def test_guarded_ratio(spark):
    data = [("1.00", "3.00"), ("1.00", "0.00"), ("1.00", None), (None, "2.00"), ("1.00", "-1.00")]
    rows = spark.createDataFrame(
        [tuple(None if x is None else Decimal(x) for x in r) for r in data],
        "a decimal(28,2), b decimal(28,2)",
    )
    got = [r[0] for r in rows.select(guarded_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("0.3333"), None, None, None, None]
