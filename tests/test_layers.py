from __future__ import annotations

import hashlib
import os
import re
import time
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.plans import dimensions as dims
from strata.plans import facts, reports
from strata.plans.mart import claims_rollup, mart_policy_360
from strata.plans.pipeline import (
    GOLD_INPUTS,
    build_mart,
    mart_slices,
    run_pipeline,
    silver_tables,
    staged_mart,
)
from strata.plans.silver import build_line, build_silver
from strata.plans.validation import assert_valid, validate_mart
from strata.session import REMOVE_SHUFFLES, remove_folder, scratch_path, shuffles_removed
from strata.specs.bronze import (
    PAYLOAD_DDL,
    flat_columns,
    flat_schema,
    flood_schema,
    payload_schema,
    split_flat,
)
from strata.specs.gold import GOLD_DDL, gold_schema
from strata.specs.lines import (
    AUTO,
    GENERAL_LIABILITY,
    LINES,
    LINES_WITH_PROFESSIONAL,
    PROFESSIONAL,
    PROPERTY,
    UMBRELLA,
    WORKERS_COMP,
    silver_specs,
)
from strata.specs.reference import LINES_OF_BUSINESS, PROFESSIONAL_LINE, US_STATES
from strata.workload.raw import BRONZE_TABLES, SharedLines, bronze_frame, land_files

AS_OF = date(2024, 6, 30)
SF = "/root/testdata/sf0.001"
#: Rows of the given tables whose derived feeds are free of the blemishes queries deal with.
CLEAN_ORDERS = " AND ".join(
    [f"o_custkey % {n} <> 0" for n in (29, 31, 37, 41, 43, 47, 53)]
    + [f"o_orderkey % {n} <> 0" for n in (59, 71)]
)
CLEAN_LINES = " AND ".join(
    [f"l_partkey % {n} <> 0" for n in (31, 61, 67, 73)]
    + [f"l_suppkey % {n} <> 0" for n in (23, 37)]
)


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def lake(spark):
    """The whole path: files made of the given tables, Bronze, Silver, Gold, mart."""
    import uuid

    from strata.plans.pipeline import Layers

    landing = scratch_path(spark, "landing")
    clean = scratch_path(spark, "clean")
    spark.read.parquet(f"{SF}/orders.parquet").filter(CLEAN_ORDERS).write.parquet(f"{clean}/orders.parquet")
    spark.read.parquet(f"{SF}/lineitem.parquet").filter(CLEAN_LINES).write.parquet(f"{clean}/lineitem.parquet")
    land_files(spark, clean, landing)
    layers = Layers(spark, f"m{uuid.uuid4().hex[:10]}_", scratch_path(spark, "lake"))
    counts = run_pipeline(layers, AS_OF, landing, batch_id="b", ingested_at=datetime(2024, 1, 1))
    layers.found = {(r.schema_name.split("_")[-1], r.table_name): r.row_count for r in counts.collect()}
    layers.sizes = {
        spec.name: bronze_frame(spark, clean, spec.sources[0]).select(F.trim(spec.key)).distinct().count()
        for spec in silver_specs()
    }
    return layers


# --- declared schemas -------------------------------------------------------------------


def test_silver_schemas_end_with_audit_columns(spark):
    assert len(silver_specs()) == 10
    for spec in silver_specs(LINES_WITH_PROFESSIONAL):
        names = spec.schema.fieldNames()
        assert names[-3:] == ["_is_valid", "_dq_issues", "_ingestion_timestamp"]
        assert not spec.schema[spec.key].nullable
    schema = PROPERTY.policies.schema
    assert schema["effective_date"].dataType == T.DateType()
    assert schema["total_building_coverage"].dataType == T.DecimalType(18, 2)
    assert schema["primary_residence"].dataType == T.BooleanType()


def test_flat_bronze_schemas(spark):
    lines = (WORKERS_COMP, AUTO, GENERAL_LIABILITY, UMBRELLA, PROFESSIONAL)
    for line, width in zip(lines, (29, 33, 31, 26, 23)):
        assert len(flat_columns(line)) == width
        assert {f.dataType for f in flat_schema(line).fields} == {T.StringType()}
    assert len(flood_schema("claims")) == 37 and len(flood_schema("policies")) == 42
    assert {"dateOfLoss", "state", "amountPaidOnBuildingClaim"} <= set(flood_schema("claims").names)
    assert {"underlying_auto_policy_id", "underlying_gl_policy_id"} <= set(flat_columns(UMBRELLA))
    for name in PAYLOAD_DDL:
        assert payload_schema(name).fieldNames()


def test_gold_schemas(spark):
    assert not gold_schema("dim_date")["date_key"].nullable
    assert not gold_schema("fact_claim_transaction")["claim_txn_key"].nullable
    assert {"lob_key", "insured_key", "agent_key", "location_key"} <= set(gold_schema("dim_policy").names)
    assert {"written_premium", "earned_premium", "net_premium"} <= set(gold_schema("fact_premium").names)
    assert len(gold_schema("mart_policy_360")) == 81
    assert len(GOLD_DDL) == 13
    assert len(US_STATES) == 51 and all(c == c.upper() and len(c) == 2 for c, _ in US_STATES)


# --- Silver -----------------------------------------------------------------------------


def stamped(spark, data, columns, when):
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns))
    return df.withColumn("_ingestion_timestamp", F.lit(datetime.fromisoformat(when)))


def test_rows_without_a_key_stay_flagged(spark):
    columns = ["policy_id", "premium_amount"]
    raw = stamped(spark, [("P1", "5"), (None, "7"), ("  ", "7"), (None, "9")], columns, "2024-01-01")
    silver = build_silver(AUTO.policies, [raw])
    assert silver.filter("policy_id IS NULL AND NOT _is_valid").count() == 3
    assert silver.count() == 4


def test_newest_source_wins_and_names_are_normalised(spark):
    csv = stamped(
        spark,
        [(" A-1 ", "2024-01-01", "tx", "10.00"), ("A-2", "bad", None, "-5")],
        ["policyId", "effectiveDate", "propertyState", "premiumAmount"],
        "2024-01-01T00:00:00",
    )
    json = stamped(
        spark, [("A-1", "2024-01-02", " ca", "N/A")],
        ["policy_id", "effective_date", "property_state", "premium_amount"],
        "2024-01-02T00:00:00",
    )
    got = build_silver(PROPERTY.policies, [csv, None, json])
    assert got.schema.fieldNames() == PROPERTY.policies.schema.fieldNames()
    by_id = {r.policy_id: r for r in got.collect()}
    assert set(by_id) == {"A-1", "A-2"}
    first, second = by_id["A-1"], by_id["A-2"]
    assert first.effective_date == date(2024, 1, 2) and first.property_state == "CA"
    assert first.premium_amount is None and first._is_valid
    assert second.effective_date is None
    assert second._dq_issues == "missing_state; non_positive_premium_amount"


def test_derived_silver_columns(spark):
    claims = stamped(
        spark, [("c1", "2023-05-06", None), ("c2", "2023-05-06", "1999")],
        ["claim_id", "date_of_loss", "year_of_loss"], "2024-01-01T00:00:00",
    )
    got = build_silver(PROPERTY.claims, [claims])
    assert {r.claim_id: r.year_of_loss for r in got.collect()} == {"c1": 2023, "c2": 1999}
    comp = stamped(
        spark, [("w1", " Acme ", None), ("w2", None, "Zed")],
        ["policy_id", "employer_name", "insured_name"], "2024-01-01T00:00:00",
    )
    got = build_silver(WORKERS_COMP.policies, [comp])
    names = {r.policy_id: r.insured_name for r in got.collect()}
    assert names == {"w1": "Acme", "w2": "Zed"}
    assert build_silver(PROPERTY.claims, [None]) is None


# --- Gold -------------------------------------------------------------------------------


def test_calendar(spark):
    cal = dims.dim_date(spark)
    assert cal.count() == 24_106
    got = {r.date_key: r for r in cal.filter("date_key in (20240930, 20241001, 20240229)").collect()}
    assert (got[20240930].fiscal_year, got[20240930].fiscal_quarter) == (2024, 4)
    assert (got[20241001].fiscal_year, got[20241001].fiscal_quarter) == (2025, 1)
    leap = got[20240229]
    assert (leap.day_name, leap.day_of_week, leap.is_weekend, leap.quarter) == ("Thursday", 5, False, 1)
    assert (leap.fiscal_quarter, leap.is_holiday) == (2, False)


def test_reference_dimensions(spark):
    lines = {r.lob_code: r.lob_key for r in dims.dim_line_of_business(spark).collect()}
    assert lines["PROP"] == md5("PROP") and len(lines) == 5
    coverages = dims.dim_coverage(spark).collect()
    assert len(coverages) == 18
    for c in coverages:
        assert c.coverage_key == md5(c.coverage_id)
        assert c.lob_key == lines[c.coverage_id.split("-")[1]]
    professions = dims.dim_profession(spark)
    assert professions.count() == 9 * 51
    doctor = professions.filter("profession_id = 'Doctor_TX'").first()
    assert doctor.profession_key == md5("Doctor||TX") and doctor.requires_board_cert


def test_pipeline_tables_and_counts(lake):
    n = lake.sizes
    policies = sum(v for k, v in n.items() if k.endswith("policies"))
    claims = sum(v for k, v in n.items() if k.endswith("claims"))
    found = lake.found
    for table in ("dim_policy", "dim_insured", "fact_premium", "fact_policy_transaction", "mart_policy_360"):
        assert found["gold", table] == policies
    assert found["gold", "dim_claim"] == found["gold", "fact_claim_transaction"] == claims
    for name, count in n.items():
        assert found["silver", name] == count
    assert found["bronze", "property_policies_json"] == n["property_policies"] > 0
    assert ("bronze", "property_fema_claims_csv") not in found


def test_pipeline_mart_is_valid(lake):
    gold = lake.existing("gold", GOLD_INPUTS)
    results = validate_mart(lake.optional("gold", "mart_policy_360"), gold)
    assert results.count() == 10
    assert_valid(results)
    with pytest.raises(AssertionError, match="missing_lines: 1"):
        assert_valid(validate_mart(lake.optional("gold", "mart_policy_360"), gold, ["PROP", "PL"]))


def test_derived_keys_equal_looked_up_keys(lake):
    silver, gold = silver_tables(lake), lake.existing("gold", (*GOLD_INPUTS, "dim_coverage"))
    assert rows(dims.dim_policy(silver)) == rows(dims.dim_policy(silver, lookups=gold))
    by_lookup = facts.fact_premium(
        silver, policies=gold["dim_policy"], coverages=gold["dim_coverage"]
    )
    assert rows(facts.fact_premium(silver)) == rows(by_lookup)
    assert rows(facts.fact_policy_transaction(silver)) == rows(
        facts.fact_policy_transaction(silver, policies=gold["dim_policy"])
    )
    derived = facts.fact_claim_transaction(silver, gold["dim_policy"])
    looked_up = facts.fact_claim_transaction(silver, gold["dim_policy"], claims=gold["dim_claim"])
    assert rows(derived) == rows(looked_up)


def test_absent_lookups_give_typed_null_keys(lake):
    policies = dims.dim_policy(silver_tables(lake), lookups={})
    first = policies.first()
    assert (first.lob_key, first.insured_key, first.agent_key, first.location_key) == (None,) * 4
    assert policies.schema["lob_key"].dataType == T.StringType()
    claims = dims.dim_claim(silver_tables(lake), None)
    assert claims.filter("policy_key IS NOT NULL").count() == 0


def test_premium_amounts(lake):
    fact = lake.optional("gold", "fact_premium")
    assert fact.filter("ceded_premium + net_premium <> written_premium").count() == 0
    assert fact.filter("earned_premium <> written_premium").count() == 0
    wc = fact.filter(F.col("coverage_key") == md5("COV-WC-MED"))
    assert wc.filter("deductible_amount <> 0").count() == 0
    assert wc.filter("location_key IS NOT NULL").count() == 0


def test_claim_amounts_follow_the_line_mapping(lake):
    silver = silver_tables(lake)["workers_comp_claims"]
    fact = lake.optional("gold", "fact_claim_transaction")
    joined = silver.withColumn("claim_key", F.md5("claim_id")).join(
        fact.drop("total_incurred"), "claim_key"
    )
    assert joined.count() == lake.sizes["workers_comp_claims"]
    assert joined.filter("paid_amount <> medical_paid + indemnity_paid").count() == 0
    assert joined.filter("reserve_amount <> total_incurred").count() == 0
    assert joined.filter("is_final_payment <> (claim_status = 'Closed')").count() == 0


def test_mart_is_the_same_when_built_again(lake):
    again = build_mart(lake, AS_OF)
    stored = lake.optional("gold", "mart_policy_360")
    assert again.exceptAll(stored).count() == 0 and again.count() == stored.count()


def test_mart_with_only_policies_keeps_the_contract(lake):
    gold = {"dim_policy": lake.optional("gold", "dim_policy")}
    mart = mart_policy_360(gold, {}, AS_OF)
    assert mart.schema.simpleString() == gold_schema("mart_policy_360").simpleString()
    row = mart.first()
    assert row.premium_line_count == 0 and row.total_claims_count == 0
    assert row.total_written_premium is None and row.loss_ratio is None
    assert row.lob_name is None and row.wc_injury_count is None
    assert mart.count() == gold["dim_policy"].count()
    assert mart_policy_360({}, {}, AS_OF) is None


def test_expiry_and_loss_ratio(lake):
    mart = lake.optional("gold", "mart_policy_360")
    one = mart.filter("expiration_date_key IS NOT NULL").orderBy("policy_id").first()
    end = datetime.strptime(str(one.expiration_date_key), "%Y%m%d").date()
    gold, silver = lake.existing("gold", GOLD_INPUTS), silver_tables(lake)
    for as_of, days, active in ((end, 0, False), (date.fromordinal(end.toordinal() - 1), 1, True)):
        row = mart_policy_360(gold, silver, as_of).filter(F.col("policy_id") == one.policy_id).first()
        assert (row.days_until_expiry, row.is_active) == (days, active)
    assert mart.filter("total_claims_count IS NULL AND loss_ratio IS NOT NULL").count() == 0
    with_claims = mart.filter("total_claims_count > 0").first()
    expected = (with_claims.total_incurred / with_claims.total_written_premium).quantize(Decimal("0.0001"))
    assert abs(with_claims.loss_ratio - expected) <= Decimal("0.0001")


def test_reports(lake, plan):
    mart = lake.optional("gold", "mart_policy_360")
    assert reports.portfolio_summary(mart).count() == 5
    assert reports.premium_by_lob(
        lake.optional("gold", "fact_premium"), lake.optional("gold", "dim_line_of_business")
    ).agg(F.sum("policy_count")).first()[0] == mart.count()
    top = reports.top_paid(mart).collect()
    paid = [r.total_paid_amount for r in top]
    assert len(top) == 10 and paid == sorted(paid, reverse=True)
    assert "TakeOrderedAndProject" in plan(reports.top_paid(mart))
    policy = mart.filter("policy_id LIKE 'AUTO-%'").first().policy_id
    lookup = reports.policy_lookup(mart, policy)
    assert f"EqualTo(policy_id,{policy})" in plan(lookup)
    assert lookup.count() == 1
    assert reports.mart_preview(mart, 10).count() == 10
    silver = silver_tables(lake)
    report = {r.table_name: r.validity_pct for r in reports.validity_report(silver).collect()}
    valid = {n: (df.filter("_is_valid").count(), df.count()) for n, df in silver.items()}
    assert report == {n: pytest.approx(100 * v / total, abs=0.006) for n, (v, total) in valid.items()}
    # Some of the derived rows hold codes that the rules do not know.
    assert {v == total for v, total in valid.values()} == {True, False}
    assert reports.labelled_counts({"b": mart, "a": mart}).first().table_name == "a"


def test_policy_joins_of_the_mart_share_one_shuffle(lake, plan):
    spark = lake.spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(build_mart(lake, AS_OF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    joins = text.count("SortMergeJoin [policy_key#")
    # Insured, premium, claims, claim states, and the attributes of all lines as one.
    assert joins == 5
    # The mart row itself is shuffled by agent, location and once by policy.
    row_shuffles = [x for x in text.splitlines() if "hashpartitioning(__probe#" in x]
    assert len(row_shuffles) == 2
    shuffles = [x for x in text.splitlines() if "hashpartitioning(policy_key#" in x]
    assert len([x for x in shuffles if "claim_key#" not in x]) <= joins


def test_an_insured_of_another_policy_is_refused(lake):
    gold = lake.existing("gold", GOLD_INPUTS)
    other = gold["dim_policy"].withColumn("insured_key", F.md5(F.lit("someone")))
    with pytest.raises(PySparkException, match="insured_key differs"):
        mart_policy_360({**gold, "dim_policy": other}, {}, AS_OF).collect()
    none = gold["dim_policy"].withColumn("insured_key", F.lit(None).cast("string"))
    mart = mart_policy_360({**gold, "dim_policy": none}, {}, AS_OF)
    assert mart.filter("insured_name IS NOT NULL").count() == 0
    assert mart.count() == none.count()


# --- sixth line -------------------------------------------------------------------------


def test_sixth_line_is_data_only(spark):
    values = {
        "policy_id": "PL-1", "insured_name": "Firm", "state_code": "tx", "premium_amount": "100",
        "per_claim_limit": "50", "aggregate_limit": "40", "effective_date": "2024-01-01",
        "expiration_date": "2025-01-01", "claim_id": "C-1", "claimed_amount": "100.00",
        "paid_amount": "40.00", "claim_status": "Closed", "date_of_occurrence": "2024-02-03",
    }
    second = {**values, "claim_id": "C-2", "paid_amount": "0", "claim_status": "Open"}
    third = {**values, "policy_id": "PL-2", "claim_id": None}
    columns = flat_columns(PROFESSIONAL)
    flat = spark.createDataFrame(
        [tuple(r.get(c) for c in columns) for r in (values, second, third)], flat_schema(PROFESSIONAL)
    ).withColumn("_ingestion_timestamp", F.lit(datetime(2024, 1, 1)))
    silver = build_line(PROFESSIONAL, split_flat(flat, PROFESSIONAL))
    policies = silver["professional_liability_policies"]
    assert {r.policy_id: r._dq_issues for r in policies.collect()} == {
        "PL-1": "per_claim_limit_exceeds_aggregate_limit",
        "PL-2": "per_claim_limit_exceeds_aggregate_limit",
    }
    dim = dims.dim_policy(silver, [PROFESSIONAL])
    fact = facts.fact_claim_transaction(silver, dim, [PROFESSIONAL])
    got = {
        r.transaction_type: (r.paid_amount, r.reserve_amount, r.expense_amount, r.total_incurred)
        for r in fact.collect()
    }
    money = lambda *xs: tuple(Decimal(x) for x in xs)
    assert got == {
        "Payment": money("40.00", "60.00", "6.00", "106.00"),
        "Reserve": money("0.00", "100.00", "0.00", "100.00"),
    }
    lines = dims.dim_line_of_business(spark, [*LINES_OF_BUSINESS, PROFESSIONAL_LINE])
    assert lines.count() == 6
    assert {r.lob_key for r in dim.collect()} == {md5("PL")}


def test_lines_are_five():
    assert [line.code for line in LINES] == ["PROP", "WC", "AUTO", "GL", "UMB"]


def test_rows_are_counted_while_they_are_written(spark, layers):
    layers.observe = True
    rows = spark.createDataFrame([("a", True), ("b", False), (None, None)], "k string, _is_valid boolean")
    layers.write("silver", "t", rows)
    layers.write("silver", "u", rows.repartition(3))
    layers.write("gold", "none", rows.where("k = 'z'"))
    found = {r.table_name: r for r in layers.written().collect()}
    assert (found["t"].row_count, found["t"].invalid_rows) == (3, 1)
    # The order of rows and their partitions change no checksum; their values do.
    assert found["t"][4:] == found["u"][4:]
    assert found["none"].row_count == 0 and found["none"].key_checksum == 0
    layers.write("silver", "u", rows.withColumn("_is_valid", F.lit(True)))
    changed = {r.table_name: r for r in layers.written().collect()}["u"]
    assert changed.key_checksum == found["u"].key_checksum and changed.content_checksum != found["u"].content_checksum


def test_the_mart_joins_the_attributes_of_all_lines_once(spark, plan):
    from strata.workload.layer_queries import AS_OF, lake
    from strata.plans.pipeline import build_mart

    text = plan(build_mart(lake(spark, "/root/testdata/sf0.001"), AS_OF))
    assert text.count("Join ") + text.count("Join(") <= 8, text


# --- disk -------------------------------------------------------------------------------


def shuffle_files(spark):
    """Shuffle files of the session that lie on disk just now."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    names = [blocks.apply(i).name() for i in range(blocks.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_a_run_leaves_no_shuffle_files(spark, layers):
    before = shuffle_files(spark)
    feed = SharedLines(spark, SF)
    run_pipeline(layers, AS_OF, bronze=feed, release=feed.release)
    until = time.time() + 20  # they go in the background
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(REMOVE_SHUFFLES) == "false"


def test_overlapping_blocks_give_the_setting_back(spark):
    outer, inner = shuffles_removed(spark), shuffles_removed(spark)
    outer.__enter__()
    inner.__enter__()
    outer.__exit__(None, None, None)
    assert spark.conf.get(REMOVE_SHUFFLES) == "true"
    inner.__exit__(None, None, None)
    assert spark.conf.get(REMOVE_SHUFFLES) == "false"


def test_claim_tables_share_one_join_of_the_lines(spark, tmp_path):
    folder = str(tmp_path)
    orders = [(1, "1-URGENT"), (1, "1-URGENT"), (1, "2-HIGH"), (2, "3-MEDIUM"), (3, None), (4, "other"), (None, "5-LOW"), (5, "4-NOT SPECIFIED")]
    source = spark.read.parquet(f"{SF}/orders.parquet")
    made = spark.createDataFrame(orders, "k long, p string").crossJoin(source.limit(1))
    made.selectExpr(*[{"o_orderkey": "k AS o_orderkey", "o_orderpriority": "p AS o_orderpriority"}.get(c, c) for c in source.columns]).write.parquet(f"{folder}/orders.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    keys = spark.createDataFrame([(k,) for k in (1, 1, 2, 3, 4, 5, 6, None)], "k long").crossJoin(lines.limit(2))
    keys.selectExpr(*["k AS l_orderkey" if c == "l_orderkey" else c for c in lines.columns]).write.parquet(f"{folder}/lineitem.parquet")
    feed = SharedLines(spark, folder)
    for name in BRONZE_TABLES:
        got = feed(name)
        assert got.schema == bronze_frame(spark, folder, name).schema
        assert rows(got) == rows(bronze_frame(spark, folder, name)), name
    assert not any("lineitem" in f for f in feed("auto_claims_csv").inputFiles())
    feed.release()
    assert rows(feed("auto_claims_csv")) == rows(bronze_frame(spark, folder, "auto_claims_csv"))
    feed.release()


def test_the_mart_in_slices_has_the_rows_of_the_mart(spark, lake):
    whole = rows(build_mart(lake, AS_OF))
    parts = [rows(part) for part in mart_slices(lake, AS_OF, slices=3)]
    assert len(parts) == 3 and all(parts)
    assert sorted((r for part in parts for r in part), key=repr) == whole
    assert len(list(mart_slices(lake, AS_OF))) == 1  # small tables are not read more than once
    assert rows(staged_mart(lake, AS_OF)) == whole


def test_metrics_of_a_table_in_slices_are_those_of_the_whole(spark, layers):
    layers.observe = True
    frame = spark.range(9).selectExpr("cast(id as string) AS k", "id > 3 AS _is_valid")
    layers.write("gold", "once", frame)
    layers.write_slices("gold", "parts", (frame.filter(f"k % 4 = {i}") for i in range(5)))
    assert layers.metrics["gold", "parts"] == layers.metrics["gold", "once"]
    assert rows(spark.table(layers.name("gold", "parts"))) == rows(frame)


def test_landed_files_go_once_bronze_holds_them(spark, layers):
    landing, found = scratch_path(spark, "landing"), []
    land_files(spark, SF, landing)
    files = [f"{d}/{f}" for d, _, names in os.walk(landing.removeprefix("file:")) for f in names if f.startswith("part-")]
    assert all(f.endswith(".json.gz") for f in files if "_json/" in f) and any("_json/" in f for f in files)
    assert all(f.endswith(".csv") for f in files if "_json/" not in f)

    def release():
        found.append((layers.existing("bronze", BRONZE_TABLES), silver_tables(layers)))
        remove_folder(spark, landing)

    counts = run_pipeline(layers, AS_OF, landing, release=release)
    assert [(len(bronze), len(silver)) for bronze, silver in found] == [(len(BRONZE_TABLES), 0)]
    assert not os.path.exists(landing.removeprefix("file:"))
    counted = {r.table_name: r.row_count for r in counts.collect()}
    for name in BRONZE_TABLES:
        assert counted[name] == bronze_frame(spark, SF, name).count()


def test_claim_keys_are_hashed_behind_the_join(lake, plan):
    silver, policies = silver_tables(lake), lake.optional("gold", "dim_policy")
    lake.spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(facts.fact_claim_transaction(silver, policies))
    finally:
        lake.spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above, _, below = text.partition("SortMergeJoin")
    assert "AS claim_key" in above and "AS claim_key" not in below


def test_claims_roll_up_shuffles_no_amounts_by_claim(spark, plan):
    ddl = """policy_key string, claim_key string, paid_amount decimal(18,2),
    reserve_amount decimal(18,2), total_incurred decimal(18,2), date_key int"""
    one = Decimal("1.00")
    data = [
        ("p", "a", one, None, one, 3), ("p", "a", -one, one, None, None), ("p", "b", None, one, one, 1),
        ("p", None, one, one, one, 9), ("q", None, None, None, None, None),
        ("q", None, None, None, None, None), (None, "a", one, one, one, 2), (None, "a", one, one, one, 2),
        (None, None, one, one, one, 2), ("r", "a", one, one, one, 5),
    ]
    got = claims_rollup(spark.createDataFrame(data, ddl))
    assert rows(got) == sorted([
        ("p", 2, one, 3 * one, 3 * one, 9, one), ("q", 0, None, None, None, None, None),
        (None, 1, 3 * one, 3 * one, 3 * one, 2, one), ("r", 1, one, one, one, 5, one),
    ], key=repr)
    by_claim = [line for line in plan(got).splitlines() if re.search(r"Aggregate\(keys=\[policy_key#\d+, claim_key#", line)]
    assert by_claim and all(re.search(r"functions=\[(partial_)?count\(1\)\]", line) for line in by_claim)
