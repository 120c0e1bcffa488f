"""Operators on the given tables: keys, shaping, filters, deduplication, checks, joins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.casts import MONEY, MONEY_SUM, money, safe_cast
from strata.functions.keys import (
    content_id,
    date_to_key,
    foreign_key,
    generate_surrogate_key,
    key_to_date,
    stable_bucket,
    stable_label,
)
from strata.functions.names import standardize_column_names
from strata.operators.dedup import deduplicate, with_group_size
from strata.operators.flatten import flatten_payload
from strata.operators.joins import (
    constant_lookup,
    orphans,
    resolve_key,
    with_exists_flag,
    with_roles,
)
from strata.operators.quality import (
    DataQualityChecker,
    issue_breakdown,
    issues_by_check,
    summarize,
)
from strata.operators.sets import common_column_union, missing_values, union_all
from strata.operators.shaping import add_metadata_columns, conform, select_available
from strata.plans.dimensions import dim_coverage, dim_date, dim_line_of_business
from strata.specs.bronze import payload_schema
from strata.specs.reference import RISK_TIERS, US_STATES
from strata.workload import oracle
from strata.workload.raw import PRIORITY, STATE, pad, table
from strata.workload.registry import query

PRICE = "cast(o_totalprice as decimal(18,2))"
CONSTANT_TIME = datetime(2024, 1, 2, 3, 4, 5)
LINE_CASE = (
    "case o_orderpriority "
    + " ".join(f"when '{p}' then '{code}'" for code, p in PRIORITY.items())
    + " end"
)


# --- keys -------------------------------------------------------------------------------


@query(
    "surrogate_key_policy",
    f"""SELECT o_orderkey, {oracle.key('o_orderkey', "nullif(o_orderstatus, 'P')")} AS order_key
    FROM orders""",
)
def surrogate_key_policy(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    orders = orders.selectExpr("o_orderkey", "nullif(o_orderstatus, 'P') AS status")
    keyed = generate_surrogate_key(orders, "o_orderkey", "status", key_name="order_key")
    return keyed.select("o_orderkey", "order_key")


@query(
    "date_key_policy",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P'
    THEN cast(strftime(o_orderdate, '%Y%m%d') AS int) END AS date_key,
    CASE WHEN o_orderstatus <> 'P' THEN cast(o_orderdate AS date) END AS key_date FROM orders""",
)
def date_key_policy(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    keyed = orders.select(
        "o_orderkey",
        date_to_key(F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))).alias("date_key"),
    )
    return keyed.withColumn("key_date", key_to_date("date_key"))


@query(
    "content_id_location",
    """SELECT c_custkey, md5(concat_ws('||', c_name, coalesce(nullif(c_mktsegment, 'BUILDING'), ''),
    cast(c_nationkey AS varchar))) AS location_id FROM customer""",
)
def content_id_location(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return customer.select(
        "c_custkey", content_id("c_name", segment, "c_nationkey").alias("location_id")
    )


@query(
    "stable_tier",
    f"""SELECT o_orderkey, {oracle.bucket('o_orderkey', 3)} AS bucket,
    {oracle.label('o_orderkey', RISK_TIERS)} AS risk_tier FROM orders""",
)
def stable_tier(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        stable_bucket("o_orderkey", 3).alias("bucket"),
        stable_label("o_orderkey", RISK_TIERS).alias("risk_tier"),
    )


@query(
    "audit_metadata",
    """SELECT event_id, '2024-01-02 03:04:05' AS ingested, 'events' AS _source_file,
    'parquet' AS _source_format, 'batch-1' AS _batch_id FROM events""",
)
def audit_metadata(spark: SparkSession, sf: str) -> DataFrame:
    stamped = add_metadata_columns(
        table(spark, sf, "events"), "events", "parquet", "batch-1", CONSTANT_TIME
    )
    ingested = F.date_format(
        F.to_utc_timestamp("_ingestion_timestamp", F.current_timezone()), "yyyy-MM-dd HH:mm:ss"
    )
    return stamped.select(
        "event_id", ingested.alias("ingested"), "_source_file", "_source_format", "_batch_id"
    )


# --- shaping ----------------------------------------------------------------------------


@query(
    "snake_case_columns",
    """SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand_nb_name,
    p_size AS size_in_cm, p_type AS _source_type FROM part""",
)
def snake_case_columns(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(
        F.col("p_partkey").alias("partKey"),
        F.col("p_name").alias("Part Name"),
        F.col("p_brand").alias("brandNBName"),
        F.col("p_size").alias("size (in-cm)"),
        F.col("p_type").alias("_source_type"),
    )
    return standardize_column_names(part)


@query("select_available", "SELECT c_custkey, c_name FROM customer")
def available_columns(spark: SparkSession, sf: str) -> DataFrame:
    return select_available(table(spark, sf, "customer"), ["c_custkey", "c_fax", "c_name"])


@query(
    "conform_schema",
    """SELECT cast(s_suppkey AS varchar) AS s_suppkey, cast(s_acctbal AS decimal(18,2)) AS s_acctbal,
    cast(null AS date) AS s_since, s_name, cast(null AS boolean) AS s_active FROM supplier""",
)
def conform_schema(spark: SparkSession, sf: str) -> DataFrame:
    contract = (
        "s_suppkey string, s_acctbal decimal(18,2), s_since date, s_name string, s_active boolean"
    )
    return conform(table(spark, sf, "supplier"), contract)


_AMOUNT_TEXT = (
    f"case o_orderpriority when '1-URGENT' then 'N/A' when '2-HIGH' then '' "
    f"when '3-MEDIUM' then concat(' ', cast({PRICE} as string), ' ') "
    f"when '4-NOT SPECIFIED' then concat(cast({PRICE} as string), 'e3') "
    f"else cast({PRICE} as string) end"
)
_DATE_TEXT = (
    "case o_orderstatus when 'F' then 'unknown' when 'P' then null "
    "else concat(' ', cast(cast(o_orderdate as date) as string)) end"
)
_FLAG_TEXT = "case o_orderstatus when 'F' then ' TRUE' when 'P' then 'perhaps' else 'false' end"


@query(
    "safe_cast_malformed",
    f"""SELECT o_orderkey, try_cast(trim({_AMOUNT_TEXT}) AS decimal(18,2)) AS amount,
    try_cast(trim({_AMOUNT_TEXT}) AS decimal(6,2)) AS narrow_amount,
    try_cast(trim({_DATE_TEXT}) AS date) AS day, try_cast(trim({_FLAG_TEXT}) AS boolean) AS flag,
    upper(trim({_FLAG_TEXT})) AS flag_text FROM orders""",
)
def safe_cast_malformed(spark: SparkSession, sf: str) -> DataFrame:
    text = table(spark, sf, "orders").selectExpr(
        "o_orderkey", f"{_AMOUNT_TEXT} AS a", f"{_DATE_TEXT} AS d", f"{_FLAG_TEXT} AS f"
    )
    return text.select(
        "o_orderkey",
        safe_cast(F.col("a"), MONEY).alias("amount"),
        safe_cast(F.col("a"), "decimal(6,2)").alias("narrow_amount"),
        safe_cast(F.col("d"), "date").alias("day"),
        safe_cast(F.col("f"), "boolean").alias("flag"),
        safe_cast(F.col("f"), "string", upper=True).alias("flag_text"),
    )


_RECIPE_SALT = "((o_orderkey * 48271 + {salt} * 69621 + 11) % 2147483647)"


def _mixed(salt: int) -> str:
    start = _RECIPE_SALT.format(salt=42 + salt)
    return f"(cast({start} as bigint) * cast({start} as bigint) % 2147483647)"


@query(
    "column_recipe_table",
    f"""SELECT concat('AUTO-', {pad('o_orderkey', 10)}) AS policy_id,
    DATE '2015-01-01' + cast({_mixed(1)} % 3650 AS int) AS effective_date,
    DATE '2015-01-01' + cast({_mixed(1)} % 3650 AS int) + 180 AS expiration_date,
    2000 + {_mixed(14)} % 25 AS vehicle_year,
    cast([25000, 50000, 100000, 250000, 500000][cast({_mixed(19)} % 5 + 1 AS int)] AS int)
    AS liability_limit,
    cast((60000 + {_mixed(21)} % 300001) / 100.0 AS decimal(18,2)) AS premium_amount FROM orders""",
)
def column_recipe_table(spark: SparkSession, sf: str) -> DataFrame:
    """Columns computed from the id alone, so they are the same however rows are partitioned."""
    mixed = lambda salt: F.expr(_mixed(salt))
    start = F.date_add(F.lit("2015-01-01").cast("date"), (mixed(1) % 3650).cast("int"))
    limits = F.array(*[F.lit(n) for n in (25000, 50000, 100000, 250000, 500000)])
    return table(spark, sf, "orders").select(
        F.concat(F.lit("AUTO-"), F.lpad(F.col("o_orderkey").cast("string"), 10, "0")).alias("policy_id"),
        start.alias("effective_date"),
        F.date_add(start, 180).alias("expiration_date"),
        (F.lit(2000) + mixed(14) % 25).alias("vehicle_year"),
        F.get(limits, (mixed(19) % 5).cast("int")).alias("liability_limit"),
        ((F.lit(60000) + mixed(21) % 300001).cast("decimal(18,2)") / 100)
        .cast("decimal(18,2)")
        .alias("premium_amount"),
    )


# --- flattening -------------------------------------------------------------------------

_CLAIM_ID = """concat(cast(l_orderkey as string), '-', cast(l_linenumber as string), '-',
    cast(l_partkey as string), '-', cast(l_suppkey as string))"""
_PARTS = "(SELECT * FROM lineitem CROSS JOIN (VALUES ('a'), ('b')) AS v(part))"


def _nested_claims(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with one line as two claims each, in an array; none for an order without lines.

    The arrays are built within the row: their size does not depend on how often a key occurs.
    """
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")

    def claim(part: str) -> Column:
        return F.struct(
            F.concat(F.expr(_CLAIM_ID), F.lit(part)).alias("claim_id"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("date_of_occurrence"),
            F.col("l_returnflag").alias("claim_type"),
            money(F.col("l_extendedprice")).cast("string").alias("amount"),
            F.col("l_linestatus").alias("status"),
        )

    same = orders.o_orderkey == lines.l_orderkey
    # Inner and anti join instead of one left join: a key frequent among the lines can then
    # be split, which an outer join allows on its outer side only.
    matched = orders.join(lines, same).select(
        *orders.columns, F.array(claim("a"), claim("b")).alias("claims")
    )
    alone = orders.join(lines, same, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


@query(
    "flatten_map_payload",
    f"""SELECT cast(o_orderkey AS varchar) AS policy_id, concat('Customer ', o_custkey) AS employer_name,
    cast(null AS varchar) AS fein, o_orderstatus AS class_code,
    CASE WHEN l_orderkey IS NOT NULL THEN concat({_CLAIM_ID}, part) END AS claim_id,
    cast(cast(l_extendedprice AS decimal(18,2)) AS varchar) AS amount
    FROM orders LEFT JOIN {_PARTS} ON o_orderkey = l_orderkey""",
)
def flatten_map_payload(spark: SparkSession, sf: str) -> DataFrame:
    def as_map(claim: Column) -> Column:
        return F.create_map(
            F.lit("claim_id"), claim["claim_id"], F.lit("amount"), claim["amount"]
        )

    payload = _nested_claims(spark, sf).select(
        F.col("o_orderkey").cast("string").alias("policy_id"),
        F.lit(None).cast("string").alias("policy_number"),
        F.create_map(
            F.lit("employer_name"), F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"))
        ).alias("employer_info"),
        F.create_map(F.lit("class_code"), F.col("o_orderstatus")).alias("coverage_details"),
        F.transform("claims", as_map).alias("claims"),
    )
    return flatten_payload(
        conform(payload, payload_schema("workers_comp")),
        {
            "policy_id": "policy_id",
            "employer_name": "employer_info.employer_name",
            "fein": "employer_info.fein",
            "class_code": "coverage_details.class_code",
        },
        explode="claims",
        element_fields={"claim_id": "claim_id", "amount": "amount"},
    )


@query(
    "flatten_struct_payload",
    f"""SELECT cast(o_orderkey AS varchar) AS policy_id, concat('Customer ', o_custkey) AS insured_name,
    o_orderstatus AS business_type, cast({PRICE} AS varchar) AS premium,
    CASE WHEN l_orderkey IS NOT NULL THEN concat({_CLAIM_ID}, part) END AS claim_id,
    strftime(l_shipdate, '%Y-%m-%d') AS date_of_occurrence, l_returnflag AS claim_type
    FROM orders LEFT JOIN {_PARTS} ON o_orderkey = l_orderkey""",
)
def flatten_struct_payload(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit(None).cast("string")
    insured = F.struct(
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("name"),
        F.col("o_orderstatus").alias("business_type"),
        *[none.alias(c) for c in ("naics_code", "address", "city", "state", "zip")],
    )
    coverage = F.struct(
        *[none.alias(c) for c in ("occurrence_limit", "aggregate_limit", "deductible")],
        F.expr(PRICE).cast("string").alias("premium"),
    )
    payload = _nested_claims(spark, sf).select(
        F.col("o_orderkey").cast("string").alias("policy_id"),
        none.alias("policy_number"),
        insured.alias("insured"),
        coverage.alias("coverage"),
        "claims",
    )
    return flatten_payload(
        conform(payload, payload_schema("general_liability")),
        {
            "policy_id": "policy_id",
            "insured_name": "insured.name",
            "business_type": "insured.business_type",
            "premium": "coverage.premium",
        },
        explode="claims",
        element_fields={
            "claim_id": "claim_id",
            "date_of_occurrence": "date_of_occurrence",
            "claim_type": "claim_type",
        },
    )


# --- filters ----------------------------------------------------------------------------


@query(
    "filter_not_null",
    "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders WHERE o_orderstatus <> 'P'",
)
def filter_not_null(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    rows = orders.selectExpr("o_orderkey", "nullif(o_orderstatus, 'P') AS status")
    return rows.filter(F.col("status").isNotNull())


@query(
    "threshold_filter",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
    WHERE l_discount > 0.05 AND l_returnflag = 'R' AND l_quantity > 25""",
)
def threshold_filter(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    rows = lines.filter("l_discount > 0.05D AND l_returnflag = 'R' AND l_quantity > 25")
    return rows.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


@query(
    "point_lookup",
    f"SELECT o_orderkey, o_custkey, {PRICE} AS price FROM orders WHERE o_orderkey = 77",
)
def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").filter("o_orderkey = 77")
    return rows.selectExpr("o_orderkey", "o_custkey", f"{PRICE} AS price")


@query(
    "having_repeated_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def having_repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber")
    return counts.agg(F.count("*").alias("copies")).filter("copies > 1")


# --- deduplication ----------------------------------------------------------------------

_LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)


@query(
    "dedup_latest",
    f"""SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS shipped, l_partkey,
    l_suppkey, cast(l_extendedprice AS decimal(18,2)) AS price FROM (
    SELECT * FROM lineitem {oracle.first_per('l_orderkey, l_linenumber',
    'l_shipdate DESC NULLS LAST', _LINE_COLUMNS[3:])})""",
)
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(*_LINE_COLUMNS)
    latest = deduplicate(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")
    return latest.select(
        "l_orderkey",
        "l_linenumber",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
        "l_partkey",
        "l_suppkey",
        money(F.col("l_extendedprice")).alias("price"),
    )


@query(
    "group_size_flag",
    """SELECT l_orderkey, l_linenumber, l_partkey,
    count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem""",
)
def group_size_flag(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return with_group_size(lines, ["l_orderkey", "l_linenumber"], "copies")


# --- quality checks ---------------------------------------------------------------------


def _checked_customers(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "customer").selectExpr(
        "c_custkey",
        "case when c_nationkey > 2 then c_name end AS name",
        "cast(c_acctbal as decimal(18,2)) AS balance",
        "c_mktsegment AS segment",
    )
    checker = DataQualityChecker(rows)
    return (
        checker.check_not_null("name")
        .check_positive("balance")
        .check_in_set("segment", ["AUTOMOBILE", "BUILDING", "MACHINERY"], "unknown_segment")
        .check_range("balance", -500, 9000)
        .apply()
    )


_CUSTOMER_ISSUES = """concat_ws('; ', CASE WHEN name IS NULL THEN 'null_name' END,
    CASE WHEN balance < 0 THEN 'non_positive_balance' END,
    CASE WHEN segment NOT IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') THEN 'unknown_segment' END,
    CASE WHEN NOT balance BETWEEN -500 AND 9000 THEN 'range_balance' END)"""
_CUSTOMERS_SQL = f"""SELECT *, {_CUSTOMER_ISSUES} = '' AS _is_valid,
    {_CUSTOMER_ISSUES} AS _dq_issues FROM (SELECT c_custkey,
    CASE WHEN c_nationkey > 2 THEN c_name END AS name,
    cast(c_acctbal AS decimal(18,2)) AS balance, c_mktsegment AS segment FROM customer)"""


@query("dq_flags", _CUSTOMERS_SQL)
def dq_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _checked_customers(spark, sf)


@query("dq_valid_only", f"SELECT * FROM ({_CUSTOMERS_SQL}) WHERE _is_valid")
def dq_valid_only(spark: SparkSession, sf: str) -> DataFrame:
    return _checked_customers(spark, sf).filter("_is_valid")


@query(
    "dq_summary",
    f"""SELECT count(*) AS total_records,
    cast(sum(CASE WHEN _is_valid THEN 1 ELSE 0 END) AS bigint) AS valid_records,
    cast(sum(CASE WHEN _is_valid THEN 0 ELSE 1 END) AS bigint) AS invalid_records,
    round(sum(CASE WHEN _is_valid THEN 1 ELSE 0 END) * 100.0 / count(*), 2) AS validity_pct
    FROM ({_CUSTOMERS_SQL})""",
)
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summarize(_checked_customers(spark, sf))


@query(
    "dq_issue_breakdown",
    f"""SELECT _dq_issues, count(*) AS row_count FROM ({_CUSTOMERS_SQL})
    WHERE NOT _is_valid GROUP BY _dq_issues""",
)
def dq_issue_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return issue_breakdown(_checked_customers(spark, sf))


@query(
    "dq_issues_by_check",
    f"""SELECT check_name, count(*) AS row_count FROM (
    SELECT unnest(string_split(_dq_issues, '; ')) AS check_name FROM ({_CUSTOMERS_SQL})
    WHERE NOT _is_valid) GROUP BY check_name""",
)
def dq_issues_by_check(spark: SparkSession, sf: str) -> DataFrame:
    return issues_by_check(_checked_customers(spark, sf))


@query(
    "dq_unique",
    """SELECT l_orderkey, l_linenumber, l_partkey, n = 1 AND p = 1 AS _is_valid,
    concat_ws('; ', CASE WHEN n > 1 THEN 'duplicate_l_orderkey_l_linenumber' END,
    CASE WHEN p > 1 THEN 'shared_part' END) AS _dq_issues FROM (
    SELECT l_orderkey, l_linenumber, l_partkey,
    count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n,
    count(*) OVER (PARTITION BY l_partkey, l_orderkey) AS p FROM lineitem)""",
)
def dq_unique(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    checker = DataQualityChecker(lines).check_unique(["l_orderkey", "l_linenumber"])
    return checker.check_unique(["l_partkey", "l_orderkey"], "shared_part").apply()


@query(
    "dq_referential",
    """SELECT l_orderkey, l_linenumber, l_suppkey, p, s IS NOT NULL AND p2 IS NOT NULL AS _is_valid,
    concat_ws('; ', CASE WHEN s IS NULL THEN 'orphan_l_suppkey' END,
    CASE WHEN p2 IS NULL THEN 'orphan_p' END) AS _dq_issues FROM (
    SELECT l_orderkey, l_linenumber, l_suppkey, nullif(l_partkey, 5) AS p FROM lineitem) l
    LEFT JOIN (SELECT s_suppkey AS s FROM supplier WHERE s_acctbal > 0) ON l_suppkey = s
    LEFT JOIN (SELECT p_partkey AS p2 FROM part WHERE p_size > 3) ON p = p2""",
)
def dq_referential(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_suppkey", "nullif(l_partkey, 5) AS p"
    )
    # The second reference calls its key like the checked column; both columns survive.
    suppliers = table(spark, sf, "supplier").filter("s_acctbal > 0")
    parts = table(spark, sf, "part").filter("p_size > 3").selectExpr("p_partkey AS p")
    checker = DataQualityChecker(lines)
    checker.check_referential_integrity("l_suppkey", suppliers, "s_suppkey")
    return checker.check_referential_integrity("p", parts, "p").apply()


@query(
    "dq_regex",
    """SELECT p_partkey, regexp_matches(p_brand, '^Brand#[1-9]$') AS _is_valid,
    CASE WHEN regexp_matches(p_brand, '^Brand#[1-9]$') THEN '' ELSE 'pattern_p_brand' END
    AS _dq_issues FROM part""",
)
def dq_regex(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return DataQualityChecker(part).check_regex("p_brand", "^Brand#[1-9]$").apply().drop("p_brand")


@query(
    "dq_date_range",
    """SELECT o_orderkey, CASE WHEN o_orderdate < '1996-01-01' OR o_orderdate > '1999-12-31'
    THEN 'date_range_o_orderdate' ELSE '' END AS _dq_issues FROM orders""",
)
def dq_date_range(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    checker = DataQualityChecker(orders)
    checked = checker.check_date_range("o_orderdate", "1996-01-01", "1999-12-31").apply()
    return checked.select("o_orderkey", "_dq_issues")


@query(
    "dq_cross_field",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_linenumber > l_quantity
    THEN 'l_linenumber_exceeds_l_quantity' ELSE '' END AS _dq_issues FROM lineitem""",
)
def dq_cross_field(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    checker = DataQualityChecker(lines).check_less_than_or_equal("l_linenumber", "l_quantity")
    return checker.apply().drop("_is_valid")


# --- joins ------------------------------------------------------------------------------


@query(
    "resolve_keys",
    f"""SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN {oracle.key('c_custkey')} END
    AS insured_key, c_mktsegment AS segment, cast(null AS varchar) AS agent_key
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0)
    ON nullif(o_custkey, 3) = c_custkey""",
)
def resolve_keys(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").cast("string").alias("insured_id"),
        foreign_key("c_custkey").alias("insured_key"),
        "c_mktsegment",
    )
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "cast(nullif(o_custkey, 3) as string) AS customer"
    )
    keyed = resolve_key(
        orders,
        "customer",
        customers,
        "insured_id",
        {"insured_key": "insured_key", "c_mktsegment": "segment"},
        spread_nulls=["o_orderkey"],
    )
    # A lookup that does not exist leaves a typed NULL key.
    return resolve_key(keyed, "customer", None, "agent_id", ["agent_key"]).drop("customer")


_STATE_VALUES = ", ".join(f"('{c}', '{n}')" for c, n in US_STATES)


@query(
    "lookup_state_name",
    f"""SELECT o_orderkey, {STATE} AS state_code, s.name AS state_name FROM orders
    LEFT JOIN (VALUES {_STATE_VALUES}) AS s(code, name) ON {STATE} = s.code""",
)
def lookup_state_name(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").selectExpr("o_orderkey", f"{STATE} AS state_code")
    return constant_lookup(orders, "state_code", US_STATES, "state_name")


@query(
    "orphan_keys",
    """SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def orphan_keys(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").filter("c_acctbal > 0")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return orphans(orders, "o_custkey", customers, "c_custkey")


@query(
    "exists_flag",
    """SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders
    WHERE o_orderstatus = 'P') AS has_open_order FROM customer""",
)
def exists_flag(spark: SparkSession, sf: str) -> DataFrame:
    open_orders = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    customers = table(spark, sf, "customer").select("c_custkey")
    return with_exists_flag(customers, "c_custkey", open_orders, "o_custkey", "has_open_order")


@query(
    "role_playing_dates",
    oracle.with_tables(
        f"""SELECT o_orderkey, s.day_name AS start_day_name, s.fiscal_quarter AS start_fiscal_quarter,
        e.day_name AS end_day_name, e.fiscal_quarter AS end_fiscal_quarter FROM orders
        LEFT JOIN dim_date s ON {oracle.date_key('o_orderdate')} = s.date_key
        LEFT JOIN dim_date e ON {oracle.date_key('cast(o_orderdate AS date) + 365')} = e.date_key""",
        "dim_date",
    ),
)
def role_playing_dates(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        date_to_key("o_orderdate").alias("start_key"),
        date_to_key(F.date_add("o_orderdate", 365)).alias("end_key"),
    )
    calendar = dim_date(spark)
    roles = {"start_key": "start", "end_key": "end"}
    joined = with_roles(orders, roles, calendar, ["day_name", "fiscal_quarter"])
    return joined.drop("start_key", "end_key")


# --- literals over the data -------------------------------------------------------------


@query(
    "literal_lob",
    oracle.with_tables(
        f"""SELECT l.*, n.policies FROM dim_line_of_business l LEFT JOIN (
        SELECT {LINE_CASE} AS code, count(*) AS policies FROM orders GROUP BY 1) n
        ON l.lob_code = n.code""",
        "dim_line_of_business",
    ),
)
def literal_lob(spark: SparkSession, sf: str) -> DataFrame:
    codes = table(spark, sf, "orders").selectExpr(f"{LINE_CASE} AS code")
    counts = codes.groupBy("code").agg(F.count("*").alias("policies"))
    lines = dim_line_of_business(spark)
    return resolve_key(lines, "lob_code", counts, "code", ["policies"])


@query(
    "coverage_reference",
    oracle.with_tables(
        f"""SELECT c.*, n.policies FROM dim_coverage c
        JOIN dim_line_of_business l ON c.lob_key = l.lob_key LEFT JOIN (
        SELECT {LINE_CASE} AS code, count(*) AS policies FROM orders GROUP BY 1) n
        ON l.lob_code = n.code""",
        "dim_coverage",
        "dim_line_of_business",
    ),
)
def coverage_reference(spark: SparkSession, sf: str) -> DataFrame:
    lines = dim_line_of_business(spark)
    codes = table(spark, sf, "orders").selectExpr(f"{LINE_CASE} AS lob_code")
    keyed = generate_surrogate_key(codes, "lob_code", key_name="line_key")
    counts = keyed.groupBy("line_key").agg(F.count("*").alias("policies"))
    return resolve_key(dim_coverage(spark, lines), "lob_key", counts, "line_key", ["policies"])


@query(
    "dim_date",
    oracle.with_tables(
        f"""SELECT d.*, n.orders FROM dim_date d LEFT JOIN (
        SELECT {oracle.date_key('o_orderdate')} AS k, count(*) AS orders FROM orders GROUP BY 1) n
        ON d.date_key = n.k""",
        "dim_date",
    ),
)
def calendar(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "orders").select(date_to_key("o_orderdate").alias("k"))
    counts = keys.groupBy("k").agg(F.count("*").alias("orders"))
    return resolve_key(dim_date(spark), "date_key", counts, "k", ["orders"])


# --- sets -------------------------------------------------------------------------------


@query(
    "union_lobs",
    "SELECT lob_code, count(*) AS policies, cast(sum(price) AS decimal(28,2)) AS total FROM ("
    + " UNION ALL ".join(
        f"SELECT '{code}' AS lob_code, {PRICE} AS price FROM orders WHERE o_orderpriority = '{p}'"
        for code, p in PRIORITY.items()
    )
    + ") GROUP BY lob_code",
)
def union_lobs(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    frames: list[DataFrame | None] = [
        orders.filter(F.col("o_orderpriority") == priority).select(
            F.lit(code).alias("lob_code"), F.expr(PRICE).alias("price")
        )
        for code, priority in PRIORITY.items()
    ]
    # A line without data is skipped.
    rows = union_all([*frames, None])
    return rows.groupBy("lob_code").agg(
        F.count("*").alias("policies"), F.sum("price").cast(MONEY_SUM).alias("total")
    )


@query(
    "common_column_union",
    """SELECT cast(c_custkey AS varchar) AS id, c_name AS name, cast(cast(c_acctbal AS decimal(18,2))
    AS varchar) AS balance FROM customer UNION ALL
    SELECT concat('S', s_suppkey), s_name, cast(cast(s_acctbal AS decimal(18,2)) AS varchar)
    FROM supplier""",
)
def column_union(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_mktsegment AS segment",
        "cast(c_acctbal as decimal(18,2)) AS balance",
    )
    suppliers = table(spark, sf, "supplier").selectExpr(
        "cast(cast(s_acctbal as decimal(18,2)) as string) AS balance", "s_name AS name",
        "concat('S', cast(s_suppkey as string)) AS id",
    )
    return common_column_union(customers, suppliers)


@query(
    "missing_lobs",
    """SELECT * FROM (VALUES ('1-URGENT'), ('3-MEDIUM'), ('6-NEVER'), ('7-LOST')) t(o_orderpriority)
    WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM orders)""",
)
def missing_lobs(spark: SparkSession, sf: str) -> DataFrame:
    expected = ["1-URGENT", "3-MEDIUM", "6-NEVER", "7-LOST"]
    return missing_values(table(spark, sf, "orders"), "o_orderpriority", expected)
