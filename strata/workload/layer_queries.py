"""Silver, Gold, mart, reports and validation over the five derived lines."""

from __future__ import annotations

import threading
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import resolve_key
from strata.operators.quality import failures_by_rule, issues_by_check, summarize
from strata.operators.sets import union_all
from strata.plans import dimensions as dims
from strata.plans import facts, reports
from strata.plans.mart import claim_status_counts, claims_rollup, premium_rollup
from strata.plans.pipeline import (
    GOLD_INPUTS,
    Layers,
    run_pipeline,
    silver_tables,
    staged_mart,
)
from strata.plans.silver import build_line, build_silver
from strata.plans.validation import mart_sanity, validate_mart
from strata.session import remove_folder, scratch_path
from strata.specs.bronze import flat_columns, split_flat
from strata.specs.lines import LINES, PROFESSIONAL, TableSpec
from strata.specs.reference import LINES_OF_BUSINESS, PROFESSIONAL_LINE, PROFESSIONS
from strata.specs.rules import check_table
from strata.workload import oracle
from strata.workload.oracle import SILVER, whole, with_tables
from strata.workload.raw import (
    BRONZE_TABLES,
    CLAIM_TABLES,
    POLICY_TABLES,
    STATE,
    SharedLines,
    amount,
    bronze_frame,
    land_files,
    pad,
    pick,
    table,
)
from strata.workload.registry import query

AS_OF = date.fromisoformat(oracle.AS_OF)

# Gold and mart tables are written once per session and data folder, as a nightly load
# would, and the reports read them.
_lakes: dict[tuple[str, str], Layers] = {}
_lake_lock = threading.Lock()


def new_lake(spark: SparkSession) -> Layers:
    prefix = f"run{uuid.uuid4().hex[:12]}_"
    return Layers(spark, prefix, scratch_path(spark, "lake"))


def lake(spark: SparkSession, sf: str) -> Layers:
    session = (spark.sparkContext.applicationId, sf)
    with _lake_lock:
        if session not in _lakes:
            layers = new_lake(spark)
            feed = SharedLines(spark, sf)
            run_pipeline(layers, AS_OF, bronze=feed, release=feed.release)
            _lakes[session] = layers
        return _lakes[session]


def silver_frame(spark: SparkSession, sf: str, spec: TableSpec) -> DataFrame:
    return build_silver(spec, [bronze_frame(spark, sf, s) for s in spec.sources])


def _readable(df: DataFrame) -> DataFrame:
    """The ingestion time as text, so every engine prints it alike."""
    text = F.date_format("_ingestion_timestamp", "yyyy-MM-dd HH:mm:ss")
    return df.withColumn("_ingestion_timestamp", text)


# --- Silver -----------------------------------------------------------------------------

_READABLE = "* REPLACE (strftime(_ingestion_timestamp, '%Y-%m-%d %H:%M:%S') AS _ingestion_timestamp)"


def _register_silver(spec: TableSpec) -> None:
    @query(f"silver_{spec.name}", with_tables(f"SELECT {_READABLE} FROM {spec.name}", spec.name))
    def build(spark: SparkSession, sf: str) -> DataFrame:
        return _readable(silver_frame(spark, sf, spec))


for _spec in SILVER.values():
    _register_silver(_spec)


_VALIDITY = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS total, "
    "cast(sum(CASE WHEN _is_valid THEN 1 ELSE 0 END) AS bigint) AS valid, "
    f"round(sum(CASE WHEN _is_valid THEN 1 ELSE 0 END) * 100.0 / count(*), 2) AS validity_pct FROM {name}"
    for name in SILVER
)


@query("silver_validity_report", with_tables(_VALIDITY, *SILVER))
def silver_validity_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.validity_report(silver_tables(lake(spark, sf)))


def _rule_issues() -> str:
    return (
        "concat_ws('; ', CASE WHEN policy_id IS NULL THEN 'policy_id_not_null' END, "
        "CASE WHEN effective_date NOT BETWEEN DATE '1970-01-01' AND DATE '2030-12-31' "
        "THEN 'effective_date_valid' END, "
        "CASE WHEN insured_name IS NULL THEN 'insured_name_not_null' END, "
        "CASE WHEN vehicle_year NOT BETWEEN 1970 AND 2030 THEN 'vehicle_year_range' END, "
        "CASE WHEN premium_amount < 0 THEN 'premium_positive' END)"
    )


@query(
    "dq_rules_from_config",
    with_tables(
        f"SELECT policy_id, {_rule_issues()} = '' AS _is_valid, {_rule_issues()} AS _dq_issues "
        "FROM auto_policies",
        "auto_policies",
    ),
)
def dq_rules_from_config(spark: SparkSession, sf: str) -> DataFrame:
    spec = SILVER["auto_policies"]
    typed = silver_frame(spark, sf, spec).select(*spec.columns.fieldNames())
    checked = check_table(typed, spec.name).apply()
    return checked.select("policy_id", "_is_valid", "_dq_issues")


# Every rule of every table, as the documentation words it and not taken from the rule file.
_POLICY_RULES = {
    "policy_id_not_null": "policy_id IS NULL",
    "effective_date_valid": "effective_date NOT BETWEEN DATE '1970-01-01' AND DATE '2030-12-31'",
}


def _claim_rules(day: str, name: str | None) -> dict[str, str]:
    rules = {"policy_id_not_null": "policy_id IS NULL", "claim_id_not_null": "claim_id IS NULL"}
    return rules | ({name: f"{day} NOT BETWEEN DATE '1970-01-01' AND DATE '2030-12-31'"} if name else {})


_RULES = {
    "property_policies": _POLICY_RULES | {
        "state_valid": "property_state IS NULL",
        "coverage_positive": "total_building_coverage < 0",
        "premium_positive": "premium_amount < 0",
    },
    "property_claims": _claim_rules("date_of_loss", "date_of_loss_valid")
    | {"paid_amount_positive": "amount_paid_building < 0"},
    "workers_comp_policies": _POLICY_RULES | {
        "employer_not_null": "employer_name IS NULL",
        "payroll_positive": "payroll_amount < 0",
        "state_code_valid": "state_code IS NULL",
    },
    "workers_comp_claims": _claim_rules("date_of_injury", "injury_date_valid")
    | {"claim_status_valid": "claim_status NOT IN ('Open', 'Closed', 'Reopened', 'Pending')"},
    "auto_policies": _POLICY_RULES | {
        "insured_name_not_null": "insured_name IS NULL",
        "vehicle_year_range": "vehicle_year NOT BETWEEN 1970 AND 2030",
        "premium_positive": "premium_amount < 0",
    },
    "auto_claims": _claim_rules("date_of_accident", "accident_date_valid"),
    "general_liability_policies": _POLICY_RULES | {
        "insured_name_not_null": "insured_name IS NULL",
        "occurrence_limit_positive": "occurrence_limit < 0",
        "premium_positive": "premium_amount < 0",
    },
    "general_liability_claims": _claim_rules("", None) | {
        "claim_type_valid": "claim_type NOT IN ('BodilyInjury', 'PropertyDamage', 'PersonalInjury', "
        "'Advertising', 'ProductLiability')"
    },
    "umbrella_policies": _POLICY_RULES | {
        "insured_name_not_null": "insured_name IS NULL",
        "umbrella_limit_positive": "umbrella_limit < 0",
        "retention_positive": "retention_amount < 0",
    },
    "umbrella_claims": _claim_rules("", None) | {
        "underlying_line_valid": "underlying_line NOT IN ('Auto', 'GeneralLiability', 'WorkersComp', "
        "'EmployersLiability')"
    },
}


@query(
    "dq_rules_all_tables",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, '{rule}' AS check_name, count(*) AS total, "
            f"count(*) FILTER (WHERE {fails}) AS failed FROM {name}"
            for name, rules in _RULES.items()
            for rule, fails in rules.items()
        ),
        *_RULES,
    ),
)
def dq_rules_all_tables(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows of each Silver table fail each declared rule."""
    return union_all(
        failures_by_rule(check_table(df.select(*SILVER[name].columns.fieldNames()), name), name)
        for name, df in _silver(spark, sf).items()
    )


@query(
    "silver_issues_all_tables",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, check_name, count(*) AS row_count FROM (SELECT "
            f"unnest(string_split(_dq_issues, '; ')) AS check_name FROM {name} WHERE NOT _is_valid) "
            "GROUP BY check_name"
            for name in SILVER
        ),
        *SILVER,
    ),
)
def silver_issues_all_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Failed checks of every Silver table, by name."""
    return union_all(
        issues_by_check(df).select(F.lit(name).alias("table_name"), "*")
        for name, df in _silver(spark, sf).items()
    )


# --- Gold -------------------------------------------------------------------------------


def _silver(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return silver_tables(lake(spark, sf))


def _gold(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    return lake(spark, sf).existing("gold", names or GOLD_INPUTS)


@query("dim_insured", whole("dim_insured"))
def dim_insured(spark: SparkSession, sf: str) -> DataFrame:
    return dims.dim_insured(_silver(spark, sf))


@query("dim_location", whole("dim_location"))
def dim_location(spark: SparkSession, sf: str) -> DataFrame:
    return dims.dim_location(_silver(spark, sf))


@query("dim_agent", whole("dim_agent"))
def dim_agent(spark: SparkSession, sf: str) -> DataFrame:
    return dims.dim_agent(_silver(spark, sf))


@query("dim_policy", whole("dim_policy"))
def dim_policy(spark: SparkSession, sf: str) -> DataFrame:
    return dims.dim_policy(_silver(spark, sf))


@query("dim_policy_by_lookup", whole("dim_policy"))
def dim_policy_by_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The same table with every foreign key joined instead of derived."""
    return dims.dim_policy(_silver(spark, sf), lookups=_gold(spark, sf))


@query("dim_claim", whole("dim_claim"))
def dim_claim(spark: SparkSession, sf: str) -> DataFrame:
    return dims.dim_claim(_silver(spark, sf), _gold(spark, sf)["dim_policy"])


@query("fact_premium", whole("fact_premium"))
def fact_premium(spark: SparkSession, sf: str) -> DataFrame:
    return facts.fact_premium(_silver(spark, sf))


@query("fact_premium_by_lookup", whole("fact_premium"))
def fact_premium_by_lookup(spark: SparkSession, sf: str) -> DataFrame:
    gold = _gold(spark, sf, "dim_policy", "dim_coverage")
    return facts.fact_premium(
        _silver(spark, sf), policies=gold["dim_policy"], coverages=gold["dim_coverage"]
    )


@query("fact_claim_transaction", whole("fact_claim_transaction"))
def fact_claim_transaction(spark: SparkSession, sf: str) -> DataFrame:
    return facts.fact_claim_transaction(_silver(spark, sf), _gold(spark, sf)["dim_policy"])


@query("fact_policy_transaction", whole("fact_policy_transaction"))
def fact_policy_transaction(spark: SparkSession, sf: str) -> DataFrame:
    return facts.fact_policy_transaction(_silver(spark, sf))


@query(
    "linked_policies",
    with_tables(
        "SELECT u.policy_id, a.insured_name AS auto_insured, g.business_type AS gl_business, "
        "w.employer_name AS wc_employer FROM umbrella_policies u "
        "LEFT JOIN auto_policies a ON u.underlying_auto_policy_id = a.policy_id "
        "LEFT JOIN general_liability_policies g ON u.underlying_gl_policy_id = g.policy_id "
        "LEFT JOIN workers_comp_policies w ON u.underlying_wc_policy_id = w.policy_id",
        "umbrella_policies",
        "auto_policies",
        "general_liability_policies",
        "workers_comp_policies",
    ),
)
def linked_policies(spark: SparkSession, sf: str) -> DataFrame:
    silver = _silver(spark, sf)
    rows = silver["umbrella_policies"].select(
        "policy_id",
        "underlying_auto_policy_id",
        "underlying_gl_policy_id",
        "underlying_wc_policy_id",
    )
    for column, name, take in (
        ("underlying_auto_policy_id", "auto_policies", {"insured_name": "auto_insured"}),
        (
            "underlying_gl_policy_id",
            "general_liability_policies",
            {"business_type": "gl_business"},
        ),
        ("underlying_wc_policy_id", "workers_comp_policies", {"employer_name": "wc_employer"}),
    ):
        rows = resolve_key(rows, column, silver[name], "policy_id", take, False).drop(column)
    return rows


# --- roll-ups and mart ------------------------------------------------------------------


@query("premium_rollup", with_tables(oracle.PREMIUM_ROLLUP, "fact_premium"))
def rollup_premium(spark: SparkSession, sf: str) -> DataFrame:
    return premium_rollup(_gold(spark, sf)["fact_premium"])


@query("claims_rollup", with_tables(oracle.CLAIMS_ROLLUP, "fact_claim_transaction"))
def rollup_claims(spark: SparkSession, sf: str) -> DataFrame:
    return claims_rollup(_gold(spark, sf)["fact_claim_transaction"])


@query("claim_status_counts", with_tables(oracle.STATUS_COUNTS, "dim_claim"))
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return claim_status_counts(_gold(spark, sf)["dim_claim"])


@query("policy_360", whole("mart_policy_360"))
def policy_360(spark: SparkSession, sf: str) -> DataFrame:
    return staged_mart(lake(spark, sf), AS_OF)


def _mart(spark: SparkSession, sf: str) -> DataFrame:
    return lake(spark, sf).optional("gold", "mart_policy_360")


def _average(column: str, digits: int) -> str:
    """Exact half-up mean of a decimal column with the same number of digits."""
    scale = 10**digits
    total = f"cast(sum({column}) * {scale} as hugeint)"
    n = f"count({column})"
    mean = f"(2 * abs({total}) + {n}) // (2 * {n})"
    signed = f"cast(sign(sum({column})) * {mean} as decimal(30,{digits})) / {scale}"
    return f"CASE WHEN {n} > 0 THEN cast({signed} as decimal(24,{digits})) END"


MART = "mart_policy_360"


@query(
    "premium_by_lob",
    with_tables(
        "SELECT l.lob_name, count(*) AS policy_count, "
        "cast(sum(f.written_premium) as decimal(38,2)) AS total_written_premium, "
        f"cast({_average('f.written_premium', 2)} as decimal(38,2)) AS avg_premium, "
        "cast(sum(f.net_premium) as decimal(38,2)) AS total_net_premium FROM fact_premium f "
        "JOIN dim_line_of_business l ON f.lob_key = l.lob_key GROUP BY l.lob_name",
        "fact_premium",
        "dim_line_of_business",
    ),
)
def premium_by_lob(spark: SparkSession, sf: str) -> DataFrame:
    gold = _gold(spark, sf)
    return reports.premium_by_lob(gold["fact_premium"], gold["dim_line_of_business"])


@query(
    "claims_by_lob",
    with_tables(
        "SELECT lob_name, count(*) AS policy_count, "
        "cast(sum(total_claims_count) as bigint) AS total_claims, "
        "cast(sum(total_paid_amount) as decimal(38,2)) AS total_paid, "
        f"{_average('loss_ratio', 4)} AS avg_loss_ratio FROM {MART} "
        "WHERE total_claims_count > 0 GROUP BY lob_name",
        MART,
    ),
)
def claims_by_lob(spark: SparkSession, sf: str) -> DataFrame:
    return reports.claims_by_lob(_mart(spark, sf))


@query(
    "portfolio_summary",
    with_tables(
        "SELECT lob_name, count(*) AS policies, "
        "cast(sum(total_written_premium) as decimal(38,2)) AS total_premium, "
        "cast(sum(total_claims_count) as bigint) AS total_claims, "
        f"{_average('loss_ratio', 4)} AS avg_loss_ratio FROM {MART} GROUP BY lob_name",
        MART,
    ),
)
def portfolio_summary(spark: SparkSession, sf: str) -> DataFrame:
    return reports.portfolio_summary(_mart(spark, sf))


@query(
    "premium_by_state_lob",
    with_tables(
        "SELECT policy_state, lob_name, count(*) AS policies, "
        "cast(sum(total_written_premium) as decimal(38,2)) AS total_premium "
        f"FROM {MART} GROUP BY policy_state, lob_name",
        MART,
    ),
)
def premium_by_state_lob(spark: SparkSession, sf: str) -> DataFrame:
    return reports.premium_by_state_lob(_mart(spark, sf))


@query(
    "high_loss_ratio",
    with_tables(
        f"SELECT policy_id, insured_name, lob_name, loss_ratio, total_claims_count FROM {MART} "
        "WHERE loss_ratio > 1.0",
        MART,
    ),
)
def high_loss_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return reports.high_loss_ratio(_mart(spark, sf))


@query(
    "active_high_loss_ratio",
    with_tables(
        f"SELECT policy_id, insured_name, lob_name, loss_ratio, total_claims_count FROM {MART} "
        "WHERE loss_ratio > 1.0 AND is_active",
        MART,
    ),
)
def active_high_loss_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return reports.high_loss_ratio(_mart(spark, sf), active_only=True)


@query(
    "top_paid",
    with_tables(
        f"SELECT policy_id, insured_name, lob_name, total_paid_amount FROM {MART} "
        "ORDER BY total_paid_amount DESC NULLS LAST, policy_id LIMIT 10",
        MART,
    ),
)
def top_paid(spark: SparkSession, sf: str) -> DataFrame:
    return reports.top_paid(_mart(spark, sf))


@query(
    "mart_preview",
    with_tables(
        f"SELECT {', '.join(reports.PREVIEW)} FROM {MART} ORDER BY policy_id LIMIT 20", MART
    ),
)
def mart_preview(spark: SparkSession, sf: str) -> DataFrame:
    return reports.mart_preview(_mart(spark, sf))


@query(
    "policy_lookup",
    with_tables(
        f"SELECT {', '.join(reports.LOOKUP)} FROM {MART} "
        "WHERE policy_id = (SELECT max(policy_id) FROM dim_policy)",
        MART,
        "dim_policy",
    ),
)
def policy_lookup(spark: SparkSession, sf: str) -> DataFrame:
    mart = _mart(spark, sf)
    last = _gold(spark, sf)["dim_policy"].agg(F.max("policy_id")).first()[0]
    return reports.policy_lookup(mart, last)


@query(
    "global_sanity",
    with_tables(
        "SELECT cast(sum(CASE WHEN total_written_premium < 0 THEN 1 ELSE 0 END) as bigint) "
        "AS negative_premiums, "
        "cast(sum(CASE WHEN total_paid_amount < 0 THEN 1 ELSE 0 END) as bigint) "
        "AS negative_claims, "
        "cast(sum(CASE WHEN loss_ratio < 0 THEN 1 ELSE 0 END) as bigint) AS negative_loss_ratio, "
        f"cast({_average('total_written_premium', 2)} as decimal(28,2)) AS avg_premium, "
        f"{_average('loss_ratio', 4)} AS avg_loss_ratio FROM {MART}",
        MART,
    ),
)
def global_sanity(spark: SparkSession, sf: str) -> DataFrame:
    return mart_sanity(_mart(spark, sf))


def _check(name: str, count: str) -> str:
    return f"SELECT '{name}' AS check_name, ({count}) AS violations, ({count}) = 0 AS passed"


def _negative(column: str) -> str:
    return f"SELECT count(*) FROM {MART} WHERE {column} < 0"


def _lost(key: str, dimension: str) -> str:
    return (
        f"SELECT count(*) FROM {MART} WHERE {key} IS NOT NULL "
        f"AND {key} NOT IN (SELECT {key} FROM {dimension})"
    )


@query(
    "mart_validation",
    with_tables(
        " UNION ALL ".join(
            [
                _check(
                    "row_count_difference",
                    f"abs((SELECT count(*) FROM {MART}) - (SELECT count(*) FROM dim_policy))",
                ),
                _check(
                    "duplicate_policy_ids",
                    f"SELECT count(*) FROM (SELECT policy_id FROM {MART} GROUP BY policy_id "
                    "HAVING count(*) > 1)",
                ),
                _check(
                    "missing_lines",
                    f"SELECT 5 - count(DISTINCT lob_code) FROM {MART}",
                ),
                _check("orphan_insured_key", _lost("insured_key", "dim_insured")),
                _check("orphan_lob_key", _lost("lob_key", "dim_line_of_business")),
                _check("orphan_agent_key", _lost("agent_key", "dim_agent")),
                _check("orphan_location_key", _lost("location_key", "dim_location")),
                _check("negative_premium", _negative("total_written_premium")),
                _check("negative_claims", _negative("total_paid_amount")),
                _check("negative_loss_ratio", _negative("loss_ratio")),
            ]
        ),
        MART,
    ),
)
def mart_validation(spark: SparkSession, sf: str) -> DataFrame:
    return validate_mart(_mart(spark, sf), _gold(spark, sf))


# --- whole runs -------------------------------------------------------------------------

_GOLD_TABLES = (
    "dim_agent", "dim_claim", "dim_coverage", "dim_date", "dim_insured",
    "dim_line_of_business", "dim_location", "dim_policy", "fact_claim_transaction",
    "fact_policy_transaction", "fact_premium", "mart_policy_360",
)


def _counts(layer: str, tables) -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in tables
    )


@query(
    "pipeline_end_to_end",
    with_tables(
        f"{_counts('silver', SILVER)} UNION ALL {_counts('gold', _GOLD_TABLES)}",
        *SILVER,
        *_GOLD_TABLES,
    ),
)
def pipeline_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """A fresh run of every layer; rows per table written."""
    layers = new_lake(spark)
    feed = SharedLines(spark, sf)
    counts = run_pipeline(layers, AS_OF, bronze=feed, release=feed.release)
    layer = F.substring_index("schema_name", "_", -1).alias("layer")
    return counts.select(layer, "table_name", "row_count")


# Its keys hash amounts and days, which differ between two deliveries of a claim; files landed
# together do not tell which of them is the newer one.
_BY_DELIVERY = ("fact_claim_transaction",)


def _checksums(layer: str, tables: dict[str, str]) -> str:
    """Rows and key checksums; ``tables`` maps each table to its first column."""
    def checksum(table: str, column: str) -> str:
        if table in _BY_DELIVERY:
            return "cast(null AS decimal(38,0))"
        part = f"'0x' || substr(md5(coalesce(cast({column} AS varchar), '')), 1, 8)"
        return f"cast(coalesce(sum(cast({part} AS bigint)), 0) AS decimal(38,0))"

    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS row_count, "
        f"{checksum(t, c)} AS key_checksum FROM {t}"
        for t, c in tables.items()
    )


_FIRST = {
    "bronze": {t: next(iter({**POLICY_TABLES, **CLAIM_TABLES}[t][1])) for t in BRONZE_TABLES},
    "silver": {name: spec.key for name, spec in SILVER.items()},
    "gold": {
        "dim_agent": "agent_key", "dim_claim": "claim_key", "dim_coverage": "coverage_key",
        "dim_date": "date_key", "dim_insured": "insured_key", "dim_line_of_business": "lob_key",
        "dim_location": "location_key", "dim_policy": "policy_key", "mart_policy_360": "policy_key",
        "fact_claim_transaction": "claim_txn_key", "fact_policy_transaction": "policy_txn_key",
        "fact_premium": "premium_key",
    },
}


@query(
    "files_to_mart",
    with_tables(
        " UNION ALL ".join(_checksums(layer, tables) for layer, tables in _FIRST.items()),
        *BRONZE_TABLES, *SILVER, *_GOLD_TABLES,
    ),
)
def files_to_mart(spark: SparkSession, sf: str) -> DataFrame:
    """Landed files through the manifest, Bronze, Silver and Gold to the mart; rows and checksums
    of every table as counted while it was written."""
    landing, layers = scratch_path(spark, "landing"), new_lake(spark)
    land_files(spark, sf, landing)
    layers.observe = True
    written = run_pipeline(layers, AS_OF, landing, release=lambda: remove_folder(spark, landing))
    known = F.when(~F.col("table_name").isin(*_BY_DELIVERY), F.col("key_checksum"))
    return written.select("layer", "table_name", "row_count", known.alias("key_checksum"))


@query(
    "bronze_row_counts",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in BRONZE_TABLES
        ),
        *BRONZE_TABLES,
    ),
)
def bronze_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.labelled_counts({t: bronze_frame(spark, sf, t) for t in BRONZE_TABLES})


@query(
    "gold_row_counts",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{t}' AS dimension, count(*) AS row_count FROM {t}" for t in _GOLD_TABLES
        ),
        *_GOLD_TABLES,
    ),
)
def gold_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    return reports.labelled_counts(_gold(spark, sf, *_GOLD_TABLES), "dimension")


# --- the sixth line ---------------------------------------------------------------------

_PROFESSION = pick("o_custkey", [p[0] for p in PROFESSIONS])
_POLICY = f"concat('PL-', {pad('o_custkey', 10)})"
_CLAIM = f"concat('CLM-PL-', {pad('o_orderkey', 10)})"
_PRICE = "cast(o_totalprice as decimal(18,2))"
# Flat rows with one policy and one claim: a customer is the policy, its orders the claims.
_FLAT = {
    "policy_id": _POLICY,
    "policy_number": f"concat('PLN', {pad('o_custkey', 9)})",
    "effective_date": "'1996-01-01'",
    "expiration_date": "'1997-01-01'",
    "insured_name": f"concat('Firm_', {pad('o_custkey', 9)})",
    "profession_type": _PROFESSION,
    "license_number": "concat('LN-', cast(o_custkey as string))",
    "state_code": f"lower({STATE})",
    "per_claim_limit": "case when o_custkey % 19 = 0 then '9000000' else '1000000' end",
    "aggregate_limit": "'3000000'",
    "premium_amount": "cast(500 + o_custkey % 1000 as string)",
    "agent_id": f"concat('AGT-', {pad('o_custkey % 5000', 6)})",
    "claim_id": f"case when o_orderstatus = 'P' then null else {_CLAIM} end",
    "date_of_occurrence": "cast(cast(o_orderdate as date) as string)",
    "claimed_amount": amount(_PRICE),
    "paid_amount": f"case o_orderstatus when 'F' then {amount(f'{_PRICE} * 0.4')} else '0.00' end",
    "claim_status": "case o_orderstatus when 'F' then 'Closed' else 'Open' end",
    "_ingestion_timestamp": "cast('1996-01-01' as timestamp)",
}


def _professional_silver(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    columns = [
        f"{_FLAT.get(c, 'cast(null as string)')} AS {c}"
        for c in [*flat_columns(PROFESSIONAL), "_ingestion_timestamp"]
    ]
    flat = table(spark, sf, "orders").selectExpr(*columns)
    return build_line(PROFESSIONAL, split_flat(flat, PROFESSIONAL))


@query(
    "derived_claim_type",
    f"""SELECT claim_id, date_key, transaction_type, paid_amount, reserve_amount, expense_amount,
    paid_amount + reserve_amount + expense_amount AS total_incurred, is_final_payment,
    policy_key FROM (SELECT {_CLAIM} AS claim_id, {oracle.date_key('o_orderdate')} AS date_key,
    CASE WHEN o_orderstatus = 'F' THEN 'Payment' ELSE 'Reserve' END AS transaction_type,
    CASE WHEN o_orderstatus = 'F' THEN cast({_PRICE} * 0.4 AS decimal(18,2)) ELSE 0 END
    AS paid_amount, {_PRICE} - CASE WHEN o_orderstatus = 'F'
    THEN cast({_PRICE} * 0.4 AS decimal(18,2)) ELSE 0 END AS reserve_amount,
    cast(CASE WHEN o_orderstatus = 'F' THEN cast({_PRICE} * 0.4 AS decimal(18,2)) * 0.15 ELSE 0
    END AS decimal(18,2)) AS expense_amount, o_orderstatus = 'F' AS is_final_payment,
    {oracle.key(_POLICY)} AS policy_key FROM orders WHERE o_orderstatus <> 'P')""",
)
def derived_claim_type(spark: SparkSession, sf: str) -> DataFrame:
    """Claim fact of the sixth line: type, reserve and expense are derived."""
    silver = _professional_silver(spark, sf)
    policies = dims.dim_policy(silver, [PROFESSIONAL])
    fact = facts.fact_claim_transaction(silver, policies, [PROFESSIONAL])
    claims = dims.dim_claim(silver, None, [PROFESSIONAL]).select("claim_key", "claim_id")
    named = fact.join(claims, "claim_key")
    return named.select(
        "claim_id", "date_key", "transaction_type", "paid_amount", "reserve_amount",
        "expense_amount", "total_incurred", "is_final_payment", "policy_key",
    )


_PL_ISSUES = "CASE WHEN o_custkey % 19 = 0 THEN 'per_claim_limit_exceeds_aggregate_limit' ELSE '' END"


@query(
    "extension_sixth_lob",
    f"""SELECT DISTINCT {_POLICY} AS policy_id, {_PROFESSION} AS profession_type,
    {STATE} AS state_code, {_PL_ISSUES} = '' AS _is_valid, {_PL_ISSUES} AS _dq_issues,
    md5(concat_ws('||', {_PROFESSION}, {STATE})) AS profession_key,
    'Professional Liability' AS lob_name FROM orders""",
)
def extension_sixth_lob(spark: SparkSession, sf: str) -> DataFrame:
    """A line added by its spec alone, with its line row and profession dimension."""
    policies = _professional_silver(spark, sf)[PROFESSIONAL.policies.name]
    professions = dims.dim_profession(spark)
    profession = F.concat_ws("_", "profession_type", "state_code")
    rows = resolve_key(
        policies.withColumn("__profession", profession),
        "__profession", professions, "profession_id", ["profession_key"], False,
    )
    lines = dims.dim_line_of_business(spark, [*LINES_OF_BUSINESS, PROFESSIONAL_LINE])
    rows = rows.withColumn("__line", F.lit(PROFESSIONAL.code))
    named = resolve_key(rows, "__line", lines, "lob_code", ["lob_name"], False)
    return named.select(
        "policy_id", "profession_type", "state_code", "_is_valid", "_dq_issues",
        "profession_key", "lob_name",
    )


@query(
    "silver_five_lob",
    with_tables(
        " UNION ALL ".join(
            f"SELECT '{line.code}' AS lob_code, '{kind}' AS kind, count(*) AS total_records, "
            "cast(sum(CASE WHEN _is_valid THEN 1 ELSE 0 END) AS bigint) AS valid_records, "
            "cast(sum(CASE WHEN _is_valid THEN 0 ELSE 1 END) AS bigint) AS invalid_records, "
            "round(sum(CASE WHEN _is_valid THEN 1 ELSE 0 END) * 100.0 / count(*), 2) "
            f"AS validity_pct FROM {spec.name}"
            for line in LINES
            for kind, spec in (("policies", line.policies), ("claims", line.claims))
        ),
        *SILVER,
    ),
)
def silver_five_lob(spark: SparkSession, sf: str) -> DataFrame:
    """Both tables of every line built from Bronze in one query, summarised per table."""
    bronze = {name: bronze_frame(spark, sf, name) for name in BRONZE_TABLES}
    parts = []
    for line in LINES:
        built = build_line(line, bronze)
        for kind, spec in (("policies", line.policies), ("claims", line.claims)):
            summary = summarize(built[spec.name])
            parts.append(
                summary.select(F.lit(line.code).alias("lob_code"), F.lit(kind).alias("kind"), "*")
            )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "silver_issues_by_check",
    with_tables(
        "SELECT check_name, count(*) AS row_count FROM (SELECT unnest(string_split(_dq_issues, "
        "'; ')) AS check_name FROM property_policies WHERE NOT _is_valid) GROUP BY check_name",
        "property_policies",
    ),
)
def silver_issues_by_check(spark: SparkSession, sf: str) -> DataFrame:
    return issues_by_check(_silver(spark, sf)["property_policies"])
