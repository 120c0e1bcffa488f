"""The wide mart: one row per policy."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import MONEY_SUM, guarded_ratio
from strata.functions.keys import foreign_key, key_to_date
from strata.operators.joins import broadcast_if_small, resolve_key
from strata.operators.shaping import conform
from strata.plans.dimensions import Silver
from strata.specs.gold import gold_schema
from strata.specs.lines import LINES, WORKERS_COMP, Line

Gold = dict[str, DataFrame]

# Dimension columns and the names they take in the mart.
INSURED_COLUMNS = {
    "insured_name": "insured_name",
    "insured_type": "insured_type",
    "date_of_birth": "insured_dob",
    "gender": "insured_gender",
    "ein": "insured_ein",
    "naics_code": "insured_naics",
    "industry": "insured_industry",
    "employee_count": "insured_employee_count",
    "annual_revenue": "insured_annual_revenue",
}
LINE_COLUMNS = {
    "lob_code": "lob_code",
    "lob_name": "lob_name",
    "lob_category": "lob_category",
    "naic_code": "naic_code",
}
AGENT_COLUMNS = {
    "agent_name": "agent_name",
    "agency_name": "agency_name",
    "agency_code": "agency_code",
    "commission_tier": "commission_tier",
}
LOCATION_COLUMNS = {
    "address_line1": "policy_address",
    "city": "policy_city",
    "state_code": "policy_state",
    "state_name": "policy_state_name",
    "zip_code": "policy_zip",
    "latitude": "policy_latitude",
    "longitude": "policy_longitude",
    "flood_zone": "policy_flood_zone",
}


def premium_rollup(fact: DataFrame) -> DataFrame:
    """Premium measures per policy."""
    sums = {
        "total_written_premium": "written_premium",
        "total_earned_premium": "earned_premium",
        "total_net_premium": "net_premium",
        "total_coverage_limit": "coverage_limit",
        "total_deductible": "deductible_amount",
        "total_commission": "commission_amount",
    }
    return fact.groupBy("policy_key").agg(
        *[F.sum(c).cast(MONEY_SUM).alias(name) for name, c in sums.items()],
        F.count("*").alias("premium_line_count"),
    )


def claims_rollup(fact: DataFrame) -> DataFrame:
    """Claim measures per policy; a claim with several transactions counts once.

    Amounts are summed and transactions counted per policy right away, and what repeated claims
    count too often is taken off.  Of a claim only its two keys are shuffled, by both of them, and
    of a policy one row per task, so neither a hot policy nor a hot claim gathers in one task.
    """
    first = F.col("claim_key").isNotNull().cast("bigint")
    amounts = ["paid_amount", "reserve_amount", "total_incurred", "date_key"]
    transactions = fact.select("policy_key", *amounts, first.alias("claims"))
    keys = fact.where("claim_key IS NOT NULL").groupBy("policy_key", "claim_key")
    repeated = keys.agg(F.count("*").alias("n")).where("n > 1")
    rows = transactions.unionByName(
        repeated.select("policy_key", (1 - F.col("n")).alias("claims")), allowMissingColumns=True
    )
    return rows.groupBy("policy_key").agg(
        F.coalesce(F.sum("claims"), F.lit(0)).alias("total_claims_count"),
        F.sum("paid_amount").cast(MONEY_SUM).alias("total_paid_amount"),
        F.sum("reserve_amount").cast(MONEY_SUM).alias("total_reserved_amount"),
        F.sum("total_incurred").cast(MONEY_SUM).alias("total_incurred"),
        F.max("date_key").alias("last_claim_date_key"),
        F.max("paid_amount").alias("largest_claim_amount"),
    )


def claim_status_counts(dim_claim: DataFrame) -> DataFrame:
    """Open and closed claims per policy; other states are not counted."""
    return dim_claim.groupBy("policy_key").agg(
        F.count_if(F.col("claim_status") == "Open").alias("open_claims_count"),
        F.count_if(F.col("claim_status") == "Closed").alias("closed_claims_count"),
    )


def injuries(claims: DataFrame) -> DataFrame:
    """One row per claim, to be summed per policy together with the attributes."""
    return claims.select(
        foreign_key("policy_id").alias("policy_key"), F.lit(1).cast("bigint").alias("wc_injury_count")
    )


def line_attributes(silver: Silver, line: Line) -> DataFrame:
    """A line's own columns under their mart names, keyed like the rest of the mart."""
    return silver[line.policies.name].select(
        foreign_key("policy_id").alias("policy_key"),
        *[F.col(c).alias(name) for name, c in line.attributes.items()],
    )


def silver_attributes(silver: Silver, lines: Sequence[Line]) -> DataFrame | None:
    """Attributes of all lines and injury counts, one row per policy: one shuffle and one join.

    Every attribute comes from one line, so of a policy's rows at most one has it.
    """
    frames = [
        line_attributes(silver, line)
        for line in lines
        if line.attributes and line.policies.name in silver
    ]
    if WORKERS_COMP.claims.name in silver:
        frames.append(injuries(silver[WORKERS_COMP.claims.name]))
    if not frames:
        return None
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    names = [c for c in rows.columns if c != "policy_key"]
    values = [
        (F.sum(c) if c == "wc_injury_count" else F.first(c, ignorenulls=True)).alias(c) for c in names
    ]
    return rows.where("policy_key IS NOT NULL").groupBy("policy_key").agg(*values)


def with_expiry(df: DataFrame, as_of: date) -> DataFrame:
    """Days to expiry on a given day; a policy expiring that day is no longer active."""
    days = F.datediff(key_to_date("expiration_date_key"), F.lit(as_of))
    return df.select(
        "*",
        F.col("policy_term_months").alias("policy_tenure_months"),
        days.alias("days_until_expiry"),
        (days > 0).alias("is_active"),
    )


def _with_insured(mart: DataFrame, insured: DataFrame) -> DataFrame:
    """Join the insured on the policy key.

    There is one insured per policy id, so both keys hash the same id and are equal wherever
    a policy has an insured.  Joining on the policy key saves shuffling the mart row by a
    second key; a policy for which the two differ fails the query.
    """
    same = F.col("insured_key") == F.col("policy_key")
    stop = F.raise_error(F.lit("insured_key differs from policy_key")).cast("string")
    checked = F.when(same | F.col("insured_key").isNull(), F.col("insured_key")).otherwise(stop)
    side = insured.select(
        F.col("insured_key").alias("__insured"),
        *[F.col(c).alias(name) for c, name in INSURED_COLUMNS.items()],
    )
    policies = mart.withColumn("insured_key", checked)
    condition = (F.col("policy_key") == F.col("__insured")) & F.col("insured_key").isNotNull()
    return policies.join(side, condition, "left").drop("__insured")


def slice_of(gold: Gold, silver: Silver, i: int, n: int) -> tuple[Gold, Silver]:
    """The tables with only the rows of every n-th policy, by a hash of its key.

    Lookups by other keys stay whole.  A policy has its key in all of these tables; the insured's
    is the same one (see :func:`_with_insured`).
    """

    def mine(key) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)) == i

    keys = {
        "dim_policy": "policy_key", "dim_insured": "insured_key", "fact_premium": "policy_key",
        "fact_claim_transaction": "policy_key", "dim_claim": "policy_key",
    }
    return (
        {name: df.filter(mine(keys[name])) if name in keys else df for name, df in gold.items()},
        {name: df.filter(mine(foreign_key("policy_id"))) for name, df in silver.items()},
    )


def mart_policy_360(
    gold: Gold, silver: Silver, as_of: date, lines: Sequence[Line] = LINES
) -> DataFrame | None:
    """Policy, dimensions, rolled-up facts and line attributes in one row.

    Line, agent and location are joined first, while the rows are narrow.  Everything at
    policy grain is joined on ``policy_key`` - the insured and the Silver attributes too - so
    all those joins share one shuffle of the mart row.  Missing inputs leave typed NULLs
    (zero for counts).
    """
    if "dim_policy" not in gold:
        return None
    mart = gold["dim_policy"]
    if "dim_line_of_business" in gold:
        # A handful of keys: shuffling by them would fill a handful of partitions.
        lookup = broadcast_if_small(gold["dim_line_of_business"])
        mart = resolve_key(mart, "lob_key", lookup, "lob_key", LINE_COLUMNS, False)
    for table, key, columns in (
        ("dim_agent", "agent_key", AGENT_COLUMNS),
        ("dim_location", "location_key", LOCATION_COLUMNS),
    ):
        if table in gold:
            mart = resolve_key(mart, key, gold[table], key, columns, False, ["policy_key"])
    if "dim_insured" in gold:
        mart = _with_insured(mart, gold["dim_insured"])

    parts = []
    if "fact_premium" in gold:
        parts.append(premium_rollup(gold["fact_premium"]))
    if "fact_claim_transaction" in gold and "dim_claim" in gold:
        parts.append(claims_rollup(gold["fact_claim_transaction"]))
        parts.append(claim_status_counts(gold["dim_claim"]))
    attributes = silver_attributes(silver, lines)
    if attributes is not None:
        parts.append(attributes)
    mart = reduce(lambda left, right: left.join(right, "policy_key", "left"), parts, mart)

    if "fact_premium" not in gold:
        mart = mart.withColumn("premium_line_count", F.lit(0).cast("bigint"))
    if "fact_claim_transaction" not in gold or "dim_claim" not in gold:
        measures = gold_schema("mart_policy_360")
        names = (
            "total_claims_count",
            "open_claims_count",
            "closed_claims_count",
            "total_paid_amount",
            "total_reserved_amount",
            "total_incurred",
            "last_claim_date_key",
            "largest_claim_amount",
        )
        zeros = [F.lit(0).cast(measures[n].dataType).alias(n) for n in names]
        mart = mart.select("*", *zeros)
    if "fact_premium" in gold:
        ratio = guarded_ratio(F.col("total_incurred"), F.col("total_written_premium"))
        mart = mart.withColumn("loss_ratio", ratio)
    return conform(with_expiry(mart, as_of), gold_schema("mart_policy_360"))
