"""Gold facts.

Policy facts come from the same Silver rows as ``dim_policy``; without ``policies`` their
keys are hashed in place and the build is a single map-only pass.  Claims may name policies
that do not exist, so their policy key is always checked against ``dim_policy``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import money, share
from strata.functions.keys import date_to_key, foreign_key, surrogate_key
from strata.operators.joins import resolve_key
from strata.operators.sets import union_all
from strata.operators.shaping import conform
from strata.plans.dimensions import Silver, line_location_id
from strata.specs.gold import gold_schema
from strata.specs.lines import LINES, Line
from strata.specs.reference import CEDED_RATE, COMMISSION_RATE, TAX_RATE


def _policy_rows(silver: Silver, lines: Sequence[Line], columns) -> DataFrame | None:
    """Union of the lines' policies with the columns ``columns(line)`` gives."""
    return union_all(
        silver[line.policies.name].select(
            "policy_id",
            "effective_date",
            F.lit(line.code).alias("__line"),
            line_location_id(line).alias("__location"),
            *columns(line),
        )
        for line in lines
        if line.policies.name in silver
    )


def _with_policy_keys(
    df: DataFrame, policies: DataFrame | None, keys: Sequence[str]
) -> DataFrame:
    """Policy, line and location keys: looked up in ``policies``, else derived."""
    if policies is not None:
        return resolve_key(df, "policy_id", policies, "policy_id", keys, False)
    known = F.col("policy_id").isNotNull()
    derived = {
        "policy_key": foreign_key("policy_id"),
        "lob_key": F.when(known, surrogate_key("__line")),
        "location_key": F.when(known, foreign_key("__location")),
    }
    return df.select("*", *[derived[k].alias(k) for k in keys])


def fact_premium(
    silver: Silver,
    lines: Sequence[Line] = LINES,
    policies: DataFrame | None = None,
    coverages: DataFrame | None = None,
) -> DataFrame | None:
    """One premium row per policy for its line's main coverage."""

    def columns(line: Line) -> list[Column]:
        return [
            F.col("premium_amount").alias("written_premium"),
            money(F.expr(line.coverage_limit)).alias("coverage_limit"),
            money(F.expr(line.deductible)).alias("deductible_amount"),
            F.lit(line.coverage_id).alias("coverage_id"),
        ]

    df = _policy_rows(silver, lines, columns)
    if df is None:
        return None
    df = _with_policy_keys(df, policies, ["policy_key", "lob_key", "location_key"])
    if coverages is not None:
        df = resolve_key(df, "coverage_id", coverages, "coverage_id", ["coverage_key"], False)
    else:
        df = df.withColumn("coverage_key", surrogate_key("coverage_id"))
    written = F.col("written_premium")
    df = df.select(
        "*",
        date_to_key("effective_date").alias("date_key"),
        written.alias("earned_premium"),
        share(written, CEDED_RATE).alias("ceded_premium"),
        money(written - share(written, CEDED_RATE)).alias("net_premium"),
        share(written, COMMISSION_RATE).alias("commission_amount"),
        share(written, TAX_RATE).alias("tax_amount"),
    )
    key = surrogate_key("policy_id", "coverage_id", "date_key")
    return conform(df.withColumn("premium_key", key), gold_schema("fact_premium"))


def fact_claim_transaction(
    silver: Silver,
    policies: DataFrame | None,
    lines: Sequence[Line] = LINES,
    claims: DataFrame | None = None,
) -> DataFrame | None:
    """One transaction per Silver claim; NULL amounts count as zero.

    Incurred is paid + reserve + expense - recovery.  ``claims`` checks the claim key against
    a given dimension instead of deriving it.
    """
    frames = []
    for line in lines:
        if line.claims.name not in silver:
            continue
        zero = F.lit(0)
        status = F.coalesce(F.col("claim_status") == "Closed", F.lit(False))
        frames.append(
            silver[line.claims.name].select(
                "claim_id",
                "policy_id",
                F.expr(line.claim["date_of_loss"]).alias("transaction_date"),
                F.expr(line.transaction_type).alias("transaction_type"),
                money(F.coalesce(F.expr(line.paid), zero)).alias("paid_amount"),
                money(F.coalesce(F.expr(line.reserve), zero)).alias("reserve_amount"),
                money(zero).alias("recovery_amount"),
                money(F.round(F.expr(line.expense), 2)).alias("expense_amount"),
                status.alias("is_final_payment"),
            )
        )
    df = union_all(frames)
    if df is None:
        return None
    if claims is not None:
        df = resolve_key(df, "claim_id", claims, "claim_id", ["claim_key"], False)
    df = resolve_key(
        df, "policy_id", policies, "policy_id", ["policy_key", "lob_key"], False, ["claim_id"]
    )
    if claims is None:
        # Behind the join, whose shuffle would carry the hash next to the id.
        df = df.withColumn("claim_key", foreign_key("claim_id"))
    incurred = (
        F.col("paid_amount")
        + F.col("reserve_amount")
        + F.col("expense_amount")
        - F.col("recovery_amount")
    )
    return conform(
        df.select(
            "*",
            money(incurred).alias("total_incurred"),
            date_to_key("transaction_date").alias("date_key"),
            surrogate_key("claim_id", "transaction_date", "transaction_type").alias(
                "claim_txn_key"
            ),
        ),
        gold_schema("fact_claim_transaction"),
    )


def fact_policy_transaction(
    silver: Silver, lines: Sequence[Line] = LINES, policies: DataFrame | None = None
) -> DataFrame | None:
    """One new-business event per policy."""
    df = _policy_rows(silver, lines, lambda line: [F.col("premium_amount").alias("premium_change")])
    if df is None:
        return None
    df = df.withColumn("transaction_type", F.lit("new_business"))
    df = _with_policy_keys(df, policies, ["policy_key", "lob_key"])
    key = surrogate_key("policy_id", "transaction_type", "effective_date")
    return conform(
        df.select(
            "*",
            key.alias("policy_txn_key"),
            date_to_key("effective_date").alias("date_key"),
            F.col("effective_date").alias("processed_date"),
        ),
        gold_schema("fact_policy_transaction"),
    )
