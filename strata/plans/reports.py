"""Reports over Gold.  Each aggregates before it sorts, so only small results are ordered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.quality import VALID
from strata.operators.sets import union_all

RATIO = T.DecimalType(24, 4)
TOTAL = T.DecimalType(38, 2)


def labelled_counts(tables: dict[str, DataFrame], label: str = "table_name") -> DataFrame | None:
    """Row count per table, sorted by name."""
    counts = [
        t.agg(F.count("*").alias("row_count")).select(F.lit(name).alias(label), "row_count")
        for name, t in tables.items()
    ]
    result = union_all(counts)
    return None if result is None else result.orderBy(label)


def validity_report(tables: dict[str, DataFrame]) -> DataFrame | None:
    """Valid rows and their share per Silver table."""
    parts = []
    for name, table in tables.items():
        total, valid = F.count("*"), F.count_if(F.col(VALID))
        pct = F.when(total > 0, F.round(valid * 100 / total, 2)).otherwise(F.lit(0.0))
        parts.append(
            table.agg(
                total.alias("total"), valid.alias("valid"), pct.alias("validity_pct")
            ).select(F.lit(name).alias("table_name"), "total", "valid", "validity_pct")
        )
    result = union_all(parts)
    return None if result is None else result.orderBy("table_name")


def premium_by_lob(fact_premium: DataFrame, lines: DataFrame) -> DataFrame:
    """Premium per line: summed by key first, so the join sees one row per line."""
    sums = fact_premium.groupBy("lob_key").agg(
        F.count("*").alias("policy_count"),
        F.sum("written_premium").cast(TOTAL).alias("total_written_premium"),
        F.round(F.avg("written_premium"), 2).cast(TOTAL).alias("avg_premium"),
        F.sum("net_premium").cast(TOTAL).alias("total_net_premium"),
    )
    named = sums.join(lines.select("lob_key", "lob_name"), "lob_key", "inner")
    return named.drop("lob_key").orderBy(F.desc_nulls_last("total_written_premium"), "lob_name")


def claims_by_lob(mart: DataFrame) -> DataFrame:
    """Claims per line over the policies that have any."""
    with_claims = mart.filter("total_claims_count > 0")
    return (
        with_claims.groupBy("lob_name")
        .agg(
            F.count("*").alias("policy_count"),
            F.sum("total_claims_count").alias("total_claims"),
            F.sum("total_paid_amount").cast(TOTAL).alias("total_paid"),
            F.round(F.avg("loss_ratio"), 4).cast(RATIO).alias("avg_loss_ratio"),
        )
        .orderBy(F.desc_nulls_last("total_claims"), "lob_name")
    )


def portfolio_summary(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("lob_name")
        .agg(
            F.count("*").alias("policies"),
            F.round(F.sum("total_written_premium"), 2).cast(TOTAL).alias("total_premium"),
            F.sum("total_claims_count").alias("total_claims"),
            F.round(F.avg("loss_ratio"), 4).cast(RATIO).alias("avg_loss_ratio"),
        )
        .orderBy(F.desc_nulls_last("total_premium"), "lob_name")
    )


PREVIEW = (
    "policy_id",
    "lob_name",
    "insured_name",
    "insured_type",
    "total_written_premium",
    "total_claims_count",
    "loss_ratio",
    "is_active",
)


def mart_preview(mart: DataFrame, rows: int = 20) -> DataFrame:
    """The first policies by id; a limit without an order would change between runs."""
    return mart.select(*PREVIEW).orderBy("policy_id").limit(rows)


def top_paid(mart: DataFrame, rows: int = 10) -> DataFrame:
    """Policies with the highest paid amount; each task keeps its own top rows first."""
    columns = ("policy_id", "insured_name", "lob_name", "total_paid_amount")
    order = (F.desc_nulls_last("total_paid_amount"), F.asc("policy_id"))
    return mart.select(*columns).orderBy(*order).limit(rows)


def premium_by_state_lob(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("policy_state", "lob_name")
        .agg(
            F.count("*").alias("policies"),
            F.sum("total_written_premium").cast(TOTAL).alias("total_premium"),
        )
        .orderBy(F.desc_nulls_last("total_premium"), "policy_state", "lob_name")
    )


def high_loss_ratio(mart: DataFrame, above: float = 1.0, active_only: bool = False) -> DataFrame:
    """Policies whose losses exceed the given share of their premium."""
    rows = mart.filter(F.col("loss_ratio") > F.lit(str(above)).cast(RATIO))
    if active_only:
        rows = rows.filter("is_active")
    columns = ("policy_id", "insured_name", "lob_name", "loss_ratio", "total_claims_count")
    return rows.select(*columns).orderBy(F.desc("loss_ratio"), "policy_id")


LOOKUP = (
    "policy_id", "lob_name", "insured_name", "insured_type", "policy_state", "policy_city",
    "total_written_premium", "total_net_premium", "total_claims_count", "open_claims_count",
    "closed_claims_count", "total_paid_amount", "loss_ratio", "auto_vehicle_make",
    "auto_vehicle_model", "wc_class_code", "wc_payroll_amount", "gl_business_type",
    "gl_occurrence_limit", "umb_umbrella_limit", "property_construction_type",
    "property_building_value", "is_active", "days_until_expiry",
)


def policy_lookup(mart: DataFrame, policy_id: str) -> DataFrame:
    """One policy by id; the predicate reaches the file scan."""
    return mart.filter(F.col("policy_id") == policy_id).select(*LOOKUP)
