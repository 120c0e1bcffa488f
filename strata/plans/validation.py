"""Mart checks as a result table, one row per check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.joins import orphans
from strata.operators.sets import missing_values, union_all
from strata.specs.lines import LINES

# Foreign keys of the mart and the dimensions they point to.
REFERENCES = (
    ("insured_key", "dim_insured"),
    ("lob_key", "dim_line_of_business"),
    ("agent_key", "dim_agent"),
    ("location_key", "dim_location"),
)


def _finding(name: str, observed: DataFrame) -> DataFrame:
    """A one-row count under the name of its check."""
    return observed.select(F.lit(name).alias("check_name"), F.col("n").cast("bigint").alias("violations"))


def duplicate_ids(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    return df.groupBy(column).count().filter(F.col("count") > 1)


def _one_pass(mart: DataFrame, policies: DataFrame) -> DataFrame:
    """The checks that need only sums: one pass over each table, one row per check."""
    checked = {
        "negative_premium": "total_written_premium",
        "negative_claims": "total_paid_amount",
        "negative_loss_ratio": "loss_ratio",
    }
    ours = mart.select(F.lit(1).alias("side"), *checked.values())
    nothing = [F.lit(None).cast(ours.schema[c].dataType).alias(c) for c in checked.values()]
    rows = ours.unionByName(policies.select(F.lit(-1).alias("side"), *nothing))
    counts = rows.agg(
        F.abs(F.coalesce(F.sum("side"), F.lit(0))).alias("row_count_difference"),
        *[F.count_if(F.col(c) < 0).alias(name) for name, c in checked.items()],
    )
    return counts.unpivot([], counts.columns, "check_name", "violations")


def validate_mart(
    mart: DataFrame, gold: dict[str, DataFrame], lines: Sequence[str] | None = None
) -> DataFrame:
    """All mart checks with their number of violations; a check passes with none."""
    codes = list(lines or [line.code for line in LINES])
    n = F.count("*").alias("n")
    checks = [
        _one_pass(mart, gold["dim_policy"]),
        _finding("duplicate_policy_ids", duplicate_ids(mart, "policy_id").agg(n)),
        _finding("missing_lines", missing_values(mart, "lob_code", codes).agg(n)),
    ]
    for key, dimension in REFERENCES:
        if dimension in gold:
            lost = orphans(mart, key, gold[dimension], key).agg(n)
            checks.append(_finding(f"orphan_{key}", lost))
    return union_all(checks).withColumn("passed", F.col("violations") == 0)


def mart_sanity(mart: DataFrame) -> DataFrame:
    """Negative counts and averages in one pass."""
    return mart.agg(
        F.count_if(F.col("total_written_premium") < 0).alias("negative_premiums"),
        F.count_if(F.col("total_paid_amount") < 0).alias("negative_claims"),
        F.count_if(F.col("loss_ratio") < 0).alias("negative_loss_ratio"),
        F.round(F.avg("total_written_premium"), 2).cast(T.DecimalType(28, 2)).alias("avg_premium"),
        F.round(F.avg("loss_ratio"), 4).cast(T.DecimalType(24, 4)).alias("avg_loss_ratio"),
    )


def assert_valid(results: DataFrame) -> None:
    """Raise if a check failed; the result table has one row per check."""
    failed = [f"{r.check_name}: {r.violations}" for r in results.filter("NOT passed").collect()]
    if failed:
        raise AssertionError("; ".join(failed))
