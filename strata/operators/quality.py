"""Row checks that flag rows and never drop them.

A check is a name and a predicate that is TRUE when the row fails; a NULL predicate passes.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedup import with_group_size
from strata.operators.joins import with_exists_flag

VALID = "_is_valid"
ISSUES = "_dq_issues"
DELIMITER = "; "


def add_dq_columns(df: DataFrame, checks: Sequence[tuple[str, Column]] | None) -> DataFrame:
    """Append the validity flag and the names of failed checks, in check order."""
    if not checks:
        return df.select(
            "*", F.lit(True).alias(VALID), F.lit(None).cast("string").alias(ISSUES)
        )
    failed = [F.coalesce(predicate, F.lit(False)) for _, predicate in checks]
    names = [F.when(predicate, F.lit(name)) for name, predicate in checks]
    return df.select(
        "*", (~reduce(or_, failed)).alias(VALID), F.concat_ws(DELIMITER, *names).alias(ISSUES)
    )


class DataQualityChecker:
    """Fluent list of checks on one frame."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.checks: list[tuple[str, Column]] = []
        self._helpers: list[str] = []

    def check(self, name: str, fails: Column) -> DataQualityChecker:
        self.checks.append((name, fails))
        return self

    def check_not_null(self, column: str, check_name: str | None = None):
        return self.check(check_name or f"null_{column}", F.col(column).isNull())

    def check_positive(self, column: str, check_name: str | None = None):
        """Fails below zero; zero itself is a legal amount."""
        return self.check(check_name or f"non_positive_{column}", self._number(column) < 0)

    def _number(self, column: str) -> Column:
        """The column to compare with numbers: malformed text is NULL, never an error."""
        kind = self.df.schema[column].dataType if column in self.df.columns else None
        return F.col(column).try_cast("double") if isinstance(kind, T.StringType) else F.col(column)

    def check_date_range(
        self,
        column: str,
        min_date: str = "1900-01-01",
        max_date: str = "2100-12-31",
        check_name: str | None = None,
    ):
        low, high = date.fromisoformat(min_date), date.fromisoformat(max_date)
        inside = F.col(column).try_cast("date").between(F.lit(low), F.lit(high))
        return self.check(check_name or f"date_range_{column}", ~inside)

    def check_range(
        self, column: str, min_value: Any, max_value: Any, check_name: str | None = None
    ):
        """Fails outside the inclusive numeric range."""
        inside = self._number(column).between(min_value, max_value)
        return self.check(check_name or f"range_{column}", ~inside)

    def check_in_set(
        self, column: str, valid_values: Sequence[Any], check_name: str | None = None
    ):
        return self.check(
            check_name or f"invalid_{column}", ~F.col(column).isin(list(valid_values))
        )

    def check_regex(self, column: str, pattern: str, check_name: str | None = None):
        return self.check(check_name or f"pattern_{column}", ~F.col(column).rlike(pattern))

    def check_less_than_or_equal(
        self, col_a: str, col_b: str, issue_name: str | None = None
    ):
        """Fails where the first column is greater; NULL on either side passes."""
        return self.check(issue_name or f"{col_a}_exceeds_{col_b}", F.col(col_a) > F.col(col_b))

    def check_unique(self, columns: Sequence[str], check_name: str | None = None):
        """Every member of a repeated key fails."""
        helper = self._helper("size")
        self.df = with_group_size(self.df, columns, helper)
        return self.check(check_name or f"duplicate_{'_'.join(columns)}", F.col(helper) > 1)

    def check_referential_integrity(
        self,
        column: str,
        reference_df: DataFrame,
        ref_column: str,
        check_name: str | None = None,
        allow_null: bool = False,
    ):
        """Fails without a match in the reference; NULL fails unless allowed."""
        helper = self._helper("exists")
        self.df = with_exists_flag(self.df, column, reference_df, ref_column, helper)
        fails = ~F.col(helper)
        if allow_null:
            fails = fails & F.col(column).isNotNull()
        return self.check(check_name or f"orphan_{column}", fails)

    def apply(self) -> DataFrame:
        return add_dq_columns(self.df, self.checks).drop(*self._helpers)

    def get_summary(self) -> DataFrame:
        return summarize(self.apply())

    def _helper(self, kind: str) -> str:
        name = f"__dq_{kind}_{len(self._helpers)}"
        self._helpers.append(name)
        return name


def summarize(flagged: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Total, valid and invalid rows and the valid share, in one aggregation."""
    total = F.count("*")
    valid = F.count_if(F.col(VALID))
    share = F.when(total > 0, F.round(valid * 100 / total, 2)).otherwise(F.lit(0.0))
    return flagged.groupBy(*keys).agg(
        total.alias("total_records"),
        valid.alias("valid_records"),
        (total - valid).alias("invalid_records"),
        share.alias("validity_pct"),
    )


def issue_breakdown(flagged: DataFrame) -> DataFrame:
    """Rows per combination of failed checks."""
    bad = flagged.filter(~F.col(VALID))
    return bad.groupBy(ISSUES).agg(F.count("*").alias("row_count"))


def issues_by_check(flagged: DataFrame) -> DataFrame:
    """Rows per single failed check."""
    bad = flagged.filter(~F.col(VALID))
    names = bad.select(F.explode(F.split(ISSUES, DELIMITER)).alias("check_name"))
    return names.groupBy("check_name").agg(F.count("*").alias("row_count"))


def apply_rules(df: DataFrame, rules: Iterable[dict[str, Any]]) -> DataQualityChecker:
    """Checker from declarative rules: ``{name, column, type, ...limits}``."""
    checker = DataQualityChecker(df)
    for rule in rules:
        name, column, kind = rule["name"], rule["column"], rule["type"]
        if column not in df.columns:
            raise ValueError(f"rule {name!r} names the unknown column {column!r}")
        if kind == "not_null":
            checker.check_not_null(column, name)
        elif kind == "positive":
            checker.check_positive(column, name)
        elif kind == "date_range":
            checker.check_date_range(column, rule["min_date"], rule["max_date"], name)
        elif kind == "range":
            checker.check_range(column, rule["min_value"], rule["max_value"], name)
        elif kind == "in_set":
            checker.check_in_set(column, rule["values"], name)
        elif kind == "regex":
            checker.check_regex(column, rule["pattern"], name)
        else:
            raise ValueError(f"rule {name!r} has the unknown type {kind!r}")
    return checker


def failures_by_rule(checker: DataQualityChecker, table: str) -> DataFrame:
    """``table_name, check_name, total, failed`` of every check, zeros included, in one pass."""
    checked = checker.df.select(
        *[F.coalesce(fails, F.lit(False)).alias(f"f{i}") for i, (_, fails) in enumerate(checker.checks)]
    )
    sums = [F.count_if(f"f{i}").alias(f"f{i}") for i in range(len(checker.checks))]
    counts = checked.agg(F.count(F.lit(1)).alias("total"), *sums)
    each = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"f{i}").alias("failed"))
        for i, (name, _) in enumerate(checker.checks)
    ]
    rows = counts.select("total", F.explode(F.array(*each) if each else F.array().cast(
        "array<struct<check_name:string,failed:bigint>>")).alias("c"))
    return rows.select(F.lit(table).alias("table_name"), "c.check_name", "total", "c.failed")
