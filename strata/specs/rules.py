"""Declarative quality rules from a JSON file."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame

from strata.operators.quality import DataQualityChecker, apply_rules

DEFAULT_RULES = Path(__file__).resolve().parents[2] / "config" / "quality_rules.json"


def load_rules(path: str | Path = DEFAULT_RULES) -> dict[str, list[dict[str, Any]]]:
    return json.loads(Path(path).read_text())


def rules_for(
    table: str, columns: list[str], rules: dict[str, list[dict[str, Any]]]
) -> list[dict[str, Any]]:
    """The common rules whose column the table has, then the table's own."""
    common = [r for r in rules.get("common", []) if r["column"] in columns]
    return [*common, *rules.get(table, [])]


def check_table(
    df: DataFrame, table: str, rules: dict[str, list[dict[str, Any]]] | None = None
) -> DataQualityChecker:
    rules = load_rules() if rules is None else rules
    return apply_rules(df, rules_for(table, df.columns, rules))
