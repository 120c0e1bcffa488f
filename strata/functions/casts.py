"""Casts that give NULL for malformed text while ANSI mode stays on."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
# Sums of money keep their full width until the output contract narrows them.
MONEY_SUM = T.DecimalType(28, 2)


def safe_cast(column: Column, to: T.DataType | str, upper: bool = False) -> Column:
    """Trim text and convert it; what does not parse becomes NULL.

    Whole numbers written with decimals ("3.0") are numbers too; decimals are cut off.
    """
    text = F.trim(column.cast("string"))
    if isinstance(to, T.StringType) or to == "string":
        return F.upper(text) if upper else text
    if isinstance(to, T.IntegralType) or to in ("int", "integer", "long", "bigint", "short", "smallint"):
        # Cutting off before the cast keeps 2.7 from becoming 3 and 1e30 from failing.
        whole = F.when(text.rlike(r"^[+-]?[0-9]+[.][0-9]*$"), F.substring_index(text, ".", 1))
        return F.coalesce(text.try_cast(to), whole.try_cast(to))
    return text.try_cast(to)


def typed_null(to: T.DataType | str) -> Column:
    return F.lit(None).cast(to)


def money(column: Column) -> Column:
    """Exact money from a numeric column."""
    return column.cast(MONEY)


def share(column: Column, rate: str) -> Column:
    """``rate`` of a money column, rounded half-up to cents in decimal arithmetic."""
    return F.round(column * F.lit(Decimal(rate)), 2).cast(MONEY)


def guarded_ratio(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """Ratio where the denominator is positive, NULL elsewhere."""
    value = F.round(numerator / denominator, digits).cast(T.DecimalType(24, digits))
    return F.when(denominator > 0, value)
