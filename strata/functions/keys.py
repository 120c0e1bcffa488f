"""Deterministic keys: every expression here is a plain built-in column expression.

A surrogate key is a pure function of its natural key, so a foreign key never needs a join
to be *computed* - only to check that the referenced row exists.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separator and NULL token are part of every stored key.
SEPARATOR = "||"
NULL_TOKEN = "__NULL__"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*columns: str | Column) -> Column:
    """32-hex key over the given columns; NULL and '' give different keys."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def foreign_key(column: str | Column) -> Column:
    """Surrogate key of a reference, NULL when the reference itself is NULL."""
    return F.when(_col(column).isNotNull(), surrogate_key(column))


def content_id(*columns: str | Column) -> Column:
    """Identity of a row by its content; NULL counts as the empty string."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def generate_surrogate_key(
    df: DataFrame, *key_columns: str, key_name: str = "surrogate_key"
) -> DataFrame:
    return df.withColumn(key_name, surrogate_key(*key_columns))


def date_to_key(column: str | Column) -> Column:
    """Date as an int of the form yyyyMMdd; NULL stays NULL."""
    return F.date_format(_col(column), "yyyyMMdd").cast("int")


def key_to_date(column: str | Column) -> Column:
    return F.try_to_date(_col(column).cast("string"), "yyyyMMdd")


def stable_bucket(column: str | Column, buckets: int) -> Column:
    """Bucket 0..buckets-1 from the first 32 bits of an md5; the same on every engine."""
    head = F.conv(F.substring(F.md5(_col(column).cast("string")), 1, 8), 16, 10)
    return F.pmod(head.cast("bigint"), F.lit(buckets))


def murmur_bucket(column: str | Column, buckets: int) -> Column:
    """Cheaper bucket from Spark's own 32-bit hash; pmod keeps the minimum int legal."""
    return F.pmod(F.hash(_col(column)), F.lit(buckets)).cast("bigint")


def stable_label(column: str | Column, labels: Sequence[str]) -> Column:
    """Pick a label by the stable bucket of a column; NULL gives NULL."""
    choices = F.array(*[F.lit(label) for label in labels])
    picked = F.element_at(choices, (stable_bucket(column, len(labels)) + 1).cast("int"))
    # element_at over a constant array ignores a NULL index, so NULL is kept out of it.
    return F.when(_col(column).isNotNull(), picked)
