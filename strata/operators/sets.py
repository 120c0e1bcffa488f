"""Unions and differences."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.readers import literal_relation


def union_all(frames: Iterable[DataFrame | None]) -> DataFrame | None:
    """Union by name of the frames that exist; None when none does."""
    present = [f for f in frames if f is not None]
    return reduce(DataFrame.unionByName, present) if present else None


def common_column_union(*frames: DataFrame | None) -> DataFrame | None:
    """Union on the shared columns, in the first frame's order.

    A column typed differently on two sides becomes a string on both, so no side's text is
    widened or rejected.  Sources without a common column are an error, not a lost source.
    """
    present = [f for f in frames if f is not None]
    if not present:
        return None

    def pair(left: DataFrame, right: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in right.schema.fields}
        shared = [f for f in left.schema.fields if f.name in types]
        if not shared:
            raise ValueError("the sources share no column")
        mixed = {f.name for f in shared if f.dataType != types[f.name]}

        def columns() -> list[Column]:
            return [
                F.col(f.name).cast("string").alias(f.name) if f.name in mixed else F.col(f.name)
                for f in shared
            ]

        return left.select(*columns()).unionByName(right.select(*columns()))

    return reduce(pair, present)


def missing_values(df: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """Expected values that the column never takes."""
    wanted = literal_relation(df.sparkSession, [(v,) for v in expected], f"{column} string")
    return wanted.join(df.select(column).distinct(), column, "left_anti")
