"""Column-name normalisation."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# A word starts at an upper-case letter after a lower-case letter or digit, and at the
# last capital of a run ("NBDate" is "NB" + "Date").
_WORD_START = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


def snake_case(name: str) -> str:
    """snake_case form of a name; names starting with ``_`` are audit columns and stay."""
    if name.startswith("_"):
        return name
    words = _WORD_START.sub("_", name).lower()
    return re.sub(r"[^a-z0-9]+", "_", words).strip("_")


def standardize_column_names(df: DataFrame) -> DataFrame:
    """Rename all columns in one projection; two columns may not end up with one name."""
    names = [snake_case(c) for c in df.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"column names collide after normalisation: {repeated}")
    return df.toDF(*names)
