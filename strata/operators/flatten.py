"""Flatten nested payloads: maps and structs to columns, arrays to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_payload(
    df: DataFrame,
    fields: dict[str, str],
    explode: str | None = None,
    element_fields: dict[str, str] | None = None,
) -> DataFrame:
    """Select ``{output: path}`` and, with ``explode``, one row per array element.

    A path is ``column`` or ``column.key``; the key may be a struct field or a map key (a key
    the map lacks gives NULL).  ``element_fields`` are paths inside the element.  A row whose
    array is empty or NULL stays, with NULL element fields.
    """
    outer = [F.col(path).alias(name) for name, path in fields.items()]
    if explode is None:
        return df.select(*outer)
    rows = df.select(*outer, F.explode_outer(explode).alias("__element"))
    inner = [F.col(f"__element.{p}").alias(n) for n, p in (element_fields or {}).items()]
    return rows.select(*fields, *inner)
