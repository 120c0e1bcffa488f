"""Projections onto a declared contract."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.casts import typed_null


def schema_of(ddl: str) -> T.StructType:
    """Schema from a DDL string."""
    return T.StructType.fromDDL(ddl)


def all_strings(columns: Sequence[str]) -> T.StructType:
    """Landing schema: every column a nullable string."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def select_available(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    present = set(df.columns)
    return df.select(*[c for c in columns if c in present])


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Exactly the schema's columns, in order and typed; absent ones as typed NULL."""
    schema = schema_of(schema) if isinstance(schema, str) else schema
    present = {f.name: f.dataType for f in df.schema.fields}

    def column(field: T.StructField) -> Column:
        if field.name not in present:
            return typed_null(field.dataType).alias(field.name)
        if present[field.name] == field.dataType:
            return F.col(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def add_metadata_columns(
    df: DataFrame,
    source_file: str | None = "unknown",
    source_format: str = "unknown",
    batch_id: str | None = None,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Audit columns.  ``source_file=None`` records each row's own input file.

    Pass ``batch_id`` and ``ingested_at`` to make a load repeatable; left out, the batch
    gets a random id and the query's start time.
    """
    when = F.current_timestamp()
    if ingested_at is not None:
        if ingested_at.tzinfo is None:
            ingested_at = ingested_at.replace(tzinfo=timezone.utc)
        when = F.lit(ingested_at)
    origin = F.col("_metadata.file_path") if source_file is None else F.lit(source_file)
    return df.select(
        "*",
        when.alias("_ingestion_timestamp"),
        origin.alias("_source_file"),
        F.lit(source_format).alias("_source_format"),
        F.lit(batch_id or str(uuid.uuid4())).alias("_batch_id"),
    )
