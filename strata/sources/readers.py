"""Readers for landed files, catalog tables and literal or generated relations."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.sources.split_csv import read_csv_ranges

CORRUPT = "_corrupt_record"


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    multiline: bool = True,
) -> DataFrame:
    """CSV with a header, every column a string.

    ``multiline`` keeps line breaks inside quotes, at the cost of a pass that finds where records
    begin; turn it off for producers that write one record per line.  Large files are split either
    way, except with a schema and ``multiline``.
    """
    if multiline and schema is None:
        return read_csv_ranges(spark, path)
    reader = spark.read.options(
        header=True, inferSchema=False, multiLine=multiline, quote='"', escape='"'
    )
    if schema is not None:
        # Columns are then taken by name from the header, not by position.
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def read_json(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    multiline: bool = False,
    keep_corrupt: bool = True,
) -> DataFrame:
    """JSON lines by default; ``multiline=True`` for one document (or array) per file.

    With a schema nothing is inferred, so the files are read once instead of twice.  Text
    that does not parse lands in ``_corrupt_record`` when that column is asked for.
    """
    reader = spark.read.options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, multiLine=multiline
    )
    if schema is not None:
        if keep_corrupt and CORRUPT not in schema.fieldNames():
            schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.schema(schema)
    return reader.json(path)


def read_xml(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    row_tag: str = "record",
) -> DataFrame:
    """One row per ``row_tag`` element; attributes become columns with a leading ``_``."""
    reader = spark.read.options(
        rowTag=row_tag, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )
    return (reader.schema(schema) if schema is not None else reader).xml(path)


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))


READERS: dict[str, Callable[..., DataFrame]] = {
    "csv": read_csv,
    "json": read_json,
    "xml": read_xml,
    "parquet": read_parquet,
}


def read_files(spark: SparkSession, fmt: str, path: str | Sequence[str], **options) -> DataFrame:
    """Read by format name; an unknown name is a ``ValueError``."""
    if fmt not in READERS:
        raise ValueError(f"unsupported format {fmt!r}; known: {sorted(READERS)}")
    return READERS[fmt](spark, path, **options)


def expand_envelope(pages: DataFrame, records_key: str | None = None) -> DataFrame:
    """One row per element of an API response's record array.

    Without ``records_key`` the first array column counts; a response with no array at all
    is returned as it is.
    """
    arrays = {f.name: f.dataType for f in pages.schema.fields if isinstance(f.dataType, T.ArrayType)}
    if records_key is None:
        candidates = [c for c in arrays if c not in ("metadata", CORRUPT)]
        if not candidates:
            return pages
        records_key = candidates[0]
    elif records_key not in arrays:
        raise ValueError(f"{records_key!r} is not an array column; arrays: {sorted(arrays)}")
    element = arrays[records_key].elementType
    rows = pages.select(F.explode(records_key).alias("record"))
    return rows.select("record.*") if isinstance(element, T.StructType) else rows


def read_envelope(
    spark: SparkSession,
    path: str | Sequence[str],
    records_key: str | None = None,
    schema: T.StructType | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Records of landed API pages: one page per file, or one per line without multiline."""
    pages = read_json(spark, path, schema=schema, multiline=multiline, keep_corrupt=False)
    return expand_envelope(pages, records_key)


def merge_pages(
    spark: SparkSession,
    path: str | Sequence[str],
    numeric: Sequence[str] = (),
    records_key: str | None = None,
    schema: T.StructType | None = None,
    multiline: bool = True,
) -> DataFrame:
    """One dataset from all landed pages, with the named columns as doubles."""
    records = read_envelope(spark, path, records_key, schema, multiline)
    columns = [
        F.col(c).cast("string").try_cast("double").alias(c) if c in numeric else F.col(c)
        for c in records.columns
    ]
    return records.select(*columns)


def optional_table(
    spark: SparkSession, name: str, columns: Sequence[str] | None = None
) -> DataFrame | None:
    """The table, or None if it does not exist; any other problem still raises."""
    if not spark.catalog.tableExists(name):
        return None
    table = spark.table(name)
    return table.select(*columns) if columns else table


def literal_relation(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A small in-line relation; Arrow keeps it a local relation of known size."""
    schema = T.StructType.fromDDL(ddl)
    columns: list[list[Any]] = [list(c) for c in zip(*rows)] if rows else [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def integer_range(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Ids 0..n-1, made on the executors."""
    return spark.range(0, n, 1, partitions) if partitions else spark.range(n)


def date_series(spark: SparkSession, first: date, last: date, name: str) -> DataFrame:
    """Every day from first to last, both included."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias(name))
