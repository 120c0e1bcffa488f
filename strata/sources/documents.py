"""JSON documents and API pages of which nothing is lost.

A document is parsed twice from its one line of text: into the declared columns, and into the
texts of all its top-level fields.  What the declared columns do not hold goes to a rest column.
Pages are parsed once into a staging table; their records and a ledger of the pages come from it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.shaping import all_strings
from strata.session import scratch_path

CORRUPT = "_corrupt_record"
REST = "_rest"
#: Columns found in documents without a schema, at most.
MAX_COLUMNS = 2_000
ARRAY, BLANK = r"^\s*\[", r"^\s*\z"
_FIELDS, _ITEMS = "map<string,string>", "array<string>"


def read_texts(spark: SparkSession, path: str | Sequence[str], whole_files: bool) -> DataFrame:
    """``value, page``: lines, or whole files, with the file they come from; blank ones too."""
    page = F.col("_metadata.file_path").alias("page")
    return spark.read.text(path, wholetext=whole_files).select("value", page)


def documents_of(text: Column) -> Column:
    """The documents of a text: the elements of a top-level array, or the text itself."""
    items = F.when(text.rlike(ARRAY), F.from_json(text, _ITEMS))
    return F.coalesce(items, F.array(text))


def _lossy(raw: Column, typed: Column, kind: T.DataType) -> Column:
    """Whether the typed value leaves out something of the JSON text."""
    unread = raw.isNotNull() & typed.isNull()
    if isinstance(kind, T.StructType):
        fields = F.from_json(raw, _FIELDS)
        more = F.exists(F.map_keys(fields), lambda k: ~k.isin(kind.fieldNames()))
        inner = [_lossy(fields[f.name], typed[f.name], f.dataType) for f in kind.fields]
        return unread | F.coalesce(reduce(or_, inner, more), F.lit(False))
    if isinstance(kind, T.ArrayType):
        pairs = F.zip_with(F.from_json(raw, _ITEMS), typed, lambda r, t: _lossy(r, t, kind.elementType))
        return unread | F.coalesce(F.exists(pairs, lambda x: x), F.lit(False))
    if isinstance(kind, T.MapType):
        texts = F.map_values(F.from_json(raw, _FIELDS))
        pairs = F.zip_with(texts, F.map_values(typed), lambda r, t: _lossy(r, t, kind.valueType))
        return unread | F.coalesce(F.exists(pairs, lambda x: x), F.lit(False))
    return unread


def parse_documents(docs: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """The declared columns of JSON documents, ``_rest`` and ``_corrupt_record``; others stay.

    ``_rest`` is a JSON object of text: undeclared fields, and declared ones whose value does not
    fit the declaration or holds more than it; NULL where nothing is left.  A text that is no JSON
    object is kept in ``_corrupt_record``.  Numbers keep their value as text, not trailing zeros.
    """
    declared = T.StructType([f for f in schema.fields if f.name not in (REST, CORRUPT)])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    asked = T.StructType([*declared.fields, T.StructField(CORRUPT, T.StringType())])
    others = [c for c in docs.columns if c != column]
    text = F.col(column)
    parsed = docs.select(
        *others, text.alias("__text"), F.from_json(text, asked, options).alias("__typed"),
        F.from_json(text, _FIELDS).alias("__fields"),
    )
    typed, fields = F.col("__typed"), F.col("__fields")
    lost = [F.lit(f.name) for f in declared.fields if isinstance(f.dataType, T.StringType)]
    flags = [
        F.when(_lossy(fields[f.name], typed[f.name], f.dataType), F.lit(f.name))
        for f in declared.fields if not isinstance(f.dataType, T.StringType)
    ]
    kept = F.array(*lost, *[F.lit(f.name) for f in declared.fields if not isinstance(f.dataType, T.StringType)])
    again = F.array_compact(F.array(*flags)) if flags else F.array().cast(_ITEMS)
    rest = F.map_filter(fields, lambda k, _: ~F.array_contains(kept, k) | F.array_contains(again, k))
    broken = F.when(fields.isNull(), F.col("__text")).otherwise(typed[CORRUPT])
    return parsed.select(
        *others, *[typed[f.name].alias(f.name) for f in declared.fields],
        F.when(F.size(rest) > 0, F.to_json(rest)).alias(REST), broken.alias(CORRUPT),
    )


def read_documents(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, multiline: bool = False
) -> DataFrame:
    """JSON lines (``multiline``: one document or array per file) by :func:`parse_documents`."""
    texts = read_texts(spark, path, multiline).where(~F.col("value").rlike(BLANK))
    return parse_documents(texts.select(F.explode(documents_of(F.col("value"))).alias("value")), schema)


def columns_found(docs: DataFrame, column: str = "value") -> list[str]:
    """Top-level field names of the documents, in alphabetical order."""
    keys = docs.select(F.explode(F.map_keys(F.from_json(column, _FIELDS))).alias("k")).distinct()
    names = sorted(r.k for r in keys.limit(MAX_COLUMNS + 1).collect())
    if len(names) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} different fields; declare a schema")
    return names


def stage_pages(
    spark: SparkSession,
    path: str | Sequence[str],
    records_key: str | None = None,
    multiline: bool = True,
    announced: tuple[str, str] = ("metadata", "count"),
) -> DataFrame:
    """API pages, each parsed once and written to the scratch folder.

    ``page, status, announced, found, content_sha256, documents``.  The status is ``empty``,
    ``corrupt`` (no JSON object, or the records are no array), ``single`` (no array: the page is a
    record itself) or ``parsed``.  ``announced`` is the count the page gives in a field of a field.
    ``documents`` holds the records as text; of a corrupt page its whole text.
    """
    outer, inner = announced
    text = F.col("value")
    pages = read_texts(spark, path, multiline).select("page", text, F.from_json(text, _FIELDS).alias("fields"))
    arrays = F.filter(
        F.map_entries("fields"), lambda e: (e["key"] != outer) & e["value"].rlike(ARRAY)
    )
    key = F.lit(records_key) if records_key else F.get(arrays, 0)["key"]
    records = F.from_json(F.col("fields")[key], _ITEMS)
    count = F.from_json(F.col("fields")[outer], _FIELDS)[inner].try_cast("long")
    pages = pages.select("page", "value", "fields", count.alias("announced"), key.alias("key"), records.alias("records"))
    blank, single = text.rlike(BLANK), F.col("fields").isNotNull() & F.col("key").isNull()
    status = (
        F.when(blank, "empty").when(F.col("records").isNotNull(), "parsed")
        .when(single, "single").otherwise("corrupt")
    )
    documents = (
        F.when(blank, F.array().cast(_ITEMS)).when(F.col("records").isNotNull(), F.col("records"))
        .otherwise(F.array("value"))
    )
    found = F.when(F.col("status") == "corrupt", 0).otherwise(F.size("documents")).cast("long")
    staged = pages.select(
        "page", status.alias("status"), "announced", F.sha2("value", 256).alias("content_sha256"),
        documents.alias("documents"),
    ).withColumn("found", found)
    target = scratch_path(spark, "pages-staged")
    staged.write.parquet(target)
    return spark.read.schema(staged.schema).parquet(target)


def page_records(pages: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """The records of staged pages; a corrupt page is one row with its text in ``_corrupt_record``.

    Without a schema every field found becomes a text column.
    """
    docs = pages.select(F.explode("documents").alias("value"))
    return parse_documents(docs, schema or all_strings(columns_found(docs)))


def page_ledger(pages: DataFrame) -> DataFrame:
    """One row per page: what it announced and what was found in it."""
    return pages.select("page", "status", "announced", "found", "content_sha256")
