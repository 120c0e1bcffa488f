"""Manifest-driven Bronze ingest."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.operators.shaping import add_metadata_columns, all_strings
from strata.sinks.tables import write_table
from strata.sources.documents import page_ledger, page_records, read_documents, stage_pages
from strata.sources.readers import literal_relation, read_files
from strata.sources.split_csv import read_csv_ranges
from strata.specs.bronze import flood_schema
from strata.specs.lines import silver_specs

STATUS_DDL = "table_name string, source_format string, status string, reason string"
# Independent loads submitted at once; Spark still decides where their tasks run.
CONCURRENT_LOADS = 8
CORRUPT = "_corrupt_record"
#: Behind a Bronze table's name: the table of the pages it came from.
LEDGER = "_pages"


@dataclass(frozen=True)
class SourceSpec:
    """A landed dataset and the Bronze table it fills.

    ``multiline``: JSON with one document or array per file instead of one per line.
    """

    path: str
    table: str
    fmt: str
    schema: T.StructType | None = None
    multiline: bool = False
    records_key: str | None = None


def _landed(path: str, table: str, fmt: str) -> SourceSpec:
    return SourceSpec(path, table, fmt)


# Landing folders, Bronze tables and formats.
STRUCTURED = (
    _landed("property/synthetic_policies_csv", "property_policies_csv", "csv"),
    _landed("property/synthetic_claims_csv", "property_claims_csv", "csv"),
    _landed("property/fema_nfip_claims_bulk", "property_fema_claims_csv", "csv"),
    _landed("property/fema_nfip_policies_bulk", "property_fema_policies_csv", "csv"),
    _landed("workers_comp/synthetic_policies_csv", "workers_comp_policies_csv", "csv"),
    _landed("auto/synthetic_policies_csv", "auto_policies_csv", "csv"),
    _landed("auto/synthetic_claims_csv", "auto_claims_csv", "csv"),
    _landed("general_liability/synthetic_policies_csv", "general_liability_policies_csv", "csv"),
    _landed("umbrella/synthetic_policies_csv", "umbrella_policies_csv", "csv"),
    _landed("umbrella/synthetic_claims_csv", "umbrella_claims_csv", "csv"),
)
SEMI_STRUCTURED = (
    _landed("property/synthetic_policies_json", "property_policies_json", "json"),
    _landed("property/synthetic_claims_json", "property_claims_json", "json"),
    SourceSpec(
        "property/fema_nfip_claims", "property_fema_claims_json", "envelope",
        flood_schema("claims"), multiline=True,
    ),
    SourceSpec(
        "property/fema_nfip_policies", "property_fema_policies_json", "envelope",
        flood_schema("policies"), multiline=True,
    ),
    _landed("workers_comp/synthetic_claims_json", "workers_comp_claims_json", "json"),
    _landed("auto/synthetic_policies_json", "auto_policies_json", "json"),
    _landed("general_liability/synthetic_claims_json", "general_liability_claims_json", "json"),
    _landed("umbrella/synthetic_policies_json", "umbrella_policies_json", "json"),
)


def text_schema(table: str) -> T.StructType | None:
    """All-string schema of a Bronze table that Silver reads.

    JSON read with it needs no inference pass over the data and has the same types as the
    CSV that carries the same columns.
    """
    for spec in silver_specs():
        if table in spec.sources:
            return all_strings(spec.columns.fieldNames())
    return None


def read_source(spark: SparkSession, source: SourceSpec, base: str = "") -> DataFrame:
    """The rows of a source, nothing left out: what a declaration lacks is in ``_rest``, what
    cannot be parsed in ``_corrupt_record``."""
    path = f"{base}/{source.path}" if base else source.path
    if source.fmt == "envelope":
        return page_records(_pages(spark, source, path), source.schema)
    if source.fmt == "csv" and source.schema is None:
        return read_csv_ranges(spark, path, corrupt=CORRUPT)
    schema = source.schema
    if schema is None and source.fmt == "json":
        schema = text_schema(source.table)
    if source.fmt == "json" and schema is not None:
        return read_documents(spark, path, schema, source.multiline)
    options: dict = {"multiline": source.multiline} if source.fmt in ("csv", "json") else {}
    if schema is not None:
        options["schema"] = schema
    return read_files(spark, source.fmt, path, **options)


def _pages(spark: SparkSession, source: SourceSpec, path: str) -> DataFrame:
    return stage_pages(spark, path, source.records_key, source.multiline)


def ingest_source(
    spark: SparkSession,
    source: SourceSpec,
    base: str,
    write: Callable[[DataFrame, str], None],
    batch_id: str | None = None,
    ingested_at: datetime | None = None,
) -> None:
    """Read one source, stamp it and write its Bronze table; of API pages also a ledger of them."""
    origin = f"{base}/{source.path}" if base else source.path
    if source.fmt == "envelope":
        pages = _pages(spark, source, origin)
        df = page_records(pages, source.schema)
        ledger = add_metadata_columns(page_ledger(pages), origin, source.fmt, batch_id, ingested_at)
        write(ledger, f"{source.table}{LEDGER}")
    else:
        df = read_source(spark, source, base)
    write(add_metadata_columns(df, origin, source.fmt, batch_id, ingested_at), source.table)


def ingest_single(
    spark: SparkSession,
    path: str,
    table: str,
    fmt: str = "csv",
    multiline: bool = True,
    batch_id: str | None = None,
    ingested_at: datetime | None = None,
) -> None:
    """Load one source outside the manifest into a catalog table."""
    source = SourceSpec(path, table, fmt, multiline=multiline)
    ingest_source(spark, source, "", write_table, batch_id, ingested_at)


def ingest_all(
    spark: SparkSession,
    sources: Sequence[SourceSpec],
    base: str,
    write: Callable[[DataFrame, str], None],
    batch_id: str | None = None,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Load every source and report per source whether it was loaded.

    A source whose files are missing is skipped with the reason; a failing write raises.
    """

    def load(source: SourceSpec) -> tuple[str, str, str, str | None]:
        try:
            ingest_source(spark, source, base, write, batch_id, ingested_at)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error.getCondition()):
                raise
            return source.table, source.fmt, "skipped", error.getCondition()
        return source.table, source.fmt, "loaded", None

    with ThreadPoolExecutor(CONCURRENT_LOADS) as pool:
        rows = list(pool.map(load, sources))
    return literal_relation(spark, rows, STATUS_DDL)
