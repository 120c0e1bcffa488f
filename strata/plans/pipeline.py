"""The layers in order, with tables as the hand-off between them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.operators.quality import VALID
from strata.plans import dimensions as dims
from strata.plans import facts
from strata.plans.mart import mart_policy_360, slice_of
from strata.plans.silver import build_silver
from strata.session import scratch_path, shuffles_removed
from strata.sinks.tables import (
    COMPRESSION,
    create_schemas,
    estimated_bytes,
    recover_table,
    row_counts,
    write_slices,
    write_table,
)
from strata.sources.manifest import CONCURRENT_LOADS, SEMI_STRUCTURED, STRUCTURED, ingest_all
from strata.sources.readers import literal_relation, optional_table
from strata.specs.lines import LINES, Line, silver_specs
from strata.specs.reference import COVERAGES, LINES_OF_BUSINESS

LAYER_COMMENTS = {
    "bronze": "Raw data as landed, with audit columns",
    "silver": "Typed, deduplicated and quality-flagged tables",
    "gold": "Star schema and policy mart",
}


#: Stored bytes of the mart's inputs for each slice it is written in, and the most slices: each
#: of them reads the inputs once more.
MART_SLICE_BYTES = 64 * 1024**2
MAX_MART_SLICES = 8

WRITTEN_DDL = """layer string, table_name string, row_count bigint, invalid_rows bigint,
    key_checksum decimal(38,0), content_checksum decimal(38,0)"""


def with_metrics(df: DataFrame, watched: Observation) -> DataFrame:
    """The frame, whose rows are counted in the very task that writes them.

    Both checksums are sums over the rows, so the order of rows does not matter: one of 32 bits of
    the MD5 of the first column as text (any engine can repeat it), one of all columns' hash.
    """
    key = F.coalesce(F.col(f"`{df.columns[0]}`").cast("string"), F.lit(""))
    part = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("decimal(38,0)")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    invalid = F.count_if(~F.col(VALID)) if VALID in df.columns else F.count_if(F.lit(False))
    return df.observe(
        watched, F.count(F.lit(1)).alias("row_count"), invalid.alias("invalid_rows"),
        F.sum(part).alias("key_checksum"), F.sum(whole).alias("content_checksum"),
    )


@dataclass
class Layers:
    """The three schemas of a run.  ``prefix`` keeps runs apart in one catalog."""

    spark: SparkSession
    prefix: str = ""
    location: str | None = None
    fmt: str = "parquet"
    #: Count rows and checksums while writing; :meth:`written` lists them.
    observe: bool = False
    metrics: dict[tuple[str, str], dict] = field(default_factory=dict)

    def schema(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def create(self) -> Layers:
        schemas = {self.schema(layer): text for layer, text in LAYER_COMMENTS.items()}
        create_schemas(self.spark, schemas, self.location)
        return self

    def name(self, layer: str, table: str) -> str:
        return f"{self.schema(layer)}.{table}"

    def write(self, layer: str, table: str, df: DataFrame, **options) -> DataFrame:
        if self.observe:
            watched = Observation()
            write_table(with_metrics(df, watched), self.name(layer, table), fmt=self.fmt, **options)
            self.metrics[layer, table] = watched.get
            return self.spark.table(self.name(layer, table))
        write_table(df, self.name(layer, table), fmt=self.fmt, **options)
        return self.spark.table(self.name(layer, table))

    def write_slices(self, layer: str, table: str, slices: Iterable[DataFrame]) -> None:
        """One table from frames that are built and written one after the other."""
        watched: list[Observation] = []

        def each() -> Iterator[DataFrame]:
            for df in slices:
                if self.observe:
                    watched.append(Observation())
                    df = with_metrics(df, watched[-1])
                yield df

        write_slices(self.spark, each(), self.name(layer, table), fmt=self.fmt)
        if watched:
            found = [w.get for w in watched]
            self.metrics[layer, table] = {k: sum(m[k] or 0 for m in found) for k in found[0]}

    def optional(self, layer: str, table: str) -> DataFrame | None:
        # A replacement that ended half-way must not look like a table that never was.
        recover_table(self.spark, self.name(layer, table))
        return optional_table(self.spark, self.name(layer, table))

    def existing(self, layer: str, tables: Sequence[str]) -> dict[str, DataFrame]:
        found = {t: self.optional(layer, t) for t in tables}
        return {t: df for t, df in found.items() if df is not None}

    def written(self) -> DataFrame:
        """What was counted while writing, one row per table; no table is read for it."""
        rows = [
            (layer, table, m["row_count"], m["invalid_rows"], int(m["key_checksum"] or 0), int(m["content_checksum"] or 0))
            for (layer, table), m in sorted(self.metrics.items())
        ]
        return literal_relation(self.spark, rows, WRITTEN_DDL)

    def counts(self) -> DataFrame:
        return row_counts(self.spark, [self.schema(layer) for layer in LAYER_COMMENTS])


def _write_all(
    layers: Layers, layer: str, builders: dict[str, Callable[[], DataFrame | None]]
) -> None:
    """Build and write independent tables; absent inputs give no table."""

    def build(item: tuple[str, Callable[[], DataFrame | None]]) -> None:
        table, builder = item
        df = builder()
        if df is not None:
            layers.write(layer, table, df)

    with ThreadPoolExecutor(CONCURRENT_LOADS) as pool:
        list(pool.map(build, builders.items()))


def run_bronze(
    layers: Layers,
    landing: str,
    batch_id: str | None = None,
    ingested_at: datetime | None = None,
) -> DataFrame:
    """Ingest the whole manifest; returns the status per source."""
    return ingest_all(
        layers.spark,
        (*STRUCTURED, *SEMI_STRUCTURED),
        landing,
        lambda df, table: layers.write("bronze", table, df) and None,
        batch_id,
        ingested_at,
    )


def run_silver(
    layers: Layers,
    lines: Sequence[Line] = LINES,
    bronze: Callable[[str], DataFrame | None] | None = None,
) -> None:
    """All Silver tables of the lines.  ``bronze`` replaces the Bronze tables as source."""
    read = bronze or (lambda table: layers.optional("bronze", table))
    _write_all(
        layers,
        "silver",
        {
            spec.name: lambda spec=spec: build_silver(spec, [read(s) for s in spec.sources])
            for spec in silver_specs(tuple(lines))
        },
    )


def silver_tables(layers: Layers, lines: Sequence[Line] = LINES) -> dict[str, DataFrame]:
    return layers.existing("silver", [spec.name for spec in silver_specs(tuple(lines))])


def keyed_silver(layers: Layers, lines: Sequence[Line] = LINES) -> dict[str, DataFrame]:
    """The Silver tables as Gold reads them: without the rows that have no key."""
    keys = {spec.name: spec.key for spec in silver_specs(tuple(lines))}
    found = silver_tables(layers, lines)
    return {name: df.filter(F.col(keys[name]).isNotNull()) for name, df in found.items()}


def run_dimensions(
    layers: Layers,
    lines: Sequence[Line] = LINES,
    lob_rows: Sequence[tuple] = LINES_OF_BUSINESS,
    coverage_rows: Sequence[tuple] = COVERAGES,
) -> None:
    spark, silver = layers.spark, keyed_silver(layers, lines)
    _write_all(
        layers,
        "gold",
        {
            "dim_date": lambda: dims.dim_date(spark),
            "dim_line_of_business": lambda: dims.dim_line_of_business(spark, lob_rows),
            "dim_insured": lambda: dims.dim_insured(silver, lines),
            "dim_location": lambda: dims.dim_location(silver, lines),
            "dim_agent": lambda: dims.dim_agent(silver, lines),
            "dim_coverage": lambda: dims.dim_coverage(
                spark, dims.dim_line_of_business(spark, lob_rows), coverage_rows
            ),
            "dim_policy": lambda: dims.dim_policy(silver, lines),
        },
    )
    # Claims refer to the policies just written.
    policies = layers.optional("gold", "dim_policy")
    _write_all(
        layers, "gold", {"dim_claim": lambda: dims.dim_claim(silver, policies, lines)}
    )


def run_facts(layers: Layers, lines: Sequence[Line] = LINES) -> None:
    silver = keyed_silver(layers, lines)
    policies = layers.optional("gold", "dim_policy")
    _write_all(
        layers,
        "gold",
        {
            "fact_premium": lambda: facts.fact_premium(silver, lines),
            "fact_claim_transaction": lambda: facts.fact_claim_transaction(
                silver, policies, lines
            ),
            "fact_policy_transaction": lambda: facts.fact_policy_transaction(silver, lines),
        },
    )


GOLD_INPUTS = (
    "dim_policy",
    "dim_insured",
    "dim_line_of_business",
    "dim_agent",
    "dim_location",
    "fact_premium",
    "fact_claim_transaction",
    "dim_claim",
)


def build_mart(layers: Layers, as_of: date, lines: Sequence[Line] = LINES) -> DataFrame | None:
    """The mart over whatever Gold and Silver tables exist."""
    gold = layers.existing("gold", GOLD_INPUTS)
    return mart_policy_360(gold, keyed_silver(layers, lines), as_of, lines)


def mart_slices(
    layers: Layers, as_of: date, lines: Sequence[Line] = LINES, slices: int | None = None
) -> Iterator[DataFrame]:
    """The rows of :func:`build_mart` in frames by a hash of the policy key, to be written in turn.

    All joins are on that key, or on keys of the policy's own row, so a slice needs only its
    share of the tables at policy grain, and only that share lies in shuffle files at a time.
    Each slice reads the tables again; small ones are therefore taken in one.
    """
    gold, silver = layers.existing("gold", GOLD_INPUTS), keyed_silver(layers, lines)
    if slices is None:
        held = sum(estimated_bytes(df) for df in (*gold.values(), *silver.values()))
        slices = min(max(1, held // MART_SLICE_BYTES), MAX_MART_SLICES)
    for i in range(slices):
        if slices > 1:
            shares = slice_of(gold, silver, i, slices)
        else:
            shares = gold, silver
        mart = mart_policy_360(*shares, as_of, lines)
        if mart is not None:
            yield mart


def run_mart(layers: Layers, as_of: date, lines: Sequence[Line] = LINES) -> None:
    layers.write_slices("gold", "mart_policy_360", mart_slices(layers, as_of, lines))


def staged_mart(layers: Layers, as_of: date, lines: Sequence[Line] = LINES) -> DataFrame | None:
    """The rows of :func:`build_mart` from a scratch folder, written there slice by slice."""
    spark, found = layers.spark, None
    path = scratch_path(spark, "mart")
    with shuffles_removed(spark):
        for part in mart_slices(layers, as_of, lines):
            found = part.schema
            part.write.mode("append").option("compression", COMPRESSION).parquet(path)
    return None if found is None else spark.read.schema(found).parquet(path)


def run_pipeline(
    layers: Layers,
    as_of: date,
    landing: str | None = None,
    bronze: Callable[[str], DataFrame | None] | None = None,
    lines: Sequence[Line] = LINES,
    lob_rows: Sequence[tuple] = LINES_OF_BUSINESS,
    coverage_rows: Sequence[tuple] = COVERAGES,
    batch_id: str | None = None,
    ingested_at: datetime | None = None,
    release: Callable[[], None] | None = None,
) -> DataFrame:
    """Bronze to mart; returns the row count of every table, or what ``layers`` observed.

    ``release`` is called as soon as the source is not read any more: ``landing`` once Bronze
    is written, ``bronze`` once Silver is.
    """
    layers.create()
    with shuffles_removed(layers.spark):
        if landing is not None:
            run_bronze(layers, landing, batch_id, ingested_at)
            if release is not None and bronze is None:
                release()
        run_silver(layers, lines, bronze)
        if release is not None and bronze is not None:
            release()
        run_dimensions(layers, lines, lob_rows, coverage_rows)
        run_facts(layers, lines)
        run_mart(layers, as_of, lines)
    return layers.written() if layers.observe else layers.counts()
