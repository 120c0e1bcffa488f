"""Bronze to Silver: one recipe for every table, driven by its spec."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import safe_cast, typed_null
from strata.functions.names import standardize_column_names
from strata.operators.dedup import INGESTED, deduplicate
from strata.operators.quality import DataQualityChecker
from strata.operators.sets import common_column_union
from strata.specs.lines import Line, TableSpec


def cast_to_spec(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed canonical columns in one projection; absent ones become typed NULL."""
    present = set(raw.columns)
    columns = []
    for f in spec.columns.fields:
        if f.name in present:
            value = safe_cast(F.col(f.name), f.dataType, upper=f.name in spec.upper)
            if f.name == spec.key:
                value = F.nullif(value, F.lit(""))  # a blank key is no key
        else:
            value = typed_null(f.dataType)
        columns.append(value.alias(f.name))
    ingested = F.col(INGESTED).try_cast("timestamp") if INGESTED in present else typed_null("timestamp")
    typed = raw.select(*columns, ingested.alias(INGESTED))
    if not spec.derived:
        return typed
    return typed.select(
        *[F.expr(spec.derived[c]).alias(c) if c in spec.derived else F.col(c) for c in typed.columns]
    )


def check_quality(df: DataFrame, spec: TableSpec) -> DataFrame:
    checker = DataQualityChecker(df)
    for kind, column, name, *argument in spec.checks:
        if kind == "not_null":
            checker.check_not_null(column, name)
        elif kind == "positive":
            checker.check_positive(column, name)
        elif kind == "in_set":
            checker.check_in_set(column, argument[0], name)
        elif kind == "less_equal":
            checker.check_less_than_or_equal(column, argument[0], name)
        else:
            raise ValueError(f"{spec.name}: unknown check {kind!r}")
    return checker.apply()


def build_silver(spec: TableSpec, sources: Sequence[DataFrame | None]) -> DataFrame | None:
    """Union the sources, normalise names, type, keep the newest row per key, flag.

    Rows without a key all stay and are flagged; Gold leaves them out.  The only shuffle is the one on the key.
    """
    named = [standardize_column_names(s) for s in sources if s is not None]
    raw = common_column_union(*named)
    if raw is None:
        return None
    latest = deduplicate(cast_to_spec(raw, spec), [spec.key], keep_null_keys=True)
    flagged = check_quality(latest, spec)
    return flagged.select(*spec.schema.fieldNames())


def build_line(line: Line, bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Both Silver tables of a line, from whichever Bronze tables exist."""
    built = {}
    for spec in (line.policies, line.claims):
        silver = build_silver(spec, [bronze.get(s) for s in spec.sources])
        if silver is not None:
            built[spec.name] = silver
    return built
