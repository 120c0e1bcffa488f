"""Key resolution, existence flags and orphans.

No lookup is broadcast by hint: its size is the user's, so Spark decides from the measured
size (``autoBroadcastJoinThreshold``, or AQE at run time) and splits skewed partitions.
``broadcast`` is used only by :func:`constant_lookup`, whose rows are literals in the code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import typed_null
from strata.sources.readers import literal_relation

# Upper bound on the rows of a literal relation that may be broadcast.
MAX_CONSTANT_ROWS = 1000


def resolve_key(
    df: DataFrame,
    column: str,
    lookup: DataFrame | None,
    lookup_key: str,
    take: Sequence[str] | dict[str, str],
    validate: bool = True,
    spread_nulls: Sequence[str] = (),
) -> DataFrame:
    """Left join that swaps a natural key for columns of its dimension row.

    ``take`` lists lookup columns, or maps them to output names.  An absent lookup gives
    typed NULL strings.  With ``validate`` a lookup holding one key twice fails the query
    instead of multiplying rows.  ``spread_nulls`` names columns whose hash takes the place
    of a NULL string key, so rows without a reference do not all meet in one partition.
    """
    outputs = dict(take) if isinstance(take, dict) else {c: c for c in take}
    if lookup is None:
        return df.select("*", *[typed_null("string").alias(o) for o in outputs.values()])
    picked = [F.col(c).alias(o) for c, o in outputs.items()]
    side = lookup.select(F.col(lookup_key).alias("__lookup"), *picked)
    side = side.filter("__lookup IS NOT NULL")
    if validate:
        firsts = [F.first(o).alias(o) for o in outputs.values()]
        side = side.groupBy("__lookup").agg(F.count("*").alias("__rows"), *firsts)
        message = F.concat(F.lit(f"lookup key {lookup_key} is not unique: "), "__lookup")
        checked = F.when(F.col("__rows") > 1, F.raise_error(message)).otherwise(F.col("__lookup"))
        side = side.select(checked.alias("__lookup"), *outputs.values())
    if not spread_nulls:
        return df.join(side, F.col(column) == F.col("__lookup"), "left").drop("__lookup")
    # No real key starts with the NUL character, so these never match.
    filler = F.concat(F.lit("\u0000"), F.xxhash64(*spread_nulls).cast("string"))
    probe = df.withColumn("__probe", F.coalesce(F.col(column), filler))
    joined = probe.join(side, F.col("__probe") == F.col("__lookup"), "left")
    return joined.drop("__lookup", "__probe")


def constant_lookup(
    df: DataFrame, column: str, rows: Sequence[tuple[str, str]], value: str
) -> DataFrame:
    """Left join to (code, value) literals; broadcast because the rows are counted here."""
    if len(rows) > MAX_CONSTANT_ROWS:
        raise ValueError(f"{len(rows)} literal rows; use a table and resolve_key")
    side = literal_relation(df.sparkSession, rows, f"__lookup string, {value} string")
    return df.join(F.broadcast(side), F.col(column) == F.col("__lookup"), "left").drop("__lookup")


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_CONSTANT_ROWS) -> DataFrame:
    """The frame with a broadcast hint if it has at most ``max_rows`` rows, else unchanged.

    The check reads no more than ``max_rows + 1`` rows.  Use it for lookups with few distinct
    keys, where a shuffle would put all rows into a few partitions.
    """
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def with_exists_flag(
    df: DataFrame, column: str, reference: DataFrame, ref_column: str, flag: str
) -> DataFrame:
    """Add a boolean: does the value occur in the reference?  NULL never does.

    Each row with NULL has a number of its own as a second key, so these rows spread over all
    partitions instead of meeting in one.
    """
    refs = reference.select(F.col(ref_column).alias("__ref")).filter("__ref IS NOT NULL")
    refs = refs.distinct().select("__ref", F.lit(0).cast("bigint").alias("__place"), F.lit(True).alias("__hit"))
    alone = F.when(F.col(column).isNull(), F.monotonically_increasing_id()).otherwise(0)
    rows = df.withColumn("__alone", alone)
    same = (F.col(column) == F.col("__ref")) & (F.col("__alone") == F.col("__place"))
    joined = rows.join(refs, same, "left")
    return joined.select(
        *[F.col(c) for c in df.columns], F.coalesce(F.col("__hit"), F.lit(False)).alias(flag)
    )


def orphans(
    df: DataFrame, column: str, reference: DataFrame, ref_column: str, allow_null: bool = True
) -> DataFrame:
    """Rows whose key has no match in the reference."""
    rows = df.filter(F.col(column).isNotNull()) if allow_null else df
    refs = reference.select(F.col(ref_column).alias("__ref"))
    return rows.join(refs, F.col(column) == F.col("__ref"), "left_anti")


def with_roles(
    df: DataFrame, date_keys: dict[str, str], calendar: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """Join one calendar under several roles: ``{date key column: prefix}``."""
    for key, prefix in date_keys.items():
        take = {c: f"{prefix}_{c}" for c in columns}
        df = resolve_key(df, key, calendar, "date_key", take, validate=False)
    return df
