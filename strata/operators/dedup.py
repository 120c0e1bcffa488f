"""Latest-row selection and group sizes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

INGESTED = "_ingestion_timestamp"


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def deduplicate(
    df: DataFrame,
    key_columns: Sequence[str],
    order_column: str = INGESTED,
    ascending: bool = False,
    tie_breakers: Sequence[str] | None = None,
    keep_null_keys: bool = False,
) -> DataFrame:
    """One row per key: the first by ``order_column``, ties settled by every other column.

    The order is total, so the result does not depend on how rows are partitioned.  Spark
    turns ``row_number() = 1`` into a group limit that also runs *before* the shuffle: each
    map task sends at most one row per key, so a hot key never gathers in one task.

    NULL is a key like any other, unless ``keep_null_keys``: then rows with a NULL in any key
    column repeat nothing and all stay.  Each of them gets a number of its own as a further key, so
    the input is read once and such rows spread over all partitions.
    """
    if order_column not in df.columns:
        raise ValueError(f"order column {order_column!r} is missing; name one that exists")
    used = {*key_columns, order_column}
    if tie_breakers is None:
        rest = [f for f in df.schema.fields if f.name not in used]
        blocked = [f.name for f in rest if not _orderable(f.dataType)]
        if blocked:
            raise ValueError(f"columns {blocked} have no order; pass tie_breakers")
        tie_breakers = [f.name for f in rest]
    first = F.col(order_column)
    first = first.asc_nulls_first() if ascending else first.desc_nulls_last()
    order = [first, *[F.col(c).asc_nulls_first() for c in tie_breakers]]
    if not keep_null_keys:
        rank = F.row_number().over(Window.partitionBy(*key_columns).orderBy(*order))
        return df.withColumn("__rank", rank).filter("__rank = 1").drop("__rank")
    keyed = reduce(and_, [F.col(c).isNotNull() for c in key_columns])
    alone = F.when(~keyed, F.monotonically_increasing_id())
    rank = F.row_number().over(Window.partitionBy(*key_columns, "__alone").orderBy(*order))
    ranked = df.withColumn("__alone", alone).withColumn("__rank", rank).filter("__rank = 1")
    return ranked.drop("__alone", "__rank")


def repeated_keys(df: DataFrame, columns: Sequence[str], count_name: str) -> DataFrame:
    """Keys that occur more than once, with their size (counted map-side first)."""
    return df.groupBy(*columns).agg(F.count("*").alias(count_name)).filter(f"{count_name} > 1")


def with_group_size(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Add each row's group size.

    A count over a window would move all rows of a hot key into one task.  Here only the
    counts of repeated keys are joined back: AQE broadcasts them when they turn out small
    and splits a skewed partition otherwise.
    """
    sizes = repeated_keys(df, columns, "__size")
    keys = [f"__key_{i}" for i in range(len(columns))]
    sizes = sizes.select(
        *[F.col(c).alias(k) for c, k in zip(columns, keys)], F.col("__size")
    )
    condition = F.lit(True)
    for c, k in zip(columns, keys):
        condition = condition & F.col(c).eqNullSafe(F.col(k))
    joined = df.join(sizes, condition, "left")
    size = F.coalesce(F.col("__size"), F.lit(1).cast("bigint"))
    return joined.select(*[F.col(c) for c in df.columns], size.alias(name))
