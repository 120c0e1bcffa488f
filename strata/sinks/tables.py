"""Catalog tables: overwrite, append, partitioned layout and upsert.

A table other than Delta is replaced by writing a new version into a folder of its own and
then pointing the name at it: in one step where columns and layout stay as they are, else by
dropping the name and giving it to the new version (:func:`recover_table` finishes what ended in
between).  Nothing is moved or deleted: a job that fails, however late, leaves the old version in place, a rerun never meets its leftovers, and a table may be read
by the query that replaces it.  Versions no longer named stay below the table's folder, as
with Delta, until the site's retention removes them (:func:`current_location` tells which
one is live).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.dedup import deduplicate

STAGED = "__staged_"
MERGED = "__merged_"
#: Keys are hexadecimal hashes; entropy coding halves them, which Spark's default (Snappy) cannot.
COMPRESSION = "zstd"


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
    merge_keys: Sequence[str] = (),
) -> None:
    """Write a frame as table ``schema.table``.

    ``mode="merge"`` needs ``merge_keys``.  ``bucket_by=(n, columns)`` stores the rows hashed
    and sorted by the columns, so later joins and aggregations on them need no shuffle.
    """
    if mode == "merge":
        if not merge_keys:
            raise ValueError("merge needs merge_keys")
        upsert(df, name, merge_keys, fmt, partition_by)
        return
    spark = df.sparkSession
    if partition_by:
        # Rows of one partition value meet in a few tasks (AQE splits large ones), so the
        # write makes large files instead of one per task and value.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        buckets, columns = bucket_by
        writer = writer.bucketBy(buckets, *columns).sortBy(*columns)
    if fmt == "delta" or (mode == "append" and spark.catalog.tableExists(name)):
        writer.mode(mode).saveAsTable(name)
        return
    version = uuid.uuid4().hex
    schema, table = name.rsplit(".", 1)
    root = spark.catalog.getDatabase(schema).locationUri.rstrip("/")
    if not partition_by and not bucket_by and _same_shape(df, name):
        writer.save(f"{root}/{table}/{version}")
        _point_to(spark, name, f"{root}/{table}/{version}")
        return
    staged = f"{name}{STAGED}{version}"
    writer.option("path", f"{root}/{table}/{version}").saveAsTable(staged)
    _take_name(spark, staged, name)


def write_slices(spark: SparkSession, frames: Iterable[DataFrame], name: str, fmt: str = "parquet") -> None:
    """Replace a table by the rows of all frames, each written before the next one is asked for.

    The name is pointed at the new version only when the last frame is written.  Without any
    frame nothing changes.
    """
    if fmt == "delta":
        for i, df in enumerate(frames):
            write_table(df, name, "append" if i else "overwrite", fmt)
        return
    version = uuid.uuid4().hex
    schema, table = name.rsplit(".", 1)
    path = f"{spark.catalog.getDatabase(schema).locationUri.rstrip('/')}/{table}/{version}"
    last = None
    for last in frames:
        writer = last.write.format(fmt).mode("append")
        if fmt == "parquet":
            writer = writer.option("compression", COMPRESSION)
        writer.save(path)
    if last is None:
        return
    if _same_shape(last, name):
        _point_to(spark, name, path)
        return
    staged = f"{name}{STAGED}{version}"
    spark.catalog.createTable(staged, path, fmt, last.schema)
    _take_name(spark, staged, name)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size; for a table read whole, that of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _same_shape(df: DataFrame, name: str) -> bool:
    """Is there such a table, with the same columns and neither partitions nor buckets?"""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        return False
    if any(c.isPartition or c.isBucket for c in spark.catalog.listColumns(name)):
        return False
    shape = lambda frame: [(f.name, f.dataType) for f in frame.schema.fields]
    return shape(df) == shape(spark.table(name))


def _point_to(spark: SparkSession, name: str, path: str) -> None:
    """Move the name to another folder in one step: a reader finds the old rows or the new ones."""
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    spark.catalog.refreshTable(name)


def _take_name(spark: SparkSession, staged: str, name: str) -> None:
    """Point the name at a staged version; both steps touch the catalog only."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")


def _staged_versions(spark: SparkSession, name: str) -> list[str]:
    """Complete versions that never took the name: a table is listed only once written."""
    schema, table = name.rsplit(".", 1)
    listed = spark.catalog.listTables(schema)
    return [f"{schema}.{t.name}" for t in listed if t.name.startswith(f"{table}{STAGED}")]


def recover_table(spark: SparkSession, name: str) -> bool:
    """Finish a replacement that ended between its two catalog steps; is the table there?"""
    if spark.catalog.tableExists(name):
        return True
    staged = _staged_versions(spark, name)
    if len(staged) > 1:
        raise RuntimeError(
            f"{name} is gone and several versions wait for its name; keep one of: {', '.join(staged)}"
        )
    for version in staged:
        _take_name(spark, version, name)
    return bool(staged)


def current_location(spark: SparkSession, name: str) -> str:
    """Folder of the version the name points at."""
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    return details.first().data_type


def upsert(
    source: DataFrame,
    target: str,
    keys: Sequence[str],
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    order_column: str | None = None,
) -> None:
    """Update all columns of matching keys, insert the rest; create the table if absent.

    With ``order_column`` the newest row of a key wins, be it the target's or the source's, so
    late rows change nothing.  NULL keys match nothing.  A source holding one key twice fails the query and leaves the
    target as it was.  Delta tables use MERGE.  Where the partition columns belong to the
    key, only the partitions the source touches are rewritten.
    """
    spark = source.sparkSession
    checked = _unique_source(source, keys)
    if not recover_table(spark, target):
        write_table(checked, target, "overwrite", fmt, partition_by)
    elif fmt == "delta":
        _delta_merge(source, target, keys, order_column)
    elif partition_by and set(partition_by) <= set(keys):
        _merge_partitions(source, checked, target, keys, fmt, partition_by, order_column)
    else:
        merged = _merged(spark.table(target), source, checked, keys, order_column)
        write_table(merged, target, "overwrite", fmt, partition_by)


def _merged(
    target: DataFrame,
    source: DataFrame,
    checked: DataFrame,
    keys: Sequence[str],
    order_column: str | None,
) -> DataFrame:
    """Target rows without a match, and all source rows; or of both the newest per key."""
    if order_column is not None:
        both = target.unionByName(checked.select(*target.columns))
        return deduplicate(both, keys, order_column, keep_null_keys=True)
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(checked.select(*target.columns))


def _unique_source(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source, with a check at run time that no key repeats (NULL keys may)."""
    counts = source.groupBy(*keys).agg(F.count("*").alias("__rows"))
    for k in keys:
        counts = counts.filter(F.col(k).isNotNull())
    text = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    stop = F.raise_error(F.concat(F.lit("source repeats the merge key "), text))
    # A repeated key raises here; without one the filter leaves no row to add.
    failed = counts.filter(F.when(F.col("__rows") > 1, stop.cast("string")).isNotNull())
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema.fields]
    return source.unionByName(failed.select(*empty))


def _merge_partitions(
    source: DataFrame,
    checked: DataFrame,
    target: str,
    keys: Sequence[str],
    fmt: str,
    partition_by: Sequence[str],
    order_column: str | None,
) -> None:
    """Rewrite only the partitions the source touches.

    The merged rows are written first, because a table cannot be overwritten while it is
    read.  A run that fails in between is repeated with the same outcome.
    """
    spark = source.sparkSession
    merged_rows = f"{target}{MERGED}{uuid.uuid4().hex}"
    # NULL is a partition of its own: the overwrite replaces it, so it has to be found as well.
    touched = source.select(*[F.col(c).alias(f"__touched_{c}") for c in partition_by]).distinct()
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__touched_{c}")) for c in partition_by])
    affected = spark.table(target).join(touched, same, "left_semi")
    merged = _merged(affected, source, checked, keys, order_column)
    write_table(merged, merged_rows, "overwrite", fmt, partition_by)
    columns = spark.table(target).columns
    # insertInto takes the overwrite mode from the session only, and another thread may be
    # writing through this one: use a session of its own.
    writer = spark.newSession()
    writer.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    writer.table(merged_rows).select(*columns).write.mode("overwrite").insertInto(target)
    spark.catalog.refreshTable(target)
    spark.sql(f"DROP TABLE {merged_rows}")


def _delta_merge(
    source: DataFrame, target: str, keys: Sequence[str], order_column: str | None
) -> None:
    from delta.tables import DeltaTable  # only on clusters that ship Delta

    condition = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
    merge = DeltaTable.forName(source.sparkSession, target).alias("t")
    merge = merge.merge(source.alias("s"), condition)
    newer = f"s.`{order_column}` >= t.`{order_column}`" if order_column else None
    merge.whenMatchedUpdateAll(newer).whenNotMatchedInsertAll().execute()


def create_schemas(
    spark: SparkSession, schemas: dict[str, str], location: str | None = None
) -> None:
    """Create the named schemas with their comments, below ``location`` if given."""
    for name, comment in schemas.items():
        place = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT '{comment}'{place}")


def row_counts(spark: SparkSession, schemas: Sequence[str]) -> DataFrame:
    """Rows per table of the schemas: one union of counts, one job, no driver loop over data."""
    listed = [
        (s, t.name)
        for s in schemas
        for t in spark.catalog.listTables(s)
        if STAGED not in t.name and MERGED not in t.name
    ]
    counts = [
        spark.table(f"{s}.{t}").agg(F.count("*").alias("row_count")).select(
            F.lit(s).alias("schema_name"), F.lit(t).alias("table_name"), "row_count"
        )
        for s, t in listed
    ]
    if not counts:
        return spark.createDataFrame(
            [], "schema_name string, table_name string, row_count bigint"
        )
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result.orderBy("schema_name", "table_name")
