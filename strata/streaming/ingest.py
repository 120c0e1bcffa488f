"""Incremental loads with Structured Streaming.

``availableNow`` drains what has arrived and stops; the checkpoint remembers what was read,
so a run repeated after a failure neither loses nor doubles rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.operators.dedup import deduplicate
from strata.sinks.tables import upsert
from strata.sinks.versions import VersionedTable


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "json",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Landed files as a stream; the schema is given, never inferred."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    source_format: str = "json",
    batch_id: str = "stream",
) -> StreamingQuery:
    """Append the stream to Parquet with audit columns, exactly once."""
    stamped = stream.select(
        "*",
        F.current_timestamp().alias("_ingestion_timestamp"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(source_format).alias("_source_format"),
        F.lit(batch_id).alias("_batch_id"),
    )
    writer = stamped.writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.start(path)


def upsert_stream(
    stream: DataFrame,
    target: str,
    keys: Sequence[str],
    order_column: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Merge each micro-batch into a table: the newest row per key wins, whichever batch it is in.

    Replaying a batch gives the same table, so a batch repeated after a crash is harmless; only
    rows without a key are added again, as nothing tells them apart.  With partition columns
    that belong to the key a batch rewrites only the partitions it touches.
    """

    def merge(batch: DataFrame, _: int) -> None:
        newest = deduplicate(batch, keys, order_column, keep_null_keys=True)
        upsert(newest, target, keys, fmt, partition_by, order_column)

    writer = stream.writeStream.foreachBatch(merge)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_stream_versioned(
    stream: DataFrame, target: VersionedTable, order_column: str, checkpoint: str
) -> StreamingQuery:
    """Merge each micro-batch into a versioned table: the newest row per key wins.

    A batch is written once and rewrites only the files that hold one of its keys; readers see
    the version before it or the one after it.  Replays are harmless as in :func:`upsert_stream`.
    """

    def merge(batch: DataFrame, _: int) -> None:
        # Micro-batches run in a session of their own.
        table = VersionedTable(batch.sparkSession, target.root, target.keys)
        table.upsert(deduplicate(batch, table.keys, order_column, keep_null_keys=True), order_column)

    writer = stream.writeStream.foreachBatch(merge)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drain(query: StreamingQuery, spark: SparkSession, table: str | None = None) -> None:
    """Wait for an ``availableNow`` query and raise what stopped it.

    Micro-batches run in a session of their own; ``table`` is refreshed in the caller's, so
    the next read there does not look for files the merge has replaced.
    """
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    if table is not None and spark.catalog.tableExists(table):
        spark.catalog.refreshTable(table)
