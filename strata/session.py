"""Session settings and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings the plans are written for.  ANSI stays on: malformed input is
# handled with try_cast, so a real type error still surfaces.  The skew-join settings let
# AQE split a hot join key even when the result then needs one more shuffle.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Shuffle data one task should hold: it fits an executor core's share of memory with room
# for the sort, and keeps the task count of a 100 TB shuffle in the hundreds of thousands.
SHUFFLE_BYTES_PER_TASK = 256 * 1024**2
MIN_PARTITIONS, MAX_PARTITIONS = 200, 400_000


def sized_for(shuffle_bytes: int) -> dict[str, str]:
    """Settings for jobs whose largest shuffle moves about that many bytes.

    AQE starts from the computed number of partitions and joins small neighbours; it cannot
    split what a too small number has put together (other than skewed joins).
    """
    wanted = -(-shuffle_bytes // SHUFFLE_BYTES_PER_TASK)
    initial = min(max(wanted, MIN_PARTITIONS), MAX_PARTITIONS)
    return {
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_BYTES_PER_TASK),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(
            2 * SHUFFLE_BYTES_PER_TASK
        ),
    }


def get_spark(
    app_name: str = "strata",
    master: str | None = None,
    shuffle_partitions: int = 200,
    table_format: str = "parquet",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or return) a session; pass ``extra=sized_for(bytes)`` for large jobs.

    ``table_format="delta"`` adds the Delta extension and catalog; the Delta jars must then
    be on the classpath.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(SQL_SETTINGS)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if table_format == "delta":
        settings["spark.sql.extensions"] = "io.delta.sql.DeltaSparkSessionExtension"
        settings["spark.sql.catalog.spark_catalog"] = (
            "org.apache.spark.sql.delta.catalog.DeltaCatalog"
        )
    settings.update(extra or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Whether a query's shuffle files go when it ends (Spark 4.1); otherwise they stay until the driver
#: happens to collect its garbage, which a driver with little to do seldom does.
REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_removing: dict[str, tuple[int, str | None]] = {}
_removing_lock = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries of this session go as each query ends, while the block runs.

    For runs of many queries, each of which leaves a table: what one has shuffled is of no use to
    the next.  Blocks may overlap; the session's own setting is back when the last one ends.
    """
    session = spark._jsparkSession.sessionUUID()
    with _removing_lock:
        blocks, before = _removing.get(session) or (0, spark.conf.get(REMOVE_SHUFFLES, None))
        _removing[session] = (blocks + 1, before)
        spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _removing_lock:
            blocks, before = _removing.pop(session)
            if blocks > 1:
                _removing[session] = (blocks - 1, before)
            elif before is None:
                spark.conf.unset(REMOVE_SHUFFLES)
            else:
                spark.conf.set(REMOVE_SHUFFLES, before)


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: what ``spark.checkpoint.dir`` names.

    Only a local-mode session may fall back to a temporary folder; on a cluster a folder
    of one machine would be invisible to the others.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = os.path.join(tempfile.gettempdir(), "strata-shared")
    os.makedirs(local, exist_ok=True)
    return local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; never reused between runs."""
    return f"{shared_root(spark)}/strata/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
