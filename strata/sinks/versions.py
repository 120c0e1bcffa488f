"""Tables replaced in one step, whose upserts rewrite only the files that hold a changed key.

A table is a folder.  Data files and a list of them (with each file's number of rows and key range)
are written first; a version exists once its numbered commit file does, and that file is made by a
step that fails if the number is taken.  So of two writers one commits and the other starts again
from what it finds, a job that ends anywhere before leaves only files nobody lists, and a reader
sees one version or the next, never none.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.dedup import deduplicate
from strata.session import scratch_path

COMMITS, DATA, LISTS = "_commits", "data", "_files"
#: Times a writer starts again because another has committed meanwhile.
ATTEMPTS = 20


class Conflict(RuntimeError):
    """Another writer took the version's number."""


class VersionedTable:
    """A table below ``root``.  ``keys`` order its files, so that a key lies in few of them."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str]):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)

    # --- the commit log -----------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def versions(self) -> list[int]:
        fs, where = self._fs(f"{self.root}/{COMMITS}")
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def commit_of(self, version: int | None = None) -> dict | None:
        """The commit of a version, the newest by default; None for a table without any."""
        if version is None:
            known = self.versions()
            if not known:
                return None
            version = known[-1]
        fs, where = self._fs(self._commit_path(version))
        stream = fs.open(where)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _commit_path(self, version: int) -> str:
        return f"{self.root}/{COMMITS}/{version:020d}.json"

    def _commit(self, version: int, operation: str, files: str, schema: T.StructType, touched: int) -> None:
        """Take the version's number, or raise :class:`Conflict`."""
        content = json.dumps({
            "version": version, "operation": operation, "files": files,
            "schema": schema.jsonValue(), "rewritten": touched,
        })
        target = self._commit_path(version)
        draft = f"{self.root}/{COMMITS}/draft-{uuid.uuid4().hex}"
        fs, where = self._fs(draft)
        stream = fs.create(where, False)
        stream.write(bytearray(content.encode()))
        stream.close()
        try:
            self._take(draft, target)
        finally:
            fs.delete(where, False)

    def _take(self, draft: str, target: str) -> None:
        """Give the draft its final name in a step that fails where the name is taken."""
        fs, source = self._fs(draft)
        if fs.getScheme() == "file":
            # A local rename replaces; a link does not.
            try:
                os.link(urlparse(draft).path, urlparse(target).path)
            except FileExistsError as taken:
                raise Conflict(target) from taken
            return
        jvm = self.spark._jvm
        place = jvm.org.apache.hadoop.fs.Path(target)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark._jsc.hadoopConfiguration()
        )
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        none[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            context.rename(source, place, none)
        except Exception as failed:
            if fs.exists(place):
                raise Conflict(target) from failed
            raise

    # --- reading ------------------------------------------------------------------------

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version; its files are those of its list, whatever else lies there."""
        commit = self.commit_of(version)
        if commit is None:
            raise ValueError(f"{self.root} has no version")
        return self._rows(commit, [r.path for r in self.files(version).select("path").collect()])

    def files(self, version: int | None = None) -> DataFrame:
        """``path, n_rows, low, high``: the files of a version and their least and largest key."""
        return self.spark.read.parquet(self.commit_of(version)["files"])

    def row_count(self, version: int | None = None) -> int:
        """Rows of a version, known from its list of files."""
        return self.files(version).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]

    def _rows(self, commit: dict, paths: list[str]) -> DataFrame:
        schema = T.StructType.fromJson(commit["schema"])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # --- writing ------------------------------------------------------------------------

    def overwrite(self, df: DataFrame) -> int:
        """Replace all rows; returns the new version."""
        listed, path = self._write(df)
        return self._until_taken(lambda commit: ("overwrite", self._list(listed), df.schema, 0))

    def append(self, df: DataFrame) -> int:
        """Add rows; the columns must be those of the table."""
        listed, path = self._write(df)

        def add(commit: dict | None) -> tuple:
            if commit is None:
                return "append", self._list(listed), df.schema, 0
            schema = T.StructType.fromJson(commit["schema"])
            if [(f.name, f.dataType) for f in schema] != [(f.name, f.dataType) for f in df.schema]:
                raise ValueError("the rows to append have other columns than the table")
            old = self.spark.read.parquet(commit["files"])
            return "append", self._list(old.unionByName(listed)), schema, 0

        return self._until_taken(add)

    def upsert(self, source: DataFrame, order_column: str | None = None) -> int:
        """Update all columns of matching keys, insert the rest.

        The source is evaluated once.  Only files that hold one of its keys are rewritten, found by
        key ranges first and then by the keys themselves.  With ``order_column`` the newest row
        of a key wins, be it the table's or the source's.  NULL keys match nothing.  A source
        with a repeated key fails and leaves the table as it was.
        """
        path = scratch_path(self.spark, "upsert-source")
        source.write.parquet(path)
        staged = self.spark.read.schema(source.schema).parquet(path)
        keyed = reduce(and_, [F.col(k).isNotNull() for k in self.keys])
        repeated = staged.where(keyed).groupBy(*self.keys).count().where("count > 1").limit(1).collect()
        if repeated:
            raise ValueError(f"source repeats the merge key {tuple(repeated[0])[:-1]}")

        def merge(commit: dict | None) -> tuple:
            if commit is None:
                return "upsert", self._list(self._write(staged)[0]), staged.schema, 0
            schema = T.StructType.fromJson(commit["schema"])
            rows = staged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
            files = self.spark.read.parquet(commit["files"])
            touched = self._touched(commit, files, rows.where(keyed))
            old = self._rows(commit, touched)
            if order_column:
                merged = deduplicate(old.unionByName(rows), self.keys, order_column, keep_null_keys=True)
            else:
                merged = old.join(rows.select(*self.keys), self.keys, "left_anti").select(*rows.columns).unionByName(rows)
            kept = files.where(~F.col("path").isin(touched)) if len(touched) < 1000 else files.join(
                self.spark.createDataFrame([(p,) for p in touched], "path string"), "path", "left_anti"
            )
            return "upsert", self._list(kept.unionByName(self._write(merged)[0])), schema, len(touched)

        return self._until_taken(merge)

    def _touched(self, commit: dict, files: DataFrame, rows: DataFrame) -> list[str]:
        """Files that hold a key of the rows."""
        key = F.struct(*self.keys)
        # The rows' own ranges, one per task, leave out most files without reading them.
        spans = rows.repartitionByRange(*self.keys).groupBy(F.spark_partition_id()).agg(
            F.min(key).alias("first"), F.max(key).alias("last")
        )
        near = files.join(F.broadcast(spans), (F.col("first") <= F.col("high")) & (F.col("last") >= F.col("low")), "left_semi")
        paths = [r.path for r in near.select("path").collect()]
        held = self._rows(commit, paths).select(*self.keys, F.col("_metadata.file_path").alias("path")) if paths else None
        if held is None:
            return []
        found = held.join(rows.select(*self.keys), self.keys, "left_semi").select("path").distinct().collect()
        return sorted(r.path for r in found)

    def _write(self, df: DataFrame) -> tuple[DataFrame, str]:
        """Rows as files ordered by the key, and the list of these files."""
        path = f"{self.root}/{DATA}/{uuid.uuid4().hex}"
        df.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys).write.parquet(path)
        key = F.struct(*self.keys)
        # Only the key columns are read again.
        listed = self.spark.read.schema(df.schema).parquet(path).groupBy(F.col("_metadata.file_path").alias("path"))
        return listed.agg(F.count("*").alias("n_rows"), F.min(key).alias("low"), F.max(key).alias("high")), path

    def _list(self, files: DataFrame) -> str:
        path = f"{self.root}/{LISTS}/{uuid.uuid4().hex}"
        files.write.parquet(path)
        return path

    def _until_taken(self, build: Callable[[dict | None], tuple]) -> int:
        for _ in range(ATTEMPTS):
            commit = self.commit_of()
            version = commit["version"] + 1 if commit else 1
            made = build(commit)
            try:
                self._commit(version, *made)
            except Conflict:
                continue  # build on what the other writer has committed
            return version
        raise Conflict(f"{self.root}: {ATTEMPTS} attempts met other writers")

    # --- retention ----------------------------------------------------------------------

    def retain(self, versions: int, older_than_seconds: float = 7 * 86_400) -> int:
        """Forget all but the newest versions; returns the number of folders removed.

        Folders that no version kept lists are removed once nothing in them is younger than
        ``older_than_seconds``, which must exceed the longest write: a writer's files are not
        listed before it commits.
        """
        known = self.versions()
        kept = known[-versions:]
        lists, used = set(), set()
        for version in kept:
            lists.add(os.path.basename(self.commit_of(version)["files"]))
            folder = F.element_at(F.split("path", "/"), -2).alias("folder")
            used |= {r.folder for r in self.files(version).select(folder).distinct().collect()}
        for version in known[: -len(kept) or None]:
            fs, where = self._fs(self._commit_path(version))
            fs.delete(where, False)
        removed, clock = 0, self.spark._jvm.java.lang.System.currentTimeMillis()
        for kind, wanted in ((DATA, used), (LISTS, lists)):
            fs, where = self._fs(f"{self.root}/{kind}")
            for status in fs.listStatus(where) if fs.exists(where) else ():
                young = clock - status.getModificationTime() < older_than_seconds * 1000
                if status.getPath().getName() not in wanted and not young:
                    fs.delete(status.getPath(), True)
                    removed += 1
        return removed
