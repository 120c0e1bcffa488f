"""CSV with line breaks inside quotes, read by many tasks per file.

Spark's own reader takes such a file whole, because a byte range does not show whether it begins
inside quotes.  Here each range of physical lines says what it would do in either case: in which
state it ends, and which text at its ends belongs to records of its neighbours.  A prefix scan over
the ranges of a file, one row each, then gives the true state of every range, and records are cut
at their true boundaries.  A record across ranges is put together from the pieces that the first
pass has set aside; all others are cut and parsed where they are.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path

#: States of so many ranges are broadcast (each some 20 bytes); those of more are joined.
MAX_BROADCAST_RANGES = 200_000
#: Different header lines a set of files may have; each is one more expression in the plan.
MAX_HEADERS = 200
#: Characters of a text that the first pass sets aside.
PIECE = 1 << 20
RANGE_DDL = """id long, path string, start long, after_out boolean, after_in boolean, header string,
    open_out string, open_in string, close_in string, is_first boolean, long boolean"""


def ends_inside(line: str, inside: bool) -> bool:
    """Whether quotes are open at the end of a physical line.

    A quote opens only at the start of a field; inside, two quotes are one of the text; what
    follows a closing quote up to the comma is text of the field.
    """
    at = 0
    while True:
        if inside:
            while True:
                at = line.find('"', at)
                if at < 0:
                    return True
                if line.startswith('"', at + 1):
                    at += 2
                    continue
                break
            at = line.find(",", at + 1)
            if at < 0:
                return False
            at += 1
            inside = line.startswith('"', at)
            at += inside
        elif at == 0 and line.startswith('"'):
            inside, at = True, 1
        else:
            at = line.find(',"', at)
            if at < 0:
                return False
            inside, at = True, at + 2


class _Range:
    """What a range of lines does in either state, and the texts at its ends that are not whole.

    Texts longer than ``limit`` characters are left out: nearly always they belong to the state
    that proves wrong.  ``long`` tells so, and such a range is surveyed again where they matter.
    """

    def __init__(self, key: tuple, split: bool, limit: int | None):
        self.key, self.split, self.limit = key, split, limit
        self.inside = [False, True]
        # By the state at the start: the record still open at the end; the end of an earlier one.
        self.open: list[list[str]] = [[], []]
        self.sizes, self.closing, self.closed, self.long = [0, 0], [], False, False
        self.header, self.wants_header = None, key[2] == 0

    @property
    def done(self) -> bool:
        return not self.split and not self.wants_header

    def add(self, line: str) -> None:
        plain = '"' not in line
        for state, lines in enumerate(self.open):
            inside = self.inside[state]
            after = self.inside[state] = not (plain and not inside) and ends_inside(line, inside)
            if state and not self.closed:
                self._keep(self.closing, state, line)
                self.closed = not after
                self.sizes[state] *= after
            elif after:
                self._keep(lines, state, line)
            else:
                if not state and self.wants_header and (lines or line.strip("\r")):
                    self.header, self.wants_header = "\n".join([*lines, line]), False
                lines.clear()
                self.sizes[state] = 0

    def _keep(self, lines: list[str], state: int, line: str) -> None:
        self.sizes[state] += len(line) + 1
        if self.limit is None or self.sizes[state] <= self.limit:
            lines.append(line)
        else:
            self.long = True
            lines.clear()

    def row(self) -> tuple:
        text = lambda lines: "\n".join(lines) if lines else None
        first = self.wants_header and self.inside[0]
        return (
            *self.key, *self.inside, self.header, text(self.open[0]), text(self.open[1]),
            text(self.closing), first, self.long,
        )


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64(meta["file_path"]).alias("id"),
        meta["file_path"].alias("path"),
        meta["file_block_start"].alias("start"),
        (meta["file_block_length"] < meta["file_size"]).alias("split"),
        F.monotonically_increasing_id().alias("n"),
        "value",
    )


def _survey(frames: Iterator[pa.RecordBatch], limit: int | None) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in RANGE_DDL.split(",")]
    kinds = [pa.int64(), pa.string(), pa.int64(), *[pa.bool_()] * 2, *[pa.string()] * 4, *[pa.bool_()] * 2]

    def batch(found: _Range) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(found.row(), kinds, strict=True)], names=names
        )

    current = None
    for frame in frames:
        for key, split, lines in _stretches(frame, ("id", "path", "start"), "split"):
            if current is None or current.key != key:
                if current is not None:
                    yield batch(current)
                current = _Range(key, split, limit)
            for line in lines:
                if current.done:
                    break
                current.add(line.as_py())
    if current is not None:
        yield batch(current)


def _stretches(frame: pa.RecordBatch, keys: Sequence[str], extra: str) -> Iterator[tuple]:
    """Neighbouring rows of one range: its key, another column's value there, and the lines."""
    start, at = frame.column("start"), 0
    ids, n = frame.column("id"), frame.num_rows
    if not n:
        return
    new = pc.or_(pc.not_equal(start[1:], start[:-1]), pc.not_equal(ids[1:], ids[:-1]))
    for end in [*(i + 1 for i, x in enumerate(new.to_pylist()) if x), n]:
        key = tuple(frame.column(k)[at].as_py() for k in keys)
        yield key, frame.column(extra)[at].as_py(), frame.column("value")[at:end]
        at = end


def _states(ranges: DataFrame) -> DataFrame:
    """The ranges with ``inside``, the true state at the start, and ``last``.

    A range either forgets its state (both outcomes are equal), keeps it or turns it around.  So
    the state is the outcome of the last range that forgets, turned around as often as the ranges
    since then do.
    """
    order = Window.partitionBy("id").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    forgets = F.col("after_out") == F.col("after_in")
    turns = F.sum((~forgets & F.col("after_out")).cast("int")).over(before)
    kept = F.when(forgets, F.struct(F.col("after_out").cast("int").alias("state"), F.col("so_far")))
    found = ranges.withColumn("so_far", F.coalesce(turns, F.lit(0)))
    found = found.withColumn("kept", F.last(kept, ignorenulls=True).over(before))
    state = F.coalesce(F.col("kept.state"), F.lit(0)) + F.col("so_far") - F.coalesce("kept.so_far", F.lit(0))
    return found.select(
        *ranges.columns, (state % 2 == 1).alias("inside"), F.lead("start").over(order).isNull().alias("last")
    )


def _with_long_texts(lines: DataFrame, states: DataFrame, again: DataFrame) -> DataFrame:
    """The states with the long texts that turned out to be needed."""
    wanted = again.select("id", "start")
    chosen = lines.join(wanted, ["id", "start"], "left_semi").sortWithinPartitions("id", "start", "n")
    whole = chosen.drop("n").mapInArrow(lambda frames: _survey(frames, None), RANGE_DDL)
    path = scratch_path(lines.sparkSession, "csv-long")
    whole.write.parquet(path)
    whole = lines.sparkSession.read.schema(RANGE_DDL).parquet(path)
    texts = ("header", "open_out", "open_in", "close_in")
    found = whole.select("id", "start", *[F.col(c).alias(f"_{c}") for c in texts], F.lit(True).alias("_new"))
    joined = states.join(found, ["id", "start"], "left")
    return joined.select(*[
        F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in texts else F.col(c)
        for c in states.columns
    ])


def _across(states: DataFrame) -> DataFrame:
    """``id, is_header, record`` of the records that lie in more than one range."""
    opening = F.when(F.col("inside"), F.col("open_in")).otherwise(F.col("open_out"))
    head = F.when(F.col("inside"), F.struct(F.lit(0).alias("place"), F.lit(False).alias("opens"), F.lit(False).alias("header"), F.col("close_in").alias("text")))
    tail = F.when(
        opening.isNotNull() & ~F.col("last"),
        F.struct(F.lit(1).alias("place"), F.lit(True).alias("opens"), (F.col("is_first") & ~F.col("inside")).alias("header"), opening.alias("text")),
    )
    pieces = states.select("id", "start", F.explode(F.array_compact(F.array(head, tail))).alias("p"))
    order = Window.partitionBy("id").orderBy("start", "p.place")
    numbered = pieces.withColumn("record", F.sum(F.col("p.opens").cast("int")).over(order))
    texts = F.array_sort(F.collect_list(F.struct("start", "p.place", "p.text")))
    joined = F.array_join(F.transform(texts, lambda t: t["text"]), "\n")
    return numbered.groupBy("id", "record").agg(F.max("p.header").alias("is_header"), joined.alias("text")).select(
        "id", "is_header", F.col("text").alias("record")
    )


def _cut(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records that begin and end in one range; of a file's last range also an open one."""
    key, held, inside, waits, last, skip = None, [], False, False, False, False
    out: list[str] = []

    def batch(records: list[str], owner: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([owner] * len(records), pa.int64()), pa.array(records, pa.string())], names=["id", "record"]
        )

    def finished() -> None:
        nonlocal skip
        text = "\n".join(held)
        held.clear()
        if text.strip("\r") == "":
            return
        if skip:
            skip = False
        else:
            out.append(text)

    for frame in frames:
        for (*now, begins, ends), _, lines in _stretches(frame, ("id", "start", "inside", "last"), "id"):
            if key != now:
                if held and last and not waits:
                    finished()
                if out:
                    yield batch(out, key[0])
                    out = []
                key, held, inside, waits, last = now, [], begins, begins, ends
                skip = now[1] == 0  # the file's header
            for value in lines:
                line = value.as_py()
                if inside or '"' in line:
                    inside = ends_inside(line, inside)
                if waits:
                    waits = inside  # the end of a record that began in an earlier range
                    continue
                held.append(line)
                if not inside:
                    finished()
        if out:
            yield batch(out, key[0])
            out = []
    if held and last and not waits:
        finished()
    if out:
        yield batch(out, key[0])


def _names(header: str) -> list[str]:
    """Column names of a header line; empty ones by position, repeated ones with their position."""
    cells = next(csv.reader([header.lstrip("﻿").removesuffix("\r")]))
    lower = [c.lower() for c in cells]
    return [
        f"_c{i}" if c == "" else (f"{c}{i}" if lower.count(c.lower()) > 1 else c) for i, c in enumerate(cells)
    ]


def read_csv_ranges(
    spark: SparkSession, path: str | Sequence[str], corrupt: str | None = None
) -> DataFrame:
    """All columns as text, by the header of each file; quoted fields may hold line breaks.

    Files whose headers differ meet by name, a column that a file lacks is NULL.  Quotes are
    doubled inside quotes; records end with a line feed, with or without a carriage return.
    ``corrupt`` names a column for the text of records with more or fewer fields than the header.
    """
    lines = _lines(spark, path)
    ranges_path = scratch_path(spark, "csv-ranges")
    limit = PIECE
    surveyed = lines.drop("n").mapInArrow(lambda frames: _survey(frames, limit), RANGE_DDL)
    surveyed.write.parquet(ranges_path)
    ranges = spark.read.schema(RANGE_DDL).parquet(ranges_path)
    known = ranges.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count_distinct("path").alias("paths")).first()
    if known.ids != known.paths:
        raise RuntimeError("two files share a hash of their path; rename one of them")
    states = _states(ranges)
    ends = F.when(F.col("inside"), F.col("after_in")).otherwise(F.col("after_out"))
    again = states.where(F.col("long") & (F.col("inside") | (ends & ~F.col("last"))))
    if not again.isEmpty():
        states = _with_long_texts(lines, states, again)
    across = _across(states)
    headers = states.where("header IS NOT NULL").select("id", "header").unionByName(
        across.where("is_header").select("id", F.col("record").alias("header"))
    )
    texts = sorted(r[0] for r in headers.select("header").distinct().limit(MAX_HEADERS + 1).collect())
    if len(texts) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers")
    if not texts:
        return spark.createDataFrame([], T.StructType())

    wanted = states.where("inside OR NOT last").select("id", "start", "inside", "last")
    if known.n <= MAX_BROADCAST_RANGES:
        # The order of lines within a partition stays as it is read.
        placed = lines.join(F.broadcast(wanted), ["id", "start"], "left")
    else:
        placed = lines.join(wanted, ["id", "start"], "left").sortWithinPartitions("id", "start", "n")
    placed = placed.select(
        "id", "start", F.coalesce("inside", F.lit(False)).alias("inside"),
        F.coalesce("last", F.lit(True)).alias("last"), "value",
    )
    records = placed.mapInArrow(_cut, "id long, record string")
    records = records.unionByName(across.where("NOT is_header").select("id", "record"))
    text = F.regexp_replace("record", r"\r\z", "")
    if len(texts) == 1:
        return _parsed(records.select(text.alias("record")), texts, None, corrupt)
    number = F.lit(None).cast("int")
    for i, header in enumerate(texts):
        number = F.when(F.col("header") == header, F.lit(i)).otherwise(number)
    chosen = headers.select("id", number.alias("h"))
    return _parsed(records.join(chosen, "id").select("h", text.alias("record")), texts, F.col("h"), corrupt)


def _parsed(records: DataFrame, headers: list[str], which: Column | None, corrupt: str | None) -> DataFrame:
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    broken = "__broken"
    if corrupt:
        options["columnNameOfCorruptRecord"] = broken
    named, parsed = [_names(h) for h in headers], []
    for i, names in enumerate(named):
        cells = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(names))])
        if corrupt:
            cells = cells.add(broken, "string")
        value = F.from_csv("record", cells.simpleString()[7:-1].replace(":", " "), options)
        parsed.append((value if which is None else F.when(which == i, value)).alias(f"p{i}"))
    rows = records.select(*parsed)
    columns: dict[str, tuple[str, list[Column]]] = {}
    for i, names in enumerate(named):
        for k, name in enumerate(names):
            columns.setdefault(name.lower(), (name, []))[1].append(F.col(f"p{i}")[f"c{k}"])
    out = [F.coalesce(*values).alias(name) for name, values in columns.values()]
    if corrupt:
        out.append(F.coalesce(*[F.col(f"p{i}")[broken] for i in range(len(named))]).alias(corrupt))
    return rows.select(*out)
