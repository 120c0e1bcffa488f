"""CSV by ranges equals the whole-file reader, wherever the ranges are cut."""

from __future__ import annotations

import csv
import glob
import io
import random

import pytest
from pyspark.sql import functions as F

from strata.sources import split_csv
from strata.sources.split_csv import ends_inside, read_csv_ranges


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def whole(spark, path):
    reader = spark.read.options(header=True, inferSchema=False, multiLine=True, quote='"', escape='"')
    return reader.csv(path)


def made(rng, n, quote_rate=0.4):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerow(["id", "note", "more\nlines", "last"])
    pieces = ["a", "b ", ",", "\n", '"', "\n\n", "é", '""', "x,y", ",\n", '"\n', "z" * 9]
    for i in range(n):
        note = "".join(rng.choices(pieces, k=rng.randint(1, 6))) if rng.random() < quote_rate else f"n{i}"
        last = "".join(rng.choices(pieces, k=rng.randint(0, 9)))
        writer.writerow([i, note, rng.choice(["", "q"]), last])
    return out.getvalue()


@pytest.fixture
def small_ranges(spark, monkeypatch):
    """Lines dealt to ranges of few characters, far smaller than Spark would make them."""

    def use(size):
        def lines(session, path):
            found = []
            for file in sorted(glob.glob(path) if "*" in path else glob.glob(f"{path}/*.csv")):
                with open(file, newline="") as f:
                    text = f.read()
                at = 0
                for line in text.removesuffix("\n").split("\n") if text else ():
                    start = at // size * size
                    found.append((hash(file), file, start, len(text) > size, len(found), line))
                    at += len(line) + 1
            schema = "id long, path string, start long, split boolean, n long, value string"
            return session.createDataFrame(found, schema).coalesce(1)

        monkeypatch.setattr(split_csv, "_lines", lines)

    return use


@pytest.mark.parametrize(("line", "out", "inside"), [
    ("a,b", False, True), ("", False, True), ('a,"b', True, False), ('"a', True, False), ('a"b,c', False, False),
    ('a",b', False, False), ('"a""b', True, False), ('""', False, True), ('x"",y', False, True), ('a,"b",c', False, False),
    ('"a" tail,"b', True, True), (' "a', False, False), ('""",', True, False), (',,"', True, False),
])
def test_quotes_open_only_at_the_start_of_a_field(line, out, inside):
    assert ends_inside(line, False) is out
    assert ends_inside(line, True) is inside


@pytest.mark.parametrize("size", [11, 97, 512, 1 << 20])
def test_equal_to_the_whole_file_reader(spark, tmp_path, small_ranges, size):
    rng = random.Random(size)
    for part in range(3):
        (tmp_path / f"part{part}.csv").write_text(made(rng, 10 + 20 * part))
    expected = rows(whole(spark, str(tmp_path)))
    small_ranges(size)
    found = read_csv_ranges(spark, str(tmp_path))
    assert found.columns == whole(spark, str(tmp_path)).columns
    assert rows(found) == expected and len(expected) == 90


def test_many_tasks_read_one_file(spark, tmp_path):
    (tmp_path / "one.csv").write_text(made(random.Random(1), 1000))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert split_csv._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 4
        found = rows(read_csv_ranges(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert found == rows(whole(spark, str(tmp_path))) and len(found) == 1000


@pytest.mark.parametrize("broadcast", [True, False])
def test_records_over_many_ranges_and_long_texts(spark, tmp_path, small_ranges, monkeypatch, broadcast):
    monkeypatch.setattr(split_csv, "PIECE", 40)
    if not broadcast:
        monkeypatch.setattr(split_csv, "MAX_BROADCAST_RANGES", 0)
    long = "\n".join(f'line {i}, with ""quotes""' for i in range(20))
    text = f'"id\nof it",note\n1,"{long}"\n2,plain\n' + "3,x\n" * 20 + f'4,"{long}\n"\n5,"open to the end\n{long}'
    (tmp_path / "a.csv").write_text(text)
    (tmp_path / "b.csv").write_text('"id\nof it",note\n6,"never closed')
    (tmp_path / "c.csv").write_text('"id\nof it",note')
    (tmp_path / "d.csv").write_text("")
    small_ranges(50)
    found = read_csv_ranges(spark, str(tmp_path))
    assert found.columns == ["id\nof it", "note"]
    assert rows(found) == rows(whole(spark, str(tmp_path / "[abc].csv")))


def test_carriage_returns_blank_lines_and_stray_quotes(spark, tmp_path, small_ranges):
    text = 'a,b\r\n1,"x\r\ny"\r\n\r\n2,5" pipe\r\n3,"q" tail\r\n4,""\r\n5,\r\n'
    (tmp_path / "a.csv").write_bytes(text.encode())
    small_ranges(9)  # the whole-file reader turns a carriage return inside quotes into nothing
    assert rows(read_csv_ranges(spark, str(tmp_path))) == [
        ("1", "x\r\ny"), ("2", '5" pipe'), ("3", '"q" tail'), ("4", None), ("5", None),
    ]


def test_headers_meet_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id,name\n1,x\n")
    (tmp_path / "b.csv").write_text('Name,extra,ID\n"y\nz",e,2\n')
    found = read_csv_ranges(spark, str(tmp_path))
    assert sorted(c.lower() for c in found.columns) == ["extra", "id", "name"]
    assert rows(found.select("id", "name", "extra")) == [("1", "x", None), ("2", "y\nz", "e")]


def test_records_of_another_width_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n1,2,3\n1\n")
    found = read_csv_ranges(spark, str(tmp_path), corrupt="_corrupt_record")
    assert rows(found) == sorted([("1", "2", None), ("1", "2", "1,2,3"), ("1", None, "1")], key=repr)
    assert rows(read_csv_ranges(spark, str(tmp_path))) == sorted([("1", "2"), ("1", "2"), ("1", None)], key=repr)


def test_empty_and_repeated_column_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,,A,b\n1,2,3,4\n")
    found, expected = read_csv_ranges(spark, str(tmp_path)), whole(spark, str(tmp_path))
    assert found.columns == expected.columns and rows(found) == rows(expected)


def test_no_file_has_a_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    assert read_csv_ranges(spark, str(tmp_path)).count() == 0


def test_a_compressed_file_is_one_range(spark, tmp_path):
    frame = spark.range(50).select("id", F.lit("x\ny").alias("t"))
    frame.coalesce(1).write.options(header=True, quote='"', escape='"', compression="gzip").csv(str(tmp_path / "z"))
    assert rows(read_csv_ranges(spark, str(tmp_path / "z"))) == rows(whole(spark, str(tmp_path / "z")))
