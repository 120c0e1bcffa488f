from __future__ import annotations

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from strata.operators.shaping import all_strings, schema_of
from strata.session import scratch_path, shared_root
from strata.sinks.files import reland_csv, write_csv, write_json_lines, write_xml
from strata.sinks.tables import (
    create_schemas,
    current_location,
    recover_table,
    row_counts,
    upsert,
    write_slices,
    write_table,
)
from strata.sources.manifest import (
    SEMI_STRUCTURED,
    STRUCTURED,
    SourceSpec,
    ingest_all,
    ingest_single,
    read_source,
    text_schema,
)
from strata.sources.readers import (
    date_series,
    integer_range,
    literal_relation,
    merge_pages,
    optional_table,
    read_csv,
    read_envelope,
    read_files,
    read_json,
    read_xml,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def put(path: str, text: str, name: str = "part.txt") -> str:
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(text)
    return path


# --- readers ----------------------------------------------------------------------------


def test_csv_keeps_quotes_line_breaks_and_text(spark, tmp_path):
    path = put(str(tmp_path), 'id,note\n007,"two\nlines, ""quoted"""\n008,\n', "a.csv")
    df = read_csv(spark, path)
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}
    assert rows(df) == [("007", 'two\nlines, "quoted"'), ("008", None)]


def test_json_lines_are_all_read_but_multiline_takes_one_document(spark, tmp_path):
    path = put(str(tmp_path), "".join(f'{{"a": {i}}}\n' for i in range(10)), "a.json")
    assert read_json(spark, path).count() == 10
    assert read_json(spark, path, multiline=True).count() == 1


def test_json_corrupt_line_is_kept(spark, tmp_path):
    path = put(str(tmp_path), '{"a": 1}\n{"a": \n', "a.json")
    got = read_json(spark, path, schema_of("a int"))
    assert rows(got) == [(1, None), (None, '{"a": ')]


def test_json_numbers_read_as_text_are_unchanged(spark, tmp_path):
    path = put(str(tmp_path), '{"a": 1.50, "b": true}\n{"a": "N/A"}\n', "a.json")
    got = read_json(spark, path, all_strings(["a", "b"]), keep_corrupt=False)
    assert rows(got) == sorted([("1.50", "true"), ("N/A", None)], key=repr)


def test_xml_roundtrip(spark):
    path = scratch_path(spark, "xml")
    df = spark.createDataFrame([(1, ("a", None)), (2, ("b", "x"))], "_id int, p struct<n: string, m: string>")
    write_xml(df, path, row_tag="policy")
    got = read_xml(spark, path, schema_of("_id int, p struct<n: string, m: string>"), "policy")
    assert rows(got.select("_id", "p.n", "p.m")) == [(1, "a", None), (2, "b", "x")]


def test_envelope_forms(spark, tmp_path):
    page = '{\n "metadata": {"count": "2"},\n "Claims": [{"id": 1, "paid": "5.5"}, {"id": 2, "paid": "x"}]\n}'
    path = put(str(tmp_path / "pages"), page, "p1.json")
    put(path, '{"metadata": {"count": "0"}, "Claims": []}', "p2.json")
    assert rows(read_envelope(spark, path)) == [(1, "5.5"), (2, "x")]
    assert rows(merge_pages(spark, path, ["paid"], "Claims")) == [(1, 5.5), (2, None)]
    with pytest.raises(ValueError, match="not an array"):
        read_envelope(spark, path, "metadata")
    flat = put(str(tmp_path / "flat"), '{"a": 1}', "p.json")
    assert rows(read_envelope(spark, flat)) == [(1,)]


def test_format_dispatch(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported format"):
        read_files(spark, "avro?", str(tmp_path))


def test_literals_ranges_and_dates(spark):
    lit = literal_relation(spark, [("a", True), (None, None)], "x string, y boolean")
    assert rows(lit) == sorted([("a", True), (None, None)], key=repr)
    assert literal_relation(spark, [], "x string").count() == 0
    assert integer_range(spark, 5, 2).count() == 5
    days = date_series(spark, date(2024, 2, 28), date(2024, 3, 1), "d")
    assert [r.d.day for r in days.orderBy("d").collect()] == [28, 29, 1]


# --- manifest ---------------------------------------------------------------------------


def test_manifest_covers_all_landings():
    assert len(STRUCTURED) == 10 and len(SEMI_STRUCTURED) == 8


def test_ingest_all_reports_missing_sources(spark, schema, tmp_path):
    put(str(tmp_path / "a"), "x,y\n1,2\n", "a.csv")
    sources = [SourceSpec("a", "a", "csv"), SourceSpec("gone", "gone", "csv")]
    status = ingest_all(
        spark, sources, str(tmp_path), lambda df, t: write_table(df, f"{schema}.{t}"),
        "b1", datetime(2024, 1, 1),
    )
    assert rows(status) == [
        ("a", "csv", "loaded", None), ("gone", "csv", "skipped", "PATH_NOT_FOUND"),
    ]
    row = spark.table(f"{schema}.a").first()
    assert (row.x, row._source_format, row._batch_id) == ("1", "csv", "b1")
    assert row._source_file.endswith("/a")


def test_a_failing_write_is_not_hidden(spark, tmp_path):
    put(str(tmp_path / "a"), "x\n1\n", "a.csv")

    def broken(df, table):
        raise OSError("disk")

    with pytest.raises(OSError, match="disk"):
        ingest_all(spark, [SourceSpec("a", "a", "csv")], str(tmp_path), broken)


def test_ingest_single_and_json_schema(spark, schema, tmp_path):
    path = put(str(tmp_path / "s"), "x\n1\n2\n", "a.csv")
    ingest_single(spark, path, f"{schema}.single")
    assert spark.table(f"{schema}.single").count() == 2
    assert text_schema("workers_comp_claims_json").fieldNames()[0] == "claim_id"
    assert text_schema("elsewhere") is None
    put(str(tmp_path / "j"), '{"claim_id": "c", "employee_age": 40}\n', "a.json")
    source = SourceSpec("j", "workers_comp_claims_json", "json")
    assert read_source(spark, source, str(tmp_path)).first().employee_age == "40"


# --- sinks ------------------------------------------------------------------------------


def test_overwrite_append_and_optional(spark, schema):
    name = f"{schema}.t"
    assert optional_table(spark, name) is None
    write_table(spark.range(3), name)
    write_table(spark.range(2), name)
    write_table(spark.range(2, 5), name, mode="append")
    assert rows(optional_table(spark, name, ["id"])) == [(i,) for i in range(5)]
    with pytest.raises(AnalysisException):
        optional_table(spark, name, ["nope"])


def test_partition_pruning(spark, schema, plan):
    name = f"{schema}.p"
    write_table(spark.range(100).selectExpr("id", "id % 4 AS part"), name, partition_by=["part"])
    one = spark.table(name).filter("part = 2")
    assert "PartitionFilters: [isnotnull(part" in plan(one)
    assert one.count() == 25


def test_bucketed_tables_join_without_shuffle(spark, schema, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for t in ("a", "b"):
            write_table(spark.range(50), f"{schema}.{t}", bucket_by=(4, ["id"]))
        joined = spark.table(f"{schema}.a").join(spark.table(f"{schema}.b"), "id")
        assert "Exchange" not in plan(joined) and joined.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def frame(spark, data):
    return spark.createDataFrame(data, "k string, p string, v int")


def test_upsert_updates_inserts_and_is_idempotent(spark, schema):
    name = f"{schema}.u"
    upsert(frame(spark, [("a", "x", 1), ("b", "x", 2), (None, "x", 3)]), name, ["k"])
    change = frame(spark, [("b", "y", 20), ("c", "y", 30), (None, "y", 40)])
    upsert(change, name, ["k"])
    expected = [("a", "x", 1), ("b", "y", 20), ("c", "y", 30), (None, "x", 3), (None, "y", 40)]
    assert rows(spark.table(name)) == sorted(expected, key=repr)
    keyed = frame(spark, [("b", "y", 21)])
    upsert(keyed, name, ["k"])
    once = rows(spark.table(name))
    upsert(keyed, name, ["k"])
    assert rows(spark.table(name)) == once


def test_upsert_rejects_a_repeated_source_key(spark, schema):
    name = f"{schema}.u"
    upsert(frame(spark, [("a", "x", 1)]), name, ["k"])
    with pytest.raises(PySparkException, match="repeats the merge key"):
        upsert(frame(spark, [("b", "x", 1), ("b", "x", 2)]), name, ["k"])
    assert rows(spark.table(name)) == [("a", "x", 1)]
    upsert(frame(spark, [("b", "x", 1)]), name, ["k"])
    assert spark.table(name).count() == 2


def test_upsert_recovers_a_staged_table(spark, schema):
    write_table(frame(spark, [("a", "x", 1)]), f"{schema}.u__staged_1")
    upsert(frame(spark, [("b", "x", 2)]), f"{schema}.u", ["k"])
    assert rows(spark.table(f"{schema}.u")) == [("a", "x", 1), ("b", "x", 2)]


def test_upsert_rewrites_only_touched_partitions(spark, schema):
    name = f"{schema}.u"
    upsert(frame(spark, [("a", "x", 1), ("b", "y", 2)]), name, ["k", "p"], partition_by=["p"])
    files = {r.p: r.f for r in spark.table(name).select("p", F.col("_metadata.file_path").alias("f")).collect()}
    upsert(frame(spark, [("a", "x", 10), ("c", "x", 3)]), name, ["k", "p"], partition_by=["p"])
    table = spark.table(name)
    assert rows(table.select("k", "p", "v")) == [("a", "x", 10), ("b", "y", 2), ("c", "x", 3)]
    after = {r.f for r in table.filter("p = 'y'").select(F.col("_metadata.file_path").alias("f")).collect()}
    assert after == {files["y"]}


def test_a_failed_overwrite_leaves_the_table_and_can_be_repeated(spark, schema):
    name = f"{schema}.t"
    write_table(spark.range(3), name)
    broken = spark.range(5).selectExpr("if(id = 4, raise_error('late'), id) AS id")
    for _ in range(2):
        with pytest.raises(PySparkException, match="late"):
            write_table(broken, name)
        assert spark.table(name).count() == 3
    write_table(spark.table(name).filter("id > 0"), name)
    assert rows(spark.table(name)) == [(1,), (2,)]
    assert f"{schema}" in current_location(spark, name)


def test_upsert_keeps_the_rows_of_the_null_partition(spark, schema):
    name = f"{schema}.nulls"
    columns = "id int, part int, v string"
    first = spark.createDataFrame([(1, 1, "a"), (2, None, "b"), (3, None, "c")], columns)
    upsert(first, name, ["id", "part"], partition_by=["part"])
    upsert(spark.createDataFrame([(4, None, "d")], columns), name, ["id", "part"], partition_by=["part"])
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2, 3, 4]


def test_recovery_does_not_choose_between_versions(spark, schema):
    for version in ("a", "b"):
        spark.range(3).write.saveAsTable(f"{schema}.t__staged_{version}")
    with pytest.raises(RuntimeError, match="several versions"):
        recover_table(spark, f"{schema}.t")


def test_merge_mode_needs_keys(spark, schema):
    with pytest.raises(ValueError, match="merge_keys"):
        write_table(spark.range(1), f"{schema}.t", mode="merge")


def test_schemas_and_counts(spark, schema):
    create_schemas(spark, {schema: "again"})
    assert row_counts(spark, [schema]).count() == 0
    write_table(spark.range(3), f"{schema}.b")
    write_table(spark.range(0), f"{schema}.a")
    assert [tuple(r) for r in row_counts(spark, [schema]).collect()] == [
        (schema, "a", 0), (schema, "b", 3),
    ]


def test_file_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"\nc')], "id int, t string")
    src, dst = str(tmp_path / "src"), str(tmp_path / "dst")
    write_csv(df, src)
    reland_csv(spark, src, dst)
    assert rows(read_csv(spark, dst)) == [("1", 'a "b"\nc')]
    write_json_lines(df, src)
    assert read_json(spark, src).count() == 1


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_table_of_the_same_columns_is_replaced_in_one_step(spark, schema, monkeypatch):
    from strata.sinks import tables

    name = f"{schema}.t"
    write_table(spark.createDataFrame([(1, "a")], "k int, v string"), name)
    first = current_location(spark, name)
    with monkeypatch.context() as patched:
        # Neither dropped nor renamed, so there is no moment without the table.
        patched.setattr(tables, "_take_name", lambda *_: pytest.fail("the name was dropped"))
        write_table(spark.table(name).selectExpr("k + 1 AS k", "v"), name)
        assert rows(spark.table(name)) == [(2, "a")]
    assert current_location(spark, name) != first and os.path.isdir(first.removeprefix("file:"))
    with monkeypatch.context() as patched:
        patched.setattr(tables, "_point_to", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            write_table(spark.createDataFrame([(9, "z")], "k int, v string"), name)
    assert rows(spark.table(name)) == [(2, "a")]
    write_table(spark.createDataFrame([(3, "c", True)], "k int, v string, w boolean"), name)
    assert rows(spark.table(name)) == [(3, "c", True)]
    write_table(spark.table(name), name, partition_by=["w"])
    write_table(spark.createDataFrame([(4, "d", False)], "k int, v string, w boolean"), name)
    assert rows(spark.table(name)) == [(4, "d", False)]


def test_a_half_finished_replacement_is_found_by_the_layers(spark, layers):
    from strata.sinks import tables

    layers.write("gold", "dim_x", spark.range(1))
    name = layers.name("gold", "dim_x")
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}{tables.STAGED}abc")
    assert layers.optional("gold", "dim_x").count() == 1
    assert layers.optional("gold", "never") is None


def test_csv_keeps_blanks_around_values(spark):
    path, again = scratch_path(spark, "csv"), scratch_path(spark, "csv")
    data = [(" a ", "b  "), ("\tc", " d\n ")]
    write_csv(spark.createDataFrame(data, "x string, y string"), path)
    assert rows(read_csv(spark, path)) == rows(spark.createDataFrame(data, "x string, y string"))
    reland_csv(spark, path, again)
    assert rows(read_csv(spark, again)) == rows(read_csv(spark, path))


def test_a_table_in_slices_is_replaced_when_all_are_written(spark, schema):
    name = f"{schema}.t"
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    write_slices(spark, [], name)
    assert not spark.catalog.tableExists(name)
    for _ in range(2):
        write_slices(spark, (frame.filter(f"k = {k}") for k in (1, 2)), name)
        assert rows(spark.table(name)) == [(1, "a"), (2, "b")]

    def stopped():
        yield frame.selectExpr("k + 1 AS k", "v")
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        write_slices(spark, stopped(), name)
    assert rows(spark.table(name)) == [(1, "a"), (2, "b")]
    write_slices(spark, [frame.selectExpr("v", "k")], name)
    assert rows(spark.table(name)) == [("a", 1), ("b", 2)]


def test_tables_of_hashed_keys_take_half_their_text(spark, schema):
    frame = spark.range(20_000).selectExpr("md5(cast(id as string)) AS k")
    write_table(frame, f"{schema}.once")
    write_slices(spark, [frame], f"{schema}.parts")
    for name in ("once", "parts"):
        folder = current_location(spark, f"{schema}.{name}").removeprefix("file:")
        size = sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".parquet"))
        assert size < 0.6 * 32 * 20_000
