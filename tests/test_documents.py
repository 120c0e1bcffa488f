"""JSON documents and API pages: nothing of them is lost."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from strata.operators.shaping import schema_of
from strata.sources import documents
from strata.sources.documents import page_ledger, page_records, read_documents, stage_pages
from strata.sources.manifest import SEMI_STRUCTURED, SourceSpec, ingest_source


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def land(tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path)

    return put


def test_undeclared_and_conflicting_fields_go_to_the_rest(spark, land):
    text = """{"a": 1, "s": {"x": 1, "z": 3}, "extra": {"k": [1]}}
{"a": "no", "s": {"x": 2}, "t": "free"}
{"a": 3, "s": {"x": "q"}, "l": [{"i": 1}, {"i": 2, "j": 5}], "m": {"p": 1, "q": "r"}}
{"a": 4, "s": {"x": 5}, "l": [{"i": 1}, null], "m": {"p": 1}, "t": {"kept": "as text"}}
"""
    schema = schema_of("a int, s struct<x: int>, l array<struct<i: int>>, m map<string,int>, t string")
    found = {r.a: r for r in read_documents(spark, land("a.json", text), schema).collect()}
    rest = {a: json.loads(r._rest) if r._rest else None for a, r in found.items()}
    assert rest[1] == {"s": '{"x":1,"z":3}', "extra": '{"k":[1]}'}
    assert rest[None] == {"a": "no"} and found[None].t == "free"
    assert rest[3] == {"s": '{"x":"q"}', "l": '[{"i":1},{"i":2,"j":5}]', "m": '{"p":1,"q":"r"}'}
    assert rest[4] is None and found[4].t == '{"kept":"as text"}'


def test_broken_blank_and_foreign_lines(spark, land):
    path = land("a.json", '{"a": 1}\n\n{"a": \n[{"a": 2}, {"A": 3}]\n7\n{}\n{"a": null}\n')
    assert rows(read_documents(spark, path, schema_of("a int"))) == sorted(
        [(1, None, None), (None, None, '{"a": '), (2, None, None), (None, '{"A":"3"}', None), (None, None, "7"),
         (None, None, None), (None, None, None)], key=repr,
    )


def test_one_document_or_array_per_file(spark, land):
    land("a.json", '[\n {"a": 1},\n {"a": 2, "b": 3}\n]')
    path = land("b.json", '{"a":\n 9}')
    assert rows(read_documents(spark, path, schema_of("a int"), multiline=True).drop("_corrupt_record")) == sorted(
        [(1, None), (2, '{"b":"3"}'), (9, None)], key=repr
    )


def test_declared_names_like_those_of_the_extra_columns(spark, land):
    path = land("a.json", '{"a": 1, "_rest": "mine", "__text": "x", "value": "v"}\n')
    assert rows(read_documents(spark, path, schema_of("a int, _rest string, value string"))) == [
        (1, "v", '{"_rest":"mine","__text":"x"}', None)
    ]


PAGES = {
    "p1.json": '{"metadata": {"count": 2},\n "Claims": [{"id": 1, "paid": "5.5"}, {"id": 2, "paid": {"x": 1}}]}',
    "p2.json": '{"metadata": {"count": 3}, "Claims": [{"id": 3}, {"id": 4, "pa',
    "p3.json": "  \n",
    "p4.json": '{"metadata": {"count": "x"}, "Claims": []}',
    "p5.json": '{"id": 5, "paid": "1"}',
    "p6.json": "[1, 2]",
}


def test_pages_and_their_ledger(spark, land):
    for name, text in PAGES.items():
        path = land(name, text)
    pages = stage_pages(spark, path)
    ledger = {r.page.rsplit("/", 1)[1]: (r.status, r.announced, r.found) for r in page_ledger(pages).collect()}
    assert ledger == {
        "p1.json": ("parsed", 2, 2), "p2.json": ("corrupt", None, 0), "p3.json": ("empty", None, 0),
        "p4.json": ("parsed", None, 0), "p5.json": ("single", None, 1), "p6.json": ("corrupt", None, 0),
    }
    found = rows(page_records(pages, schema_of("id int, paid string")).select("id", "paid", "_corrupt_record"))
    assert found == sorted(
        [(1, "5.5", None), (2, '{"x":1}', None), (5, "1", None), (None, None, PAGES["p2.json"]), (None, None, "[1, 2]")],
        key=repr,
    )
    text = page_records(pages)
    assert text.columns == ["id", "paid", "_rest", "_corrupt_record"] and text.count() == 5
    wrong = {r.status for r in page_ledger(stage_pages(spark, path, "Nothing")).collect()}
    assert wrong == {"corrupt", "empty"}


def test_pages_of_lines(spark, land):
    path = land("pages.txt", '{"R": [{"a": 1}]}\n{"R": [{"a": 2}, {"a": 3}]}\n{"R": [\n')
    pages = stage_pages(spark, path, multiline=False)
    assert sorted(r.status for r in pages.collect()) == ["corrupt", "parsed", "parsed"]
    assert rows(page_records(pages, schema_of("a int")).select("a")) == sorted([(1,), (2,), (3,), (None,)], key=repr)


def test_no_pages_and_too_many_columns(spark, land, monkeypatch):
    path = land("a.json", "")
    assert stage_pages(spark, path, multiline=False).count() == 0
    assert page_records(stage_pages(spark, path, multiline=False)).count() == 0
    monkeypatch.setattr(documents, "MAX_COLUMNS", 1)
    path = land("b.json", '{"R": [{"a": 1, "b": 2}]}')
    with pytest.raises(ValueError, match="different fields"):
        page_records(stage_pages(spark, path, multiline=False))


def test_ingest_writes_the_ledger_beside_the_rows(spark, land, tmp_path):
    for name, text in PAGES.items():
        path = land(name, text)
    written = {}
    ingest_source(spark, SourceSpec(path, "claims", "envelope", multiline=True), "", lambda df, t: written.update({t: rows(df.select(df.columns[0], "_batch_id"))}), "b1")
    assert {t: len(r) for t, r in written.items()} == {"claims": 5, "claims_pages": 6}
    assert all(r[1] == "b1" for found in written.values() for r in found)
    declared = [s for s in SEMI_STRUCTURED if s.fmt == "envelope"]
    assert len(declared) == 2 and all(s.schema is not None and s.multiline for s in declared)


def test_only_the_ledger_is_read_for_the_ledger(spark, land, plan):
    pages = stage_pages(spark, land("a.json", '{"R": [{"a": 1}]}'), multiline=False)
    assert "documents" not in plan(page_ledger(pages)).split("ReadSchema")[1]
    assert pages.select(F.sum("found")).first()[0] == 1
