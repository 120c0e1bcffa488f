from __future__ import annotations

from strata.operators.shaping import schema_of
from strata.session import scratch_path
from strata.streaming.ingest import append_stream, drain, stream_files, upsert_stream

DDL = "k string, t int, v string"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def land(spark, path, data):
    spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").json(path)


def test_append_reads_each_file_once(spark):
    landing, out, check = (scratch_path(spark, x) for x in ("in", "out", "check"))
    for wave in ([("a", 1, "x")], [("b", 2, "y")]):
        land(spark, landing, wave)
        for _ in range(2):
            drain(append_stream(stream_files(spark, landing, schema_of(DDL)), out, check), spark)
    got = spark.read.parquet(out)
    assert rows(got.select("k", "t", "v")) == [("a", 1, "x"), ("b", 2, "y")]
    assert got.filter("_source_file LIKE '%json'").count() == 2


def test_upsert_keeps_the_newest_of_a_batch_and_replays_safely(spark, schema):
    landing, check = scratch_path(spark, "in"), scratch_path(spark, "check")
    name = f"{schema}.latest"
    land(spark, landing, [("a", 1, "old"), ("a", 2, "new"), ("b", 1, "b")])

    def run(checkpoint):
        stream = stream_files(spark, landing, schema_of(DDL))
        drain(upsert_stream(stream, name, ["k"], "t", checkpoint), spark, name)

    run(check)
    assert rows(spark.table(name)) == [("a", 2, "new"), ("b", 1, "b")]
    land(spark, landing, [("a", 1, "late"), ("b", 5, "later"), ("c", 1, "c")])
    run(check)
    expected = [("a", 2, "new"), ("b", 5, "later"), ("c", 1, "c")]
    assert rows(spark.table(name)) == expected
    # A lost checkpoint replays every file; the table stays the same.
    run(scratch_path(spark, "other"))
    assert rows(spark.table(name)) == expected
