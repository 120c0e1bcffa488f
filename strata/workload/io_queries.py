"""Sources, sinks and streams: the given tables written out and read back."""

from __future__ import annotations

import uuid
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.casts import money
from strata.operators.sets import union_all
from strata.operators.shaping import all_strings, schema_of
from strata.plans.pipeline import Layers
from strata.plans.reports import labelled_counts
from strata.session import scratch_path
from strata.sinks.files import (
    reland_csv,
    write_csv,
    write_json_lines,
    write_parquet,
    write_xml,
)
from strata.sinks.tables import create_schemas, row_counts, upsert, write_table
from strata.sinks.versions import VersionedTable
from strata.sources.manifest import (
    SEMI_STRUCTURED,
    STRUCTURED,
    SourceSpec,
    ingest_all,
    ingest_single,
)
from strata.sources.readers import (
    merge_pages,
    optional_table,
    read_csv,
    read_envelope,
    read_files,
    read_json,
    read_parquet,
    read_xml,
)
from strata.streaming.ingest import (
    append_stream,
    drain,
    stream_files,
    upsert_stream,
    upsert_stream_versioned,
)
from strata.workload.raw import table
from strata.workload.registry import query

PRICE = "cast(o_totalprice as decimal(18,2))"
# Text with the characters CSV has to quote.
_NOTE = "concat('note \"', o_orderstatus, '\",', chr(10), ' for ', o_orderpriority)"


def fresh_schema(spark: SparkSession) -> str:
    """An empty catalog schema in the shared folder."""
    name = f"strata_{uuid.uuid4().hex[:12]}"
    create_schemas(spark, {name: "query output"}, scratch_path(spark, "tables"))
    return name


# --- files ------------------------------------------------------------------------------

_CSV_SQL = f"""SELECT cast(o_orderkey AS varchar) AS o_orderkey,
    cast(cast(o_orderdate AS date) AS varchar) AS day, {_NOTE} AS note,
    cast({PRICE} AS varchar) AS price FROM orders"""


def _order_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey", "cast(o_orderdate as date) AS day", f"{_NOTE} AS note", f"{PRICE} AS price"
    )


@query("csv_roundtrip", _CSV_SQL)
def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(_order_text(spark, sf), path)
    return read_csv(spark, path)


@query("reland_csv", _CSV_SQL)
def relanded(spark: SparkSession, sf: str) -> DataFrame:
    source, landing = scratch_path(spark, "remote"), scratch_path(spark, "landing")
    write_csv(_order_text(spark, sf), source)
    reland_csv(spark, source, landing)
    return read_csv(spark, landing)


@query(
    "json_lines_roundtrip",
    """SELECT cast(event_id AS varchar) AS event_id, event_type,
    cast(cast(value AS decimal(18,2)) AS varchar) AS value, props FROM events""",
)
def json_lines_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "json")
    events = table(spark, sf, "events").select(
        "event_id", "event_type", money(F.col("value")).alias("value"), "props"
    )
    write_json_lines(events, path)
    schema = all_strings(events.columns)
    return read_json(spark, path, schema, keep_corrupt=False)


_EVENT_TEXT = """concat('{"event_id":', cast(event_id as string), ',"payload":', props,
    case when event_type = 'error' then '' else '}' end)"""


@query(
    "json_corrupt_records",
    f"""SELECT CASE WHEN event_type <> 'error' THEN event_id END AS event_id,
    CASE WHEN event_type <> 'error' THEN cast(json_extract(props, '$.k') AS bigint) END AS k,
    CASE WHEN event_type = 'error' THEN {_EVENT_TEXT} END AS _corrupt_record FROM events""",
)
def json_corrupt_records(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "corrupt")
    table(spark, sf, "events").selectExpr(f"{_EVENT_TEXT} AS value").write.text(path)
    schema = schema_of("event_id bigint, payload struct<k: bigint>")
    rows = read_json(spark, path, schema)
    return rows.select("event_id", F.col("payload.k").alias("k"), "_corrupt_record")


@query(
    "xml_rows",
    """SELECT c_custkey AS id, c_name AS name, cast(c_acctbal AS decimal(18,2)) AS balance
    FROM customer""",
)
def xml_rows(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "xml")
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("_id"),
        F.struct(
            F.col("c_name").alias("name"), money(F.col("c_acctbal")).alias("balance")
        ).alias("person"),
    )
    write_xml(customers, path)
    schema = schema_of("_id bigint, person struct<name: string, balance: decimal(18,2)>")
    return read_xml(spark, path, schema).select(F.col("_id").alias("id"), "person.*")


@query(
    "parquet_scan",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_quantity < 10""",
)
def parquet_scan(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_parquet(spark, f"{sf}/lineitem.parquet")
    rows = lines.filter("l_shipdate >= TIMESTAMP_NTZ '1998-01-01' AND l_quantity < 10")
    return rows.select("l_orderkey", "l_linenumber", "l_quantity")


# --- API pages --------------------------------------------------------------------------

# A response carries an order as billed and as invoiced, so a page never grows with the data.


def _land_pages(spark: SparkSession, sf: str) -> str:
    """Orders as API responses, one response per line."""
    path = scratch_path(spark, "pages")

    def record(kind: str, price: str) -> Column:
        return F.struct(
            "o_orderkey", F.lit(kind).alias("kind"), F.expr(price).cast("string").alias("price")
        )

    envelope = F.struct(
        F.create_map(F.lit("status"), F.col("o_orderstatus")).alias("metadata"),
        F.array(record("billed", PRICE), record("invoiced", _INVOICED)).alias("records"),
    )
    documents = table(spark, sf, "orders").select(F.to_json(envelope).alias("value"))
    documents.write.text(path)
    return path


_INVOICED = f"case when o_orderpriority = '5-LOW' then 'N/A' else cast({PRICE} as string) end"
_ENVELOPE = """metadata map<string,string>,
    records array<struct<o_orderkey: bigint, kind: string, price: string>>"""
_RECORDS_SQL = f"""(SELECT o_orderkey, 'billed' AS kind, cast({PRICE} AS varchar) AS price FROM orders
    UNION ALL SELECT o_orderkey, 'invoiced', {_INVOICED} FROM orders)"""


@query("envelope_explode", f"SELECT o_orderkey, kind, price FROM {_RECORDS_SQL}")
def envelope_explode(spark: SparkSession, sf: str) -> DataFrame:
    path = _land_pages(spark, sf)
    return read_envelope(spark, path, schema=schema_of(_ENVELOPE), multiline=False)


@query(
    "paged_merge",
    f"SELECT o_orderkey, kind, try_cast(price AS double) AS price FROM {_RECORDS_SQL}",
)
def paged_merge(spark: SparkSession, sf: str) -> DataFrame:
    path = _land_pages(spark, sf)
    return merge_pages(spark, path, ["price"], "records", schema_of(_ENVELOPE), multiline=False)


# --- manifest ---------------------------------------------------------------------------


@query(
    "manifest_ingest",
    """SELECT 'customers' AS table_name, 'csv' AS source_format, 'loaded' AS status,
    cast(null AS varchar) AS reason, (SELECT count(*) FROM customer) AS row_count
    UNION ALL SELECT 'suppliers', 'json', 'loaded', null, (SELECT count(*) FROM supplier)
    UNION ALL SELECT 'parts', 'parquet', 'loaded', null, (SELECT count(*) FROM part)
    UNION ALL SELECT 'regions', 'csv', 'skipped', 'PATH_NOT_FOUND', null""",
)
def manifest_ingest(spark: SparkSession, sf: str) -> DataFrame:
    base = scratch_path(spark, "manifest")
    write_csv(table(spark, sf, "customer"), f"{base}/customer")
    write_json_lines(table(spark, sf, "supplier"), f"{base}/supplier")
    write_parquet(table(spark, sf, "part"), f"{base}/part")
    suppliers = all_strings(table(spark, sf, "supplier").columns)
    sources = [
        SourceSpec("customer", "customers", "csv"),
        SourceSpec("supplier", "suppliers", "json", suppliers),
        SourceSpec("part", "parts", "parquet"),
        SourceSpec("region", "regions", "csv"),
    ]
    layers = Layers(spark, f"run{uuid.uuid4().hex[:12]}_", scratch_path(spark, "lake")).create()
    status = ingest_all(
        spark,
        sources,
        base,
        lambda df, name: layers.write("bronze", name, df) and None,
        "batch-1",
        datetime(2024, 1, 1),
    )
    counts = row_counts(spark, [layers.schema("bronze")]).drop("schema_name")
    return status.join(counts, "table_name", "left")


# Bronze keeps what a declaration lacks: remarks with line breaks, fields nobody declared, pages
# that were cut off on the way.
_REMARK = "concat('said \"', o_orderstatus, '\",', chr(10), 'twice', chr(10), o_clerk_note)"
_PAGE_CUT = "o_orderkey % 17 = 0"


def _clerk(table_sql: str) -> str:
    return f"(SELECT *, cast(o_custkey AS varchar) AS o_clerk_note FROM {table_sql})"


_URGENT = "orders WHERE o_orderpriority = '1-URGENT'"
_POLICY_ID = "concat('P-', cast(o_orderkey AS varchar))"
_PAGE_KEY = "cast(o_orderkey AS varchar)"
_CUT_PAGE = f"""concat('{{"metadata":{{"count":2}},"FimaNfipClaims":[{{"id":"', {_PAGE_KEY}, '","st')"""


@query(
    "bronze_manifest",
    f"""SELECT 'property_policies_csv' AS table_name, {_POLICY_ID} AS id, {_REMARK} AS content,
        cast(null AS varchar) AS rest, cast(null AS varchar) AS corrupt FROM {_clerk(_URGENT)}
    UNION ALL SELECT 'property_policies_json', {_POLICY_ID}, 'UW', concat('{{"telematics_score":"',
        cast(o_custkey AS varchar), '","trips":"[{{\\"km\\":', cast(o_custkey % 7 AS varchar), '}}]"}}'), null
        FROM {_URGENT}
    UNION ALL SELECT 'property_fema_claims_json', concat({_PAGE_KEY}, '-', k), 'TX',
        CASE WHEN k = '2' THEN concat('{{"adjuster":"', cast(o_custkey AS varchar), '"}}') END, null
        FROM {_URGENT.replace("orders", "orders CROSS JOIN (VALUES ('1'), ('2')) AS n(k)")} AND NOT {_PAGE_CUT}
    UNION ALL SELECT 'property_fema_claims_json', null, null, null, {_CUT_PAGE}
        FROM {_URGENT} AND {_PAGE_CUT}
    UNION ALL SELECT 'property_fema_claims_json_pages', CASE WHEN {_PAGE_CUT} THEN 'corrupt' ELSE 'parsed' END,
        CASE WHEN NOT {_PAGE_CUT} THEN '2' END, CASE WHEN {_PAGE_CUT} THEN '0' ELSE '2' END, null FROM {_URGENT}
    UNION ALL SELECT 'status', 'loaded', null, null, cast(n AS varchar) FROM (VALUES (3)) AS v(n)
    UNION ALL SELECT 'status', 'skipped', null, null, '15'""",
)
def bronze_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest's own sources from files that hold more than is declared, and broken pages."""
    base = scratch_path(spark, "landing")
    orders = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")
    orders = orders.selectExpr("*", "cast(o_custkey as string) AS o_clerk_note")
    policy = F.expr("concat('P-', cast(o_orderkey as string))").alias("policy_id")
    write_csv(orders.select(policy, F.expr(_REMARK).alias("remarks")), f"{base}/property/synthetic_policies_csv")
    trips = F.array(F.struct((F.col("o_custkey") % 7).alias("km"))).alias("trips")
    write_json_lines(
        orders.select(policy, F.lit("UW").alias("underwriter"), F.col("o_custkey").alias("telematics_score"), trips),
        f"{base}/property/synthetic_policies_json",
    )

    def claim(number: str, *more: Column) -> Column:
        key = F.concat(F.col("o_orderkey").cast("string"), F.lit(f"-{number}"))
        return F.to_json(F.struct(key.alias("id"), F.lit("TX").alias("state"), *more))

    records = F.concat_ws(",", claim("1"), claim("2", F.col("o_custkey").alias("adjuster")))
    whole = F.concat(F.lit('{"metadata":{"count":2},"FimaNfipClaims":['), records, F.lit("]}"))
    pages = orders.select(F.when(F.expr(_PAGE_CUT), F.expr(_CUT_PAGE.replace("varchar", "string"))).otherwise(whole))
    pages.write.text(f"{base}/property/fema_nfip_claims")
    layers = Layers(spark, f"run{uuid.uuid4().hex[:12]}_", scratch_path(spark, "lake")).create()
    # One page per line here: the given tables would make one small file of every order.
    sources = [
        replace(s, multiline=False) if s.fmt == "envelope" else s for s in (*STRUCTURED, *SEMI_STRUCTURED)
    ]
    status = ingest_all(
        spark, sources, base, lambda df, name: layers.write("bronze", name, df) and None,
        "batch-1", datetime(2024, 1, 1),
    )

    def rows(name: str, *columns: str) -> DataFrame:
        names = ("id", "content", "rest", "corrupt")
        values = [F.expr(sql).cast("string").alias(c) for c, sql in zip(names, columns, strict=True)]
        return spark.table(layers.name("bronze", name)).select(F.lit(name).alias("table_name"), *values)

    counts = status.groupBy("status").count()
    return union_all(
        [
            rows("property_policies_csv", "policy_id", "remarks", "null", "_corrupt_record"),
            rows("property_policies_json", "policy_id", "underwriter", "_rest", "_corrupt_record"),
            rows("property_fema_claims_json", "id", "state", "_rest", "_corrupt_record"),
            rows("property_fema_claims_json_pages", "status", "announced", "found", "null"),
            counts.select(
                F.lit("status").alias("table_name"), F.col("status").alias("id"),
                *[F.lit(None).cast("string").alias(c) for c in ("content", "rest")],
                F.col("count").cast("string").alias("corrupt"),
            ),
        ]
    )


@query(
    "ingest_single",
    """SELECT cast(s_suppkey AS varchar) AS s_suppkey, s_name, 'csv' AS _source_format,
    'batch-7' AS _batch_id FROM supplier""",
)
def ingested_single(spark: SparkSession, sf: str) -> DataFrame:
    path, name = scratch_path(spark, "single"), f"{fresh_schema(spark)}.suppliers"
    write_csv(table(spark, sf, "supplier"), path)
    ingest_single(spark, path, name, batch_id="batch-7", ingested_at=datetime(2024, 1, 1))
    return spark.table(name).select("s_suppkey", "s_name", "_source_format", "_batch_id")


@query(
    "optional_table",
    "SELECT n_nationkey AS code, n_name AS name FROM nation UNION ALL "
    "SELECT c_custkey, c_name FROM customer",
)
def optional_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables that exist are read with pruned columns, the absent one is skipped."""
    schema = fresh_schema(spark)
    write_table(
        table(spark, sf, "nation").selectExpr("cast(n_nationkey as bigint) AS code", "n_name AS name"),
        f"{schema}.nations",
    )
    write_table(
        table(spark, sf, "customer").selectExpr("c_custkey AS code", "c_name AS name", "c_acctbal"),
        f"{schema}.customers",
    )
    names = ("nations", "absent", "customers")
    return union_all(optional_table(spark, f"{schema}.{n}", ["code", "name"]) for n in names)


@query(
    "format_dispatch",
    "SELECT p_partkey, p_name, p_size FROM part",
)
def format_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    return read_files(spark, "parquet", f"{sf}/part.parquet").select("p_partkey", "p_name", "p_size")


# --- tables -----------------------------------------------------------------------------


@query(
    "table_overwrite_append",
    "SELECT o_orderkey, o_orderstatus FROM orders",
)
def table_overwrite_append(spark: SparkSession, sf: str) -> DataFrame:
    """Overwrite twice (idempotent), then append the rest."""
    name = f"{fresh_schema(spark)}.orders"
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    open_orders = orders.filter("o_orderstatus = 'O'")
    write_table(open_orders, name)
    write_table(open_orders, name)
    write_table(orders.filter("o_orderstatus <> 'O'"), name, mode="append")
    return spark.table(name)


@query(
    "partitioned_write",
    """SELECT l_orderkey, l_linenumber, cast(l_extendedprice AS decimal(18,2)) AS price, l_returnflag
    FROM lineitem WHERE l_returnflag = 'R'""",
)
def partitioned_write(spark: SparkSession, sf: str) -> DataFrame:
    """Only the files of one partition value are read back."""
    name = f"{fresh_schema(spark)}.lines"
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", money(F.col("l_extendedprice")).alias("price"), "l_returnflag"
    )
    write_table(lines, name, partition_by=["l_returnflag"])
    return spark.table(name).filter("l_returnflag = 'R'")


@query(
    "bucketed_write",
    """SELECT o_orderkey, o_orderstatus, count(l_orderkey) AS lines FROM orders
    LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey, o_orderstatus""",
)
def bucketed_write(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables bucketed alike: the join and the aggregation on the key need no shuffle."""
    schema = fresh_schema(spark)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, sf, "lineitem").select("l_orderkey")
    write_table(orders, f"{schema}.orders", bucket_by=(8, ["o_orderkey"]))
    write_table(lines, f"{schema}.lines", bucket_by=(8, ["l_orderkey"]))
    counts = spark.table(f"{schema}.lines").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    joined = spark.table(f"{schema}.orders").join(counts, F.expr("o_orderkey = l_orderkey"), "left")
    return joined.selectExpr("o_orderkey", "o_orderstatus", "coalesce(n, 0L) AS lines")


# Orders in process change their price; delivered ones come again under a new key.
_UPSERT_SQL = f"""SELECT o_orderkey, o_orderpriority,
    CASE WHEN o_orderstatus = 'P' THEN cast({PRICE} * 2 AS decimal(18,2)) ELSE {PRICE} END AS price
    FROM orders UNION ALL SELECT o_orderkey + 100000000000, o_orderpriority, {PRICE} FROM orders
    WHERE o_orderstatus = 'F'"""


def _upsert_frames(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf, "orders")
    base = orders.selectExpr("o_orderkey", "o_orderpriority", f"{PRICE} AS price")
    changed = orders.filter("o_orderstatus = 'P'").selectExpr(
        "o_orderkey", "o_orderpriority", f"cast({PRICE} * 2 as decimal(18,2)) AS price"
    )
    new = orders.filter("o_orderstatus = 'F'").selectExpr(
        "o_orderkey + 100000000000L AS o_orderkey", "o_orderpriority", f"{PRICE} AS price"
    )
    return base, changed.unionByName(new)


@query("upsert_merge", _UPSERT_SQL)
def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    name = f"{fresh_schema(spark)}.orders"
    base, changes = _upsert_frames(spark, sf)
    upsert(base, name, ["o_orderkey"])
    write_table(changes, name, mode="merge", merge_keys=["o_orderkey"])
    return spark.table(name)


@query("upsert_partitioned", _UPSERT_SQL)
def upsert_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """The partition column is part of the key, so untouched partitions are not rewritten."""
    name = f"{fresh_schema(spark)}.orders"
    base, changes = _upsert_frames(spark, sf)
    keys = ["o_orderkey", "o_orderpriority"]
    upsert(base, name, keys, partition_by=["o_orderpriority"])
    upsert(changes, name, keys, partition_by=["o_orderpriority"])
    return spark.table(name)


@query("upsert_versioned", _UPSERT_SQL)
def upsert_versioned(spark: SparkSession, sf: str) -> DataFrame:
    """Versions in a commit log; an upsert rewrites the files that hold one of its keys."""
    base, changes = _upsert_frames(spark, sf)
    target = VersionedTable(spark, scratch_path(spark, "versioned"), ["o_orderkey"])
    target.overwrite(base)
    target.upsert(changes)
    return target.read()


@query(
    "versioned_history",
    """SELECT 1 AS version, 'overwrite' AS operation, count(*) AS row_count FROM orders
    UNION ALL SELECT 2, 'upsert', count(*) + count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders
    UNION ALL SELECT 3, 'append', 2 * count(*) + count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders""",
)
def versioned_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every version stays readable; its rows are counted from its list of files."""
    base, changes = _upsert_frames(spark, sf)
    target = VersionedTable(spark, scratch_path(spark, "versioned"), ["o_orderkey"])
    target.overwrite(base)
    target.upsert(changes)
    target.append(base.select(*target.read().columns))
    history = [
        target.files(v).agg(F.sum("n_rows").alias("row_count")).select(
            F.lit(v).alias("version"), F.lit(target.commit_of(v)["operation"]).alias("operation"), "row_count"
        )
        for v in target.versions()
    ]
    return union_all(history)


_LAYERED = ("customer", "orders", "supplier")


@query(
    "layer_row_counts",
    " UNION ALL ".join(
        f"SELECT 'strata' AS layer, '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in _LAYERED
    ),
)
def layer_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Schema creation, then the catalog listed with the rows of every table."""
    schema = fresh_schema(spark)
    for name in _LAYERED:
        write_table(table(spark, sf, name), f"{schema}.{name}")
    layer = F.substring_index("schema_name", "_", 1).alias("layer")
    return row_counts(spark, [schema]).select(layer, "table_name", "row_count")


@query(
    "labelled_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
        for t in ("events", "lineitem", "part")
    ),
)
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return labelled_counts({t: table(spark, sf, t) for t in ("events", "lineitem", "part")})


# --- streams ----------------------------------------------------------------------------


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        "user_id",
        "event_type",
        money(F.col("value")).alias("value"),
    )


def _event_schema() -> T.StructType:
    return schema_of(
        "event_id bigint, ts string, user_id bigint, event_type string, value decimal(18,2)"
    )


@query(
    "stream_incremental_ingest",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type,
    cast(value AS decimal(18,2)) AS value, 'json' AS _source_format FROM events""",
)
def stream_incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Files that arrive in two waves; the second run reads only the new ones."""
    landing, out = scratch_path(spark, "arrivals"), scratch_path(spark, "stream")
    checkpoint = scratch_path(spark, "checkpoint")
    events = _events(spark, sf)
    first = F.col("event_type").isin("click", "view")
    for wave in (events.filter(first), events.filter(~first)):
        wave.write.mode("append").json(landing)
        stream = stream_files(spark, landing, _event_schema())
        drain(append_stream(stream, out, checkpoint), spark)
    rows = spark.read.parquet(out)
    return rows.select("event_id", "ts", "event_type", "value", "_source_format")


_LATEST_SQL = """SELECT user_id, event_id, event_type, cast(value AS decimal(18,2)) AS value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id
    ORDER BY ts DESC, event_id) = 1"""


@query("stream_upsert", _LATEST_SQL)
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Latest event per user; late rows of the second wave change nothing."""
    landing, name = scratch_path(spark, "arrivals"), f"{fresh_schema(spark)}.latest"
    checkpoint = scratch_path(spark, "checkpoint")
    events = _events(spark, sf)
    first = F.col("event_type").isin("click", "view")
    for wave in (events.filter(first), events.filter(~first)):
        wave.write.mode("append").json(landing)
        stream = stream_files(spark, landing, _event_schema())
        drain(upsert_stream(stream, name, ["user_id"], "ts", checkpoint), spark, name)
    return spark.table(name).select("user_id", "event_id", "event_type", "value")


@query("stream_upsert_versioned", _LATEST_SQL)
def stream_upsert_versioned(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a versioned table: a micro-batch rewrites the files it touches."""
    landing, checkpoint = scratch_path(spark, "arrivals"), scratch_path(spark, "checkpoint")
    target = VersionedTable(spark, scratch_path(spark, "versioned"), ["user_id"])
    events = _events(spark, sf)
    first = F.col("event_type").isin("click", "view")
    for wave in (events.filter(first), events.filter(~first)):
        wave.write.mode("append").json(landing)
        stream = stream_files(spark, landing, _event_schema())
        drain(upsert_stream_versioned(stream, target, "ts", checkpoint), spark)
    return target.read().select("user_id", "event_id", "event_type", "value")
