"""Queries of the corpus operators over the given tables, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import (
    ann_forest, centroids, filter_audit, licences, line_dedup, mixing, ngram_join, ppm,
    sentencepiece_bpe, spotsigs, suffix_dedup, toxicity, url_filter,
)
from strata.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


QUERIES["pipeline"] = corpus_pipeline.run


@query
def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


ORACLES["op5_licences"] = licences.duckdb_twin("documents")


@query
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann_forest.search(vectors, vectors.where("vec_id % 50 = 0"))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id",
        F.col("__size").alias("size"),
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        F.col("__taken").alias("taken"),
        "source",
    )


@query
def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.encode(
        table(spark, sf_dir, "documents"), sentencepiece_bpe.default_model(spark), digests=True
    )


@query
def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


@query
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(
        table(spark, sf_dir, "documents"), size=4, threshold=(85, 100)
    ).drop("digest")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.aligned_lines(table(spark, sf_dir, "documents"))
    kept = line_dedup.kept_text(F.col("text"), F.col("__deleted"))
    return found.select(
        "doc_id",
        F.coalesce("__lines", F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("__deleted"), F.lit(0)).alias("n_deleted"),
        F.coalesce("__deleted", F.expr("array()")).cast("array<int>").alias("deleted_lines"),
        F.sha2(kept, 256).alias("kept_sha256"),
    )


@query
def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_edited(table(spark, sf_dir, "documents"))


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), training=remainder != 2)
    return toxicity.score(docs, model).withColumn(
        "held_out", F.coalesce(remainder == 2, F.lit(False))
    )


@query
def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_table(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), model)


@query
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


ORACLES["op12_centroids"] = centroids.duckdb_twin("embeddings")


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = filter_audit.duckdb_twin("documents", "labels")
