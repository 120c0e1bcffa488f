"""From raw documents to token ids: toxicity, line dedup, near duplicates, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import line_dedup, mixing, ngram_join, sentencepiece_bpe, toxicity
from strata.llm.common import table, written


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that score below the threshold; learns from all labelled rows."""
    return toxicity.accepted(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes aligned blocks of lines from later documents; what is left of them stays."""
    return line_dedup.dedup(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group alike in shingles of five words to 0.8 or more."""
    return ngram_join.representatives(docs, size=5, threshold=(80, 100))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes of each source what its weight asks for, repeating epochs where needed."""
    return mixing.mixed(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every document left, ids and their text: ``doc_id, n_tokens, ids, decoded, n_corrected``."""
    return sentencepiece_bpe.encode(docs, sentencepiece_bpe.default_model(spark))


STAGES = [
    ("toxicity", reject_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("mixing to target weights", mix_sources),
    ("SentencePiece encoding", encode_texts),
]

#: SQL cannot express the stages; tests hold their operators against brute force or the library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage's result is written as Parquet and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return docs
