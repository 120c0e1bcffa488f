"""File sinks of the landing zone; each replaces its directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.sources.readers import read_csv


def write_csv(df: DataFrame, path: str) -> None:
    """With a header; blanks around a value are part of it and stay."""
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, quote='"', escape='"', **kept).csv(path)


def write_json_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    """One object per line; a compressed file is read by one task, so it is as large as one writes it."""
    df.write.mode("overwrite").option("compression", compression).json(path)


def write_xml(df: DataFrame, path: str, row_tag: str = "record", root_tag: str = "records") -> None:
    df.write.mode("overwrite").options(rowTag=row_tag, rootTag=root_tag).xml(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def reland_csv(spark: SparkSession, source: str, landing: str, multiline: bool = True) -> None:
    """Copy CSV files into the landing zone with header and text unchanged."""
    write_csv(read_csv(spark, source, multiline=multiline), landing)
