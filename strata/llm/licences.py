"""Licence scans by canonical digest.

A text is brought to canonical form (ASCII case, punctuation and white space, copyright lines,
equivalent spellings) and its SHA-256 is looked up among the digests of known licence texts.
Whole documents and every single line are looked up, both by hash join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower
from strata.llm.licence_texts import EQUIVALENT_WORDS, KNOWN_TEXTS, texts_in

#: A line that only names the holder of the rights.
COPYRIGHT_LINE = r"(^|\n)[ \t/*#;-]*copyright[ \t]*(\(c\)|©|[0-9]{4}|<|\[)[^\n]*"
#: All ASCII but digits and lower-case letters; two spaces keep words apart for replacing.
PUNCTUATION = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def canonical(text: Column) -> Column:
    lowered = F.regexp_replace(ascii_lower(text), COPYRIGHT_LINE, "\n")
    words = F.concat(F.lit("  "), F.regexp_replace(lowered, PUNCTUATION, "  "), F.lit("  "))
    same = reduce(
        lambda t, pair: F.replace(t, F.lit(f" {pair[0]} "), F.lit(f" {pair[1]} ")),
        EQUIVALENT_WORDS.items(),
        words,
    )
    return F.trim(F.regexp_replace(same, "  +", " "))


def known_digests(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """``licence, digest`` of each known text; several texts may stand for one licence."""
    rows = [(name.split("#")[0], text) for name, text in (texts or KNOWN_TEXTS).items()]
    known = spark.createDataFrame(rows, "licence string, text string")
    return known.select("licence", F.sha2(canonical(F.col("text")), 256).alias("digest")).distinct()


def scan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    texts: dict[str, str] | None = None,
    folder: str | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: the id, ``digest, licence, line_licences``.

    ``licence`` is that of the whole text or NULL; ``line_licences`` the sorted distinct licences
    of single lines, joined by a comma, empty if there is none.  NULL texts count as empty, and
    an empty canonical text never matches.  Repeated rows are looked up each on its own; NULL ids
    are kept; an empty table gives an empty result.  Known are ``texts``, or else those that ship;
    those of ``folder`` (``<licence>.txt``, read by the driver) come on top.
    """
    known = KNOWN_TEXTS if texts is None else texts
    if folder is not None:
        known = known | texts_in(folder)
    spark = docs.sparkSession
    digests = known_digests(spark, known) if known else spark.createDataFrame(
        [], "licence string, digest string"
    )
    # The known texts are part of the code, so this side is small whatever the input.
    pairs = digests.where(F.col("digest") != F.sha2(F.lit(""), 256))
    by_digest = F.broadcast(
        pairs.groupBy(F.col("digest").alias("__digest")).agg(F.min("licence").alias("licence"))
    )
    body = F.coalesce(F.col("__text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).select(
        "__id",
        F.sha2(canonical(body), 256).alias("digest"),
        # Lines are looked up in the row itself: the same digests as a map of bounded size.
        F.transform(F.split(body, "\n"), lambda line: F.sha2(canonical(line), 256)).alias("__lines"),
    )
    table = F.broadcast(
        pairs.groupBy("digest")
        .agg(F.min("licence").alias("licence"))
        .agg(F.map_from_entries(F.collect_list(F.struct("digest", "licence"))).alias("__known"))
    )
    found = F.array_sort(
        F.array_distinct(
            F.filter(
                F.transform("__lines", lambda d: F.try_element_at("__known", d)),
                lambda x: x.isNotNull(),
            )
        )
    )
    return (
        rows.join(by_digest, F.col("digest") == F.col("__digest"), "left")
        .join(table, F.lit(True), "left")
        .select(
            F.col("__id").alias(id_col),
            "digest",
            "licence",
            F.array_join(found, ",").alias("line_licences"),
        )
    )


def _duckdb_canonical(text: str) -> str:
    """The canonical form as a DuckDB expression."""
    lowered = (
        f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    )
    lines = f"regexp_replace({lowered}, '{COPYRIGHT_LINE}', chr(10), 'g')"
    words = f"concat('  ', regexp_replace({lines}, '{PUNCTUATION}', '  ', 'g'), '  ')"
    for word, same in EQUIVALENT_WORDS.items():
        words = f"replace({words}, ' {word} ', ' {same} ')"
    return f"trim(regexp_replace({words}, '  +', ' ', 'g'))"


def duckdb_twin(docs: str) -> str:
    """``scan`` of a table ``docs(doc_id, text)`` with the known texts, as DuckDB SQL."""
    known = ", ".join(
        "('{}', '{}')".format(name.split("#")[0], text.replace("'", "''"))
        for name, text in KNOWN_TEXTS.items()
    )
    return f"""
WITH texts(licence, body) AS (VALUES {known}),
known AS (
    SELECT sha256({_duckdb_canonical("body")}) AS digest, min(licence) AS licence
    FROM texts GROUP BY 1
),
docs AS (
    SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS body FROM {docs}
),
lines AS (
    SELECT d.n, string_agg(DISTINCT k.licence, ',' ORDER BY k.licence) AS found
    FROM (SELECT n, unnest(string_split(body, chr(10))) AS line FROM docs) d
    JOIN known k ON k.digest = sha256({_duckdb_canonical("line")})
    GROUP BY d.n
),
whole AS (SELECT n, doc_id, sha256({_duckdb_canonical("body")}) AS digest FROM docs)
SELECT w.doc_id, w.digest, k.licence, coalesce(l.found, '') AS line_licences
FROM whole w LEFT JOIN known k USING (digest) LEFT JOIN lines l USING (n)
"""
