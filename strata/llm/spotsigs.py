"""Document fingerprints by SpotSigs, in SQL functions only.

A signature is an anchor, a run of common words, with the next two content words behind it.  A
text's fingerprint is the sorted set of its signatures' hashes.  Fingerprints are compared by
Jaccard likeness; sets that are too different in length to reach a threshold are never compared:
they are partitioned by length, and inside a partition only sets that share one of their rare
signatures meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written

#: Frequent function words of English, German, French and Spanish.
COMMON_WORDS = (
    "the of and to in a is that for it on was with be as by this are at from or an "
    "der die und das den von zu mit ist des im auf für ein eine nicht "
    "le la les de et en un une du est que qui dans pour par sur avec au "
    "el los y del las con para es no se"
).split()


def _one_of(words: set[str]) -> str:
    """Pattern of any of the words, by first letter so that few alternatives are tried."""
    initials = sorted({w[0] for w in words})
    endings = ("|".join(sorted(w[1:] for w in words if w[0] == c)) for c in initials)
    return "|".join(f"{c}(?:{e})" for c, e in zip(initials, endings, strict=True))


def signatures(text: Column, common: list[str] | None = None) -> Column:
    """Sorted distinct hashes of the text's signatures.

    A text without any has one for its words as a whole, a text without words one for its
    characters, and an empty text none.
    """
    words = _one_of(set(common or COMMON_WORDS))
    plain = F.concat(
        F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" ")
    )
    run, skipped, content = f"((?:(?:{words}) )++)", f"(?:(?:{words}) )*+", "([^ ]+) "
    marked = F.regexp_replace(plain, f"(?<![^ ]){run}{content}(?={skipped}{content})", "\n$1$2 $3\n")
    spots = F.filter(F.split(marked, "\n"), lambda _, i: i % 2 == 1)
    hashed = F.array_sort(F.array_distinct(F.transform(spots, lambda s: F.hash(s))))
    whole = F.array(F.hash(F.lit("whole"), F.when(plain != " ", plain).otherwise(text)))
    none = F.expr("cast(array() as array<int>)")
    # A lambda's argument is evaluated once, a column that is named twice in a CASE is not.
    found = F.transform(F.array(hashed), lambda h: F.when(F.size(h) > 0, h).otherwise(whole))
    return F.when(text.isNull() | (text == ""), none).otherwise(F.element_at(found, 1))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def fingerprint(signed: Column) -> Column:
    """The set as text: its numbers, ascending, one space between."""
    return F.array_join(signed.cast("array<string>"), " ")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row the id, ``signatures`` and ``fingerprint``; NULL texts count as empty.

    Rows without an id and repeated rows are ordinary; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col), signatures(text).alias("signatures"))
    return found.withColumn("fingerprint", fingerprint(F.col("signatures")))


def near_pairs(signed: DataFrame, *, id_col: str = "doc_id", threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(membership, links) of ``fingerprints``' rows.

    Rows of equal sets are one class, named by its fingerprint's SHA-256: ``<id>, class``.  Links
    are pairs of classes ``a, b, likeness`` of at least ``threshold``.  Sets are dealt into bands of
    lengths such that partners are in the same or the next band; within a band they meet at the
    first few of their signatures, rarest first, that any partner must share.  Empty sets link
    with nothing.
    """
    rows = signed.withColumn("class", F.sha2("fingerprint", 256))
    classes = written(
        rows.where(F.size("signatures") > 0).select("class", "signatures").dropDuplicates(["class"]),
        "spot-classes",
    )
    entries = classes.select("class", F.size("signatures").alias("n"), F.explode("signatures").alias("s"))
    df = entries.groupBy("s").agg(F.count("*").alias("df"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy("df", "s"))
    first = F.col("n") - F.ceil(F.col("n") * threshold) + 1
    band = F.floor(F.log("n") / F.lit(-1.0) / F.log(F.lit(threshold)))
    leading = entries.join(df, "s").where("df > 1").withColumn("rank", rank)
    # Signatures of one class alone come first in its order, but no partner shares them.
    alone = F.col("n") - F.count("*").over(Window.partitionBy("class"))
    leading = leading.withColumn("rank", F.col("rank") + alone).where(F.col("rank") <= first)
    leading = written(leading.select("class", "n", "s", band.alias("band")), "spot-leading")
    other = leading.select(
        F.col("class").alias("b"), F.col("n").alias("m"), "s",
        F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"),
    )
    met = leading.join(other, ["s", "band"]).where(
        (F.col("class") != F.col("b"))
        & (F.least("n", "m") >= F.greatest("n", "m") * threshold)
        & ((F.floor(F.log("m") / F.lit(-1.0) / F.log(F.lit(threshold))) > F.col("band")) | (F.col("class") < F.col("b")))
    )
    pairs = met.select(F.least("class", "b").alias("a"), F.greatest("class", "b").alias("b")).distinct()
    of = lambda side: classes.toDF(side, f"s_{side}")
    compared = pairs.join(of("a"), "a").join(of("b"), "b")
    links = compared.select("a", "b", likeness(F.col("s_a"), F.col("s_b")).alias("likeness"))
    return rows.select(id_col, "class"), links.where(F.col("likeness") >= threshold)


def _successors(ids: DataFrame) -> DataFrame:
    """``id, next``: the next smaller id, NULL last, and the first again after the last.

    Ranges of ids are dealt to tasks; only each range's first id meets the others'.
    """
    order = F.col("id").desc_nulls_last()
    ranged = ids.distinct().repartitionByRange(order).withColumn("part", F.spark_partition_id())
    ranged = written(ranged, "spot-ids")
    inside = F.lead(F.struct("id")).over(Window.partitionBy("part").orderBy(order))
    firsts = ranged.groupBy("part").agg(F.max_by(F.struct("id"), F.struct(F.col("id").isNotNull(), "id")).alias("first"))
    after = firsts.select(
        "part",
        F.coalesce(
            F.lead("first").over(Window.orderBy("part")),
            F.first("first").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        ).alias("after"),
    )
    return ranged.withColumn("inside", inside).join(after, "part").select(
        "id", F.coalesce("inside", "after").getField("id").alias("next")
    )


def compare_edited(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of an edited one and of the next one, and their likeness.

    The edited text has its last half (rounded down) replaced by as many first characters of the
    next text: that of the next smaller id, the largest after the smallest; rows without an id
    come last.  Of rows that share an id the least text is the next one to others.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    after = written(_successors(rows.select("id")), "spot-next")
    repeated = bool(rows.groupBy("id").count().where("count > 1").limit(1).count())
    following = rows.groupBy("id").agg(F.min("text").alias("text")) if repeated else rows
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    own = rows.select(
        "id", n.alias("n_chars"), half.alias("half"),
        F.expr("left(text, length(text) - cast(floor(length(text) / 2) as int))").alias("head"),
        signatures(F.col("text")).alias("signed"),
    )
    columns = ["id", "n_chars", "half", "head", "signed", "text"]
    whole = dict(rows.dtypes)["id"] in ("bigint", "int", "smallint", "tinyint")
    if whole and not rows.where("id is null").limit(1).count():
        # Where the id before exists it is the next one, so most texts move once; only behind a
        # gap the next id has to be looked up.
        guess = following.select(F.try_add("id", F.lit(1)).alias("id"), "text")
        guessed = own.join(guess, "id", "left")
        met = guessed.where(F.col("text").isNotNull()).select(*columns)
        gaps = written(after.where(~F.col("next").eqNullSafe(F.try_subtract("id", F.lit(1)))), "spot-gaps")
        rest = guessed.where(F.col("text").isNull()).drop("text").join(gaps, "id")
        ends = gaps.select("next").distinct()
        ends = following.join(ends, F.col("id") == F.col("next")).select("next", "text")
        joined = met.unionByName(rest.join(ends, "next").select(*columns))
    else:
        key = lambda c: F.struct(F.col(c).isNull(), F.coalesce(F.col(c).cast("string"), F.lit("")))
        mapped = own.withColumn("k", key("id")).join(
            after.select(key("id").alias("k"), key("next").alias("next")), "k"
        )
        following = following.select(key("id").alias("next"), "text")
        joined = mapped.join(following, "next").select(*columns)
    joined = joined.withColumn("next_signed", signatures(F.col("text")))
    edited = F.concat("head", F.expr("left(text, half)"))
    joined = joined.select("id", "n_chars", "signed", "next_signed", edited.alias("edited"))
    joined = joined.withColumn("edited_signed", signatures(F.col("edited")))
    return joined.select(
        F.col("id").alias(id_col),
        F.col("n_chars").cast("long"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("signed")).alias("fingerprint"),
        fingerprint(F.col("edited_signed")).alias("edited_fingerprint"),
        likeness(F.col("signed"), F.col("edited_signed")).alias("near_edited"),
        likeness(F.col("signed"), F.col("next_signed")).alias("near_next"),
    )
