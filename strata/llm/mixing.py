"""Mixing sources to target weights.

Every row gets a hash-random key.  A source is cut at its word budget in key order: the keys
are split into ranges of a few thousand rows, the ranges' sums give distributed prefix sums, and
only the one range that the cut falls into is sorted.  Budgets beyond a source's size repeat
whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, word_count, written

#: Rows of a key range, on average; what one task sorts for a source.
ROWS_PER_RANGE = 4096


def _range_of(key, bits):
    """The top ``bits`` of a 64-bit key as a number from 0."""
    return F.when(bits == 0, F.lit(0).cast("long")).otherwise(
        F.expr("shiftrightunsigned(__key, 64 - __bits)")
    )


def _targets(sources: DataFrame, weights: tuple[int, ...], cap: float, share: float) -> DataFrame:
    """Adds ``__target``: weighted shares of all words, none above ``cap`` times its source.

    Sources that a round finds above their cap stay there and the rest is shared anew.  A round
    is one aggregate over the sources; only two numbers reach the driver.
    """
    spark = sources.sparkSession
    ordered = (
        sources.select("__source")
        .orderBy(F.col("__source").asc_nulls_last())
        .rdd.zipWithIndex()
        .map(lambda pair: (pair[0][0], pair[1]))
    )
    ranks = spark.createDataFrame(ordered, "__source string, __rank long")
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("__rank") % len(weights) + 1).cast("int"),
    )
    same = F.col("a.__source").eqNullSafe(F.col("b.__source"))
    weighed = written(
        sources.alias("a").join(ranks.alias("b"), same).select("a.*", weight.alias("__weight")),
        "mix-sources",
    )
    limit = F.col("__words") * F.lit(cap)
    total = weighed.agg(F.sum("__words")).first()[0] or 0
    rate = 0.0
    while True:
        above = limit <= F.lit(rate) * F.col("__weight")
        fixed, open_weight = weighed.agg(
            F.coalesce(F.sum(F.when(above, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("__weight"))), F.lit(0.0)),
        ).first()
        found = max(share * total - fixed, 0.0) / open_weight if open_weight else rate
        if found <= rate:
            break
        rate = found
    return weighed.withColumn("__target", F.least(limit, F.lit(rate) * F.col("__weight")))


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    cap: float = 3.0,
    share: float = 1.0,
    seed: int = 7,
) -> DataFrame:
    """All rows of ``docs`` with ``__size, __source_size, __target, __taken`` added.

    Sources in code point order, NULL last, get ``weights`` in turn; together they share
    ``share`` of all words.  ``__taken`` counts the words the mix takes of a row, repeats
    included: whole epochs plus, in key order, what is left of the target; the row the cut
    falls into is taken in part, so every source meets its target to the word.  NULL or
    wordless texts have size 0 and nothing is taken; NULL ids are ordinary; repeated rows are
    rows of their own that share a key and are ordered among themselves at will; an empty table
    gives an empty result.  Reruns agree as a multiset of rows.
    """
    keyed = docs.withColumns(
        {
            "__source": F.col(source_col),
            "__size": word_count(F.col(text_col)),
            "__key": F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)),
        }
    )
    narrow = written(keyed.select("__source", "__size", "__key"), "mix-keys")
    bits = F.greatest(
        F.ceil(F.log2(F.greatest(F.col("__rows"), F.lit(1)) / F.lit(float(ROWS_PER_RANGE)))),
        F.lit(0),
    ).cast("int")
    sources = narrow.groupBy("__source").agg(
        F.sum("__size").alias("__words"), F.count("*").alias("__rows")
    )
    sources = _targets(sources, weights, cap, share).withColumn("__bits", bits)
    epochs = F.when(
        F.col("__words") > 0, F.floor(F.col("__target") / F.col("__words"))
    ).otherwise(F.lit(0))
    sources = sources.withColumn("__epochs", epochs.cast("long")).withColumn(
        "__rest",
        F.round(F.col("__target") - F.col("__epochs") * F.col("__words")).cast("long"),
    )

    def of_source(rows: DataFrame, more: list[str]) -> DataFrame:
        same = F.col("a.__source").eqNullSafe(F.col("b.__source"))
        return rows.alias("a").join(sources.alias("b"), same).select(
            "a.*", *[f"b.{c}" for c in more]
        )

    # Prefix sums over the ranges; the cut is in the range where they pass the rest.
    sums = (
        of_source(narrow, ["__bits", "__rest"])
        .withColumn("__range", _range_of(F.col("__key"), F.col("__bits")))
        .groupBy("__source", "__range", "__rest")
        .agg(F.sum("__size").alias("__sum"))
    )
    running = F.sum("__sum").over(
        Window.partitionBy("__source")
        .orderBy("__range")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    cuts = (
        sums.withColumn("__through", running)
        .where(
            (F.col("__through") > F.col("__rest"))
            & (F.col("__through") - F.col("__sum") <= F.col("__rest"))
        )
        .select("__source", "__range", (F.col("__through") - F.col("__sum")).alias("__before"))
    )
    same = F.col("a.__source").eqNullSafe(F.col("b.__source"))
    sources = written(
        sources.alias("a")
        .join(cuts.alias("b"), same, "left")
        .select("a.*", F.col("b.__range").alias("__cut"), "b.__before"),
        "mix-cuts",
    )

    rows = of_source(
        keyed, ["__words", "__target", "__bits", "__epochs", "__rest", "__cut", "__before"]
    ).withColumn("__range", _range_of(F.col("__key"), F.col("__bits")))
    # Without a cut the rest is the whole source (or nothing of an empty one).
    more = F.when(
        F.col("__cut").isNull() | (F.col("__range") < F.col("__cut")), F.col("__size")
    ).otherwise(F.lit(0))
    whole = rows.where(F.col("__cut").isNull() | (F.col("__range") != F.col("__cut")))
    whole = whole.withColumn("__more", more.cast("long"))
    order = Window.partitionBy("__source").orderBy(
        "__key", F.col(id_col).asc_nulls_last(), "__size"
    )
    through = F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    left = F.col("__rest") - F.col("__before") - (through - F.col("__size"))
    cut = rows.where(F.col("__range") == F.col("__cut")).withColumn(
        "__more", F.least(F.greatest(left, F.lit(0)), F.col("__size")).cast("long")
    )
    taken = F.col("__epochs") * F.col("__size") + F.col("__more")
    return (
        whole.unionByName(cut)
        .withColumn("__taken", taken)
        .withColumn("__source_size", F.col("__words"))
        .select(*docs.columns, "__size", "__source_size", "__target", "__taken")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for every epoch a document is in.

    The one row of a source that the budget cuts is shortened to the words left of it.
    """
    text = options.get("text_col", "text")
    chosen = mix(docs, **options).where("__taken > 0")
    copies = chosen.withColumn(
        "__words",
        F.explode(
            F.expr(
                "concat(array_repeat(__size, cast(div(__taken, __size) as int)), "
                "filter(array(__taken % __size), x -> x > 0))".replace(
                    "div(__taken, __size)", "floor(__taken / __size)"
                )
            )
        ),
    )
    units = F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    shortened = F.array_join(F.slice(units, F.lit(1), F.col("__words").cast("int")), "")
    return copies.withColumn(
        text, F.when(F.col("__words") == F.col("__size"), F.col(text)).otherwise(shortened)
    ).select(*docs.columns)
