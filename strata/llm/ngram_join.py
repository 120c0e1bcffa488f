"""N-gram Jaccard join: documents whose shingle sets are alike, and their components.

The document by n-gram incidence matrix is multiplied with itself in blocks, and only where it
has to be: with the n-grams of each row in one order, frequent ones last, two similar sets share
one of their first few n-grams, how many follows from their sizes.  Equal sets are one row.

1.  The rows of an n-gram are first checked against its hub, the row that meets the most others.
    That settles groups of copies with as many products as rows.
2.  What is left are rows of one n-gram in different components.  Those of a frequent n-gram are
    parted by size, so that only sets of neighbouring sizes meet.  The first n-gram that two
    similar sets share stands early in both, so a pair counts only where enough n-grams follow.
    Rows are multiplied block by block, counting the overlap of their leading n-grams; pairs below
    the bound that follows from their sizes are dropped, and the others are checked on their
    whole sets.

So no link between components is lost, and links inside a component are not all listed.  Of the
leading n-grams only those that a second set has among its own are moved: no other can overlap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata.llm.common import written
from strata.llm.graph import parents
from strata.llm.shingles import shingle_sets

#: Slots of the table that tells frequent n-grams from others; fixed, whatever the corpus.
SLOT_BITS = 22
#: N-grams a task counts at once, rows of a block of the product, rows that are paired by a join.
COUNTED, BLOCK_ROWS, FEW = 1_000_000, 512, 12
#: Times that an n-gram's rows are checked against one of them before all others are multiplied.
STAR_TURNS = 2
#: Bits of one of Spark's bitmaps; bits for each id that is looked for, and bitmaps at most (8 MB).
BITMAP_BITS, BITS_EACH, MOST_BITMAPS = 4096 * 8, 128, 2048


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _frequent(rows: DataFrame, size: int) -> np.ndarray:
    """A level for each slot: 0, or the log2 of how often its n-grams were met again.

    Only the order of the n-grams hangs on it, so that it merges n-grams and overlooks those
    that meet no task twice costs time at worst.
    """

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = [], 0

        def flushed():
            found, count = np.unique(np.concatenate(held), return_counts=True)
            often = count > 1
            slot, inverse = np.unique(_slots(found[often]), return_inverse=True)
            count = np.bincount(inverse.ravel(), count[often], len(slot)).astype(np.int64)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(slot), pa.array(count)], names=["slot", "n"])

        for batch in batches:
            for begin in range(0, batch.num_rows, 128):
                sets = shingle_sets(batch.column(0).slice(begin, 128).to_pylist(), size)
                held += sets
                total += sum(map(len, sets))
                if total > COUNTED:
                    yield flushed()
                    total = 0
        if held:
            yield flushed()

    met = (
        rows.select("text")
        .mapInArrow(again, "slot long, n long")
        .groupBy("slot")
        .agg(F.sum("n").alias("n"))
        .where("n >= 16")
        .toArrow()
    )
    levels = np.zeros(1 << SLOT_BITS, np.uint8)
    levels[met.column(0).to_numpy()] = np.minimum(np.log2(met.column(1).to_numpy()), 100)
    return levels


def ordered_ids(h: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The n-grams as numbers in the order of the join."""
    return np.sort((levels[_slots(h)].astype(np.int64) << 56) | (h >> np.uint64(8)).astype(np.int64))


def leading(n: int, num: int, den: int) -> int:
    """How many first n-grams of a set of n hold one of every similar set's."""
    return n - -(-n * num // den) + 1


def passing(a, b, n_a, n_b, overlap, num: int, den: int):
    """Whether pairs that share so many of their leading n-grams can still be similar.

    Of either side ``(ids, at, size, last)``: the leading n-grams that others have too, their places
    among the leading ones, how many of those there are, and the last.
    """
    needed = -(-num * (n_a + n_b) // (num + den))
    end = min(a[3], b[3])

    def upto(ids, at, size, last):  # at least so many stand up to the end
        k = np.searchsorted(ids, end, "right")
        return size if last == end else at[k - 1] + 1 if k else 0

    return min(n_a, n_b) >= needed and overlap >= max(
        upto(*a) - (n_a - needed), upto(*b) - (n_b - needed), 1
    )


def _products(table: pa.Table, num: int, den: int) -> Iterator[tuple[int, int]]:
    """Pairs of one n-gram's rows in different components that can be similar."""
    c, n, root, place, size, last = (table.column(x).to_numpy() for x in ("c", "n", "root", "place", "size", "last"))
    low, left, right = (table.column(x).to_numpy(zero_copy_only=False) for x in ("low", "left", "right"))
    a, b = np.flatnonzero(left), np.flatnonzero(right)
    of_a, of_b = lambda x: x[a][:, None], lambda x: x[b][None, :]
    needed = -(-num * (of_a(n) + of_b(n)) // (num + den))
    alike = np.minimum(of_a(n - place), of_b(n - place)) >= needed
    alike &= (of_a(root) != of_b(root)) & (of_a(low) | of_b(low)) & ((of_a(c) < of_b(c)) | ~of_b(left))
    some_a, some_b = alike.any(1), alike.any(0)
    if not some_a.any():
        return
    a, b = a[some_a], b[some_b]
    needed, alike = needed[some_a][:, some_b], alike[some_a][:, some_b]
    lists, places = (table.column(x).combine_chunks() for x in ("ids", "at"))
    flat, at = lists.flatten().to_numpy(), places.flatten().to_numpy()
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    row = np.repeat(np.arange(len(c)), np.diff(bounds))
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[column.ravel()] > 1
    row, column = row[shared], column.ravel()[shared]
    _, column = np.unique(column, return_inverse=True)
    column = column.ravel()
    width = int(column.max()) + 1 if len(column) else 0
    product = np.zeros((len(a), len(b)), np.float32)
    place_a, place_b = np.full(len(c), -1), np.full(len(c), -1)
    place_a[a], place_b[b] = np.arange(len(a)), np.arange(len(b))
    for begin in range(0, width, 2048):  # a strip of columns at a time
        here = (column >= begin) & (column < begin + 2048)
        dense = np.zeros((2, max(len(a), len(b)), min(2048, width - begin)), np.float32)
        for side, of in enumerate((place_a, place_b)):
            to = of[row[here]]
            dense[side, to[to >= 0], column[here][to >= 0] - begin] = 1
        product += dense[0, : len(a)] @ dense[1, : len(b)].T
    least = np.where(
        of_a(last) <= of_b(last), of_a(size) - of_a(n) + needed, of_b(size) - of_b(n) + needed
    )
    alike &= product >= np.maximum(least, 1)
    side = lambda x: (flat[bounds[x] : bounds[x + 1]], at[bounds[x] : bounds[x + 1]], size[x], last[x])
    for i, j in np.argwhere(alike):
        x, y = a[i], b[j]
        if passing(side(x), side(y), n[x], n[y], int(product[i, j]), num, den):
            yield int(min(c[x], c[y])), int(max(c[x], c[y]))


def with_id_among(
    rows: DataFrame, id_col: str, wanted: DataFrame, wanted_col: str, many: int | None = None
) -> DataFrame:
    """The rows whose id is wanted, and few others: an inner join on it must follow.

    Bitmaps of the wanted ids' hashes are sent to the rows, so that the join moves few texts.
    They are bounded; where they do not suffice for the ids, more rows pass.  ``many``: the number
    of the wanted rows, if it is known.
    """
    many = wanted.count() if many is None else many
    count = -(-many * BITS_EACH // BITMAP_BITS)
    bits = BITMAP_BITS << min(max(count - 1, 0).bit_length(), MOST_BITMAPS.bit_length() - 1)
    spot = lambda x: F.pmod(F.xxhash64(x), F.lit(bits)) + 1
    bitmaps = wanted.select(
        F.bitmap_bucket_number(spot(wanted_col)).alias("__bucket"), F.bitmap_bit_position(spot(wanted_col)).alias("bit")
    )
    bitmaps = bitmaps.groupBy("__bucket").agg(F.bitmap_construct_agg("bit").alias("__bitmap"))
    bit = F.bitmap_bit_position(spot(id_col))
    byte = F.conv(F.hex(F.substring("__bitmap", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.pmod(F.floor(byte / F.pow(F.lit(2.0), bit % 8)), F.lit(2)) == 1
    near = rows.withColumn("__bucket", F.bitmap_bucket_number(spot(id_col)))
    return near.join(F.broadcast(bitmaps), "__bucket").where(is_set).drop("__bucket", "__bitmap")


def size_band(n: Column, num: int, den: int) -> Column:
    """A number for sizes; sets that can be similar have the same or neighbouring ones."""
    # A little wider than the threshold's ratio, so that rounding cannot part two by more.
    return F.floor(F.log(n) / F.lit(1.0001 * math.log(den / num))) if num < den else n


def similar_components(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: tuple[int, int] = (80, 100),
) -> DataFrame:
    """One row for each row of ``docs``: the id, ``n_shingles, component_id, digest``.

    Two texts link if their sets' intersection is at least ``threshold`` of their union.
    ``component_id`` is the smallest id of the row's component; ``digest`` names the set.  Texts
    without words (NULL, empty) have no set, a NULL digest and their own id.  Rows without an id
    link like others but give no component its id; repeated rows share their set.  An empty
    table gives an empty result.
    """
    num, den = threshold
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["__id"]
    levels = spark.sparkContext.broadcast(_frequent(rows, size))
    names = ["__id", "n", "digest", "lead"]
    digest_of = lambda x: xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None

    def sets_of(batches, whole: bool):
        for batch in batches:
            for begin in range(0, batch.num_rows, 128):
                part = batch.slice(begin, 128)
                ids = [ordered_ids(h, levels.value) for h in shingle_sets(part.column(1).to_pylist(), size)]
                sizes = np.array([len(x) for x in ids])
                listed = ids if whole else [x[: leading(len(x), num, den)] if len(x) else x for x in ids]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum([len(x) for x in listed])]), pa.int32()),
                    pa.array(np.concatenate(listed) if listed else np.zeros(0, np.int64), pa.int64()),
                )
                digests = pa.array(map(digest_of, ids), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), digests, lists], names=names
                )

    heads = written(
        rows.mapInArrow(
            lambda b: sets_of(b, False), f"__id {kind}, n long, digest binary, lead array<long>"
        ),
        "join-heads",
    )
    classes = written(
        heads.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("__id").alias("rep"), F.first("n").alias("n"), F.first("lead").alias("lead"))
        .withColumn("c", F.monotonically_increasing_id()),
        "join-classes",
    )
    repeated_ids = bool(
        heads.where("digest is not null").groupBy("__id").count().where("count > 1").limit(1).count()
    )
    # Who else has a leading n-gram.  A text that others are copies of shares the most of them.
    entries = classes.select(F.posexplode("lead").alias("place", "s"), "c")
    met = entries.groupBy("s").agg(F.count("*").alias("many")).where("many > 1")
    shared = entries.join(met, "s").groupBy("c").agg(
        F.sum("many").alias("degree"), F.array_sort(F.collect_list(F.struct("s", "place"))).alias("met")
    )
    sizes = classes.select("c", "n", F.size("lead").alias("size"), F.element_at("lead", -1).alias("last"))
    lead = written(
        shared.join(sizes, "c").select(
            "c", "n", "degree", "size", "last", F.col("met.s").alias("ids"), F.col("met.place").alias("at")
        ),
        "join-shared",
    )
    postings = lead.select("c", "n", "degree", F.explode(F.arrays_zip("ids", "at")).alias("m"))
    postings = postings.select(
        F.col("m.ids").alias("s"), F.col("m.at").alias("place"), "c", "n", "degree", F.col("c").alias("root")
    )
    postings = written(postings, "join-postings")
    lead = lead.drop("degree")
    needed_of = lambda a, b: F.ceil(F.lit(num) * (F.col(a) + F.col(b)) / F.lit(num + den))

    def bounded(pairs: DataFrame) -> DataFrame:
        # Both sides, and the blocks below, read the leading n-grams in one form: one shuffle.
        full = pairs.alias("p").join(lead.alias("x"), F.col("p.a") == F.col("x.c"))
        full = full.join(lead.alias("y"), F.col("p.b") == F.col("y.c"))
        full = full.select("a", "b", *[F.col(f"{t}.{c}").alias(f"{c}_{t}") for t in "xy" for c in lead.columns[1:]])
        full = full.withColumn("needed", needed_of("n_x", "n_y")).withColumn("end", F.least("last_x", "last_y"))
        full = full.where(F.least("n_x", "n_y") >= F.col("needed"))
        overlap = F.size(F.array_intersect("ids_x", "ids_y"))

        def upto(t: str) -> Column:  # at least so many leading n-grams stand up to the end
            k = F.size(F.filter(f"ids_{t}", lambda i: i <= F.col("end")))
            known = F.coalesce(F.get(f"at_{t}", k - 1) + 1, F.lit(0))
            return F.when(F.col(f"last_{t}") == F.col("end"), F.col(f"size_{t}")).otherwise(known)

        return full.where(
            (overlap >= upto("x") - (F.col("n_x") - F.col("needed")))
            & (overlap >= upto("y") - (F.col("n_y") - F.col("needed")))
        ).select("a", "b")

    def checked(pairs: DataFrame) -> DataFrame:
        """The pairs that are similar on their whole sets."""
        pairs = written(pairs, "join-pairs")
        name = classes.select("c", "digest", "rep")
        for side in "ab":
            pairs = pairs.join(name.toDF(side, f"digest_{side}", f"rep_{side}"), side)
        pairs = written(pairs, "join-asked")
        # The row of a set's smallest id stands for it; its text stays where it is.
        asked = pairs.select(F.col("rep_a").alias("rep")).union(pairs.select("rep_b")).distinct()
        reps = Observation()
        asked = written(asked.observe(reps, F.count("*").alias("n")), "join-reps")
        texts = with_id_among(rows, "__id", asked, "rep", reps.get["n"])
        sets = texts.select("__id", "text").mapInArrow(
            lambda b: sets_of(b, True), f"__id {kind}, n long, digest binary, lead array<long>"
        ).drop("n").toDF("id", "digest", "ids")
        sets = written(sets.dropDuplicates(["id", "digest"]) if repeated_ids else sets, "join-sets")
        for side in "ab":
            of = sets.select(F.col("digest").alias(f"digest_{side}"), "id", F.col("ids").alias(f"ids_{side}"))
            pairs = pairs.join(of, f"digest_{side}").where(F.col("id").eqNullSafe(F.col(f"rep_{side}"))).drop("id")
        both = F.size(F.array_intersect("ids_a", "ids_b"))
        union = F.size("ids_a") + F.size("ids_b") - F.col("both")
        return pairs.withColumn("both", both).where(F.col("both") * den >= union * num).select("a", "b")

    def joined(roots: DataFrame | None, new: DataFrame) -> DataFrame:
        """The roots after new links; the components known so far are taken as stars."""
        return parents(new if roots is None else roots.toDF("a", "b").union(new))

    sizes_alike = lambda a, b: F.least(a, b) * den >= F.greatest(a, b) * num
    hub = F.max(F.struct("degree", "c", "root", "n")).alias("hub")
    placed, roots = postings, None
    for turn in range(STAR_TURNS):
        hubs = placed.groupBy("s").agg(F.min("root").alias("low"), F.max("root").alias("high"), hub)
        hubs = hubs.where("low != high").select("s", "hub")
        if turn:  # the first hubs have met all: now the best of the other components
            hubs = placed.join(hubs.withColumnRenamed("hub", "met"), "s").where("root != met.root")
            hubs = hubs.groupBy("s").agg(hub)
        stars = placed.join(hubs, "s").where("root != hub.root")
        stars = stars.where(sizes_alike("n", F.col("hub.n"))).select(F.least("c", "hub.c").alias("a"), F.greatest("c", "hub.c").alias("b"))
        roots = joined(roots, checked(bounded(written(stars.distinct(), "join-stars"))))
        placed = placed.drop("root").join(roots.withColumnRenamed("node", "c"), "c", "left")
        placed = written(placed.withColumn("root", F.coalesce("root", "c")), "join-placed")
    mixed = (
        placed.groupBy("s")
        .agg(F.count("*").alias("many"), F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low != high")
        .select("s", "many")
    )
    # Rows of one cell are compared: those of an n-gram, or of a frequent one those of a size band
    # (low) with one another and with those of the next band.
    own = F.when(F.col("many") > FEW, size_band(F.col("n"), num, den)).otherwise(F.lit(0)).cast("long")
    bands = F.when(F.col("many") > FEW, F.array(own, own - 1)).otherwise(F.array(own))
    banded = placed.drop("degree").join(mixed, "s").withColumn("band", F.explode(bands))
    banded = written(banded.withColumn("low", F.col("band") == own), "join-banded")
    rows_after = F.col("n") - F.col("place")
    cells = (
        banded.where(F.col("many") > FEW)
        .groupBy("s", "band")
        .agg(
            F.count("*").alias("many"), F.min("root").alias("from"), F.max("root").alias("to"),
            F.bool_or("low").alias("any_low"), F.min("n").alias("least"), F.max(rows_after).alias("most"),
        )
        .where("from != to AND any_low")
        .drop("from", "to", "any_low")
    )
    frequent = banded.where(F.col("many") > FEW).drop("many").join(cells, ["s", "band"])
    # Not the rows that even the smallest and the earliest of the cell cannot match.
    smallest = F.greatest("least", F.ceil(F.col("n") * num / F.lit(den)))
    needed = F.ceil(F.lit(num) * (F.col("n") + smallest) / F.lit(num + den))
    frequent = frequent.where(F.least(rows_after, "most") >= needed).drop("least", "most")
    few = banded.where(F.col("many") <= FEW).unionByName(frequent.where(F.col("many") <= FEW)).drop("many")
    of = lambda c, side: F.col(f"{side}.{c}")
    pairs = few.alias("x").join(few.alias("y"), (of("s", "x") == of("s", "y")) & (of("band", "x") == of("band", "y")))
    pairs = pairs.where((of("c", "x") < of("c", "y")) & (of("root", "x") != of("root", "y")) & (of("low", "x") | of("low", "y")))
    after = F.least(of("n", "x") - of("place", "x"), of("n", "y") - of("place", "y"))
    pairs = pairs.where(after >= needed_of("x.n", "y.n"))
    pairs = bounded(pairs.select(of("c", "x").alias("a"), of("c", "y").alias("b")).distinct())
    left = frequent.where(F.col("many") > FEW)
    left = left.withColumn("blocks", F.ceil(F.col("many") / F.lit(float(BLOCK_ROWS))))
    left = left.withColumn("block", F.pmod(F.xxhash64("c"), F.col("blocks")))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = left.select(
        "s", "band", "c", "root", "place", "low",
        F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block",
    ).join(lead, "c")

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held)
        keys = ("s", "band", "i", "j")
        t = t.sort_by([(x, "ascending") for x in keys])
        *marks, block = (t.column(x).to_numpy() for x in (*keys, "block"))
        t = t.append_column("left", pa.array(block == marks[2]))
        t = t.append_column("right", pa.array(block == marks[3]))
        change = np.concatenate([[True], np.any([m[1:] != m[:-1] for m in marks], axis=0)])
        starts = np.append(np.flatnonzero(change), t.num_rows)
        found: set[tuple[int, int]] = set()
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if b - a > 1:
                found.update(_products(t.slice(a, b - a), num, den))
        pairs = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"]
        )

    crossing = left.repartition("s", "band", "i", "j").mapInArrow(multiplied, "a long, b long")
    roots = joined(roots, checked(crossing.union(pairs).distinct()))
    named = classes.join(roots.withColumnRenamed("node", "c"), "c", "left").withColumn(
        "root", F.coalesce("root", "c")
    )
    smallest = named.groupBy("root").agg(F.min("rep").alias("component"))
    of_set = named.join(smallest, "root").select("digest", "component")
    return heads.join(of_set, "digest", "left").select(
        F.col("__id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("digest").isNull(), F.col("__id")).otherwise(F.col("component")).alias("component_id"),
        F.hex("digest").alias("digest"),
    )


def representatives(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component of similar texts: that of the smallest id.

    Texts without words stay, and so do rows without an id, which nothing can name; of rows equal
    in id and text one stays.
    """
    found = similar_components(docs, id_col=id_col, text_col=text_col, **options)
    kept = found.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("__kept"))
    kept = written(kept.distinct(), "join-kept")
    stays = docs.join(kept, F.col(id_col) == F.col("__kept"), "left_semi")
    if docs.where(F.col(id_col).isNull()).limit(1).count():
        stays = stays.unionByName(docs.where(F.col(id_col).isNull()))
    if docs.groupBy(id_col).count().where("count > 1").limit(1).count():
        stays = stays.dropDuplicates([id_col, text_col])
    return stays
