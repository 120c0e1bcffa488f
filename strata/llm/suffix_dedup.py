"""Suffix-array dedup: removes bytes of every long string that also starts earlier.

A string of ``length`` bytes is found by the least hash of the short grams inside it, which
depends on nothing else, so equal strings meet under the same anchor.  Neighbouring strings with
one anchor form a unit; units that repeat as a whole are settled by a minimum, and only where one
anchor has units of different bytes are their suffixes sorted: multikey quicksort to a shallow
depth, eight bytes at a time, then blind tries for the groups that share the whole depth.  A trie
is grown for all groups of a task at once: each round compares a group with its first suffix
and branches by common length and next byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written

GRAM = 24
SHALLOW_WORDS = 3
#: Bytes hashed at once, units a map task combines, suffixes that a task sorts and compares at once.
CHUNK, COMBINED, SORTED, COMPARED = 1 << 18, 400_000, 1_000_000, 1 << 16
#: Units of different bytes under one anchor that one task sorts; more are split by prefix.
HOT_ANCHOR = 4096


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the gram at each place (the last ones run over the end and are not used)."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    powers, factor = {}, np.uint64(0xD6E8FEB86659FD93)
    for width in (1, 2, 4, 8):
        h = h[:-width] * factor + h[width:]
        powers[2 * width] = h
        with np.errstate(over="ignore"):
            factor = factor * factor
    h = powers[16][: len(powers[8]) - 16] * np.uint64(0xA24BAED4963EE407) + powers[8][16:]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(28))


def _sliding_min(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Least of each ``width`` neighbours and of each ``width - 1``."""
    span = 1
    while span * 2 < width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    within = lambda w: np.minimum(h[: len(h) - (w - span)], h[w - span :])
    return within(width), within(width - 1) if width - 1 > span else h


def units(texts: list[bytes], length: int) -> Iterator[tuple[int, int, int, int, int, bool]]:
    """(text, first window, windows, anchor, hash of the bytes, repetitive) of each unit.

    A unit can hold one string twice only if the anchor's gram stands in it twice.
    """
    width = length - GRAM + 1
    for first, group in _chunks(texts):
        data = np.frombuffer(b"".join(group), np.uint8)
        ends = np.cumsum([len(t) for t in group])
        if len(data) < length:
            continue
        grams = _gram_hashes(data)
        least, rest = _sliding_min(grams, width)
        doc = np.repeat(np.arange(len(group)), [len(t) for t in group])[: len(least)]
        place = np.arange(len(least))
        inside = np.flatnonzero(place + length <= ends[doc])
        if not len(inside):
            continue
        twice = np.zeros(len(least) + 1, bool)
        twice[: len(least) - 1] = (grams[: len(least) - 1] == least[:-1]) & (rest[1 : len(least)] == least[:-1])
        far = grams[: max(len(least) - width, 0)]
        twice[: len(far)] |= (far == least[: len(far)]) & (far == grams[width : width + len(far)])
        least, doc, twice = least[inside], doc[inside], twice[inside]
        new = np.flatnonzero((least[1:] != least[:-1]) | (doc[1:] != doc[:-1])) + 1
        begin = np.concatenate([[0], new])
        count = np.diff(np.concatenate([begin, [len(inside)]]))
        at = inside[begin]
        inner = np.logical_or.reduceat(twice, begin)
        last = grams[(at + count - 1)[:, None] + np.arange(width)]
        inner |= (last == least[begin][:, None]).sum(axis=1) > 1
        raw, digest = data.tobytes(), xxhash.xxh3_64_intdigest
        starts = ends - [len(t) for t in group]
        hashes = [digest(raw[a:b]) for a, b in zip(at.tolist(), (at + count - 1 + length).tolist(), strict=True)]
        yield from zip(
            (doc[begin] + first).tolist(),
            (at - starts[doc[begin]]).tolist(),
            count.tolist(),
            least[begin].astype(np.int64).tolist(),
            np.array(hashes, np.uint64).astype(np.int64).tolist(),
            inner.tolist(),
            strict=True,
        )


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if texts:
        yield begin, texts[begin:]


def _word(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    view = np.ndarray((len(raw) - 7,), ">u8", raw, strides=(1,))
    return view[at].astype(np.uint64)


def prefix_bucket(raw: np.ndarray, at: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of the 32 bytes at each place."""
    h = np.zeros(len(at), np.uint64)
    for k in range(0, 32, 8):
        h = (h ^ _word(raw, at + k)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return (h % np.uint64(buckets)).astype(np.int64)


def repeated(raw: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Which of the strings at ``at``, given earliest first, equal one before them."""
    found = np.zeros(len(at), bool)
    live, group = np.arange(len(at)), np.zeros(len(at), np.int64)

    def regroup(live, group, *keys):
        """Sorts by group and keys, keeping order; drops what is alone."""
        by = np.lexsort((*keys[::-1], group))
        columns = [group[by], *[k[by] for k in keys]]
        change = np.zeros(len(by), bool)
        change[:1] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        number = np.cumsum(change) - 1
        many = np.bincount(number)[number] > 1 if len(by) else change
        return live[by][many], number[many]

    shallow = min(SHALLOW_WORDS, length // 8)
    for k in range(shallow):  # multikey quicksort
        live, group = regroup(live, group, _word(raw, at[live] + 8 * k))
    depth = 8 * shallow
    tail = np.arange(depth, length)
    while len(live):  # blind tries: a group's first suffix is the path that the others leave
        leads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        lead = live[np.repeat(leads, np.diff(np.concatenate([leads, [len(live)]])))]
        common, byte = np.empty(len(live), np.int64), np.zeros(len(live), np.int64)
        for begin in range(0, len(live), COMPARED):
            part = slice(begin, begin + COMPARED)
            own = raw[at[live[part]][:, None] + tail]
            differs = own != raw[at[lead[part]][:, None] + tail]
            common[part] = np.where(differs.any(axis=1), differs.argmax(axis=1), len(tail))
            column = np.minimum(common[part], len(tail) - 1)
            byte[part] = own[np.arange(len(own)), column]
        same = common == len(tail)
        found[live[same]] = True
        found[live[leads]] = False
        live, group = regroup(live[~same], group[~same], common[~same], byte[~same])
    return found


def _runs(doc, place, flag, length):
    """(doc, start, end) of flagged neighbouring windows."""
    doc, place = doc[flag], place[flag]
    if not len(doc):
        return doc, place, place
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (place[1:] != place[:-1] + 1)])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(doc) - 1]])
    return doc[first], place[first], place[last] + length


def dedup(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 100
) -> DataFrame:
    """For each row of ``docs`` the id, ``n_bytes, n_removed, n_spans, kept`` (binary).

    Removed is each byte of a ``length``-byte string (at least 32) that starts earlier as well: in a row of
    smaller id, or before in the same row.  NULL texts are empty, texts shorter than ``length``
    lose nothing; rows without an id come last, rows that share an id are ordered by the
    SHA-256 of their texts, and of rows equal in both all but one lose what they can.  Bytes are those
    of UTF-8, so ``kept`` need not be valid text.  An empty table gives an empty result.
    """
    if length < 32:
        raise ValueError("strings of at least 32 bytes are looked for")
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    plain = dict(rows.dtypes)["__id"] in ("bigint", "int", "smallint", "tinyint")
    odd = not plain or bool(
        rows.groupBy("__id").count().where("__id is null or count > 1").limit(1).count()
    )
    if odd:  # ids that do not order the rows by themselves: number the distinct rows
        rows = rows.withColumn("__sha", F.sha2(F.col("text"), 256))
        order = rows.groupBy("__id", "__sha").agg(F.count("*").alias("__times"))
        order = order.orderBy(F.col("__id").asc_nulls_last(), "__sha").withColumn("key", F.lit(0).cast("long"))
        schema = order.schema
        numbered = order.rdd.zipWithIndex().map(lambda x: (*x[0][:-1], x[1]))
        numbered = written(docs.sparkSession.createDataFrame(numbered, schema), "suffix-order")
        same = F.col("a.__sha") == F.col("b.__sha")
        rows = (
            rows.dropDuplicates(["__id", "__sha"]).alias("a")
            .join(numbered.alias("b"), F.col("a.__id").eqNullSafe(F.col("b.__id")) & same)
            .select("a.__id", "a.text", "b.key", "b.__times")
        )
    else:
        rows = rows.withColumn("key", F.col("__id").cast("long")).withColumn("__times", F.lit(1).cast("long"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Units; of those that repeat in this task only the first stays a candidate."""
        seen: dict[tuple[int, int], tuple[int, int, int, bool]] = {}
        late: list[tuple] = []

        def flushed():
            data = [(*unit, *first, True) for unit, first in seen.items()] + late
            columns = list(zip(*data, strict=True)) if data else [[]] * 7
            kinds = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.bool_()] * 2
            seen.clear()
            late.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["anchor", "unit", "key", "place", "windows", "inner", "open"],
            )

        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                keys = part.column(0).to_pylist()
                texts = [t.encode() for t in part.column(1).to_pylist()]
                for doc, place, n, anchor, unit, inner in units(texts, length):
                    new, old = (keys[doc], place, n, inner), seen.get((anchor, unit))
                    if old is None or new < old:
                        seen[anchor, unit] = new
                        new = old
                    if new is not None:
                        spread = (new[0] * 0x9E3779B97F4A7C15 + new[1] * 0xD6E8FEB86659FD93) % (1 << 64)
                        late.append((spread - (1 << 63), 0, *new, False))
                if len(seen) + len(late) > COMBINED:
                    yield flushed()
        yield flushed()

    found = rows.select("key", "text").mapInArrow(
        cut, "anchor long, unit long, key long, place int, windows int, inner boolean, open boolean"
    )
    # One shuffle, by anchor.  What a task knew to be late carries a number of its own for an
    # anchor, so frequent units don't meet in one task.
    by_unit = Window.partitionBy("anchor", "unit").orderBy("key", "place")
    by_anchor = Window.partitionBy("anchor")
    ranked = (
        found.withColumn("first", F.col("open") & (F.row_number().over(by_unit) == 1))
        .withColumn("mixed", F.col("inner") | (F.min("unit").over(by_anchor) != F.max("unit").over(by_anchor)))
        .withColumn("many", F.count("*").over(by_anchor))
        .where("not first or mixed")
        .select("anchor", "key", "place", "windows", "first", "many")
    )
    hits = written(ranked, "suffix-hits")
    whole = hits.where("not first").select(
        "key", F.col("place").alias("start"), (F.col("place") + F.col("windows") - 1 + length).alias("end")
    )
    asked = hits.where("first").groupBy("key").agg(
        F.collect_list(F.struct("anchor", "place", "windows", "many")).alias("asked")
    )
    windows = hits.where("first").agg(F.coalesce(F.sum("windows"), F.lit(0))).first()[0]

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, text, asked in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                data = text.encode()
                raw = np.frombuffer(data, np.uint8)
                for a in asked:
                    place, n = a["place"], a["windows"]
                    parts = -(-a["many"] // HOT_ANCHOR)
                    held = [0]
                    if parts > 1:
                        held = np.unique(prefix_bucket(raw, np.arange(place, place + n), parts)).tolist()
                    body = data[place : place + n - 1 + length]
                    out += [(a["anchor"], part, parts, key, place, body) for part in held]
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["anchor", "part", "parts", "key", "place", "body"],
            )

    def sorted_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        t = pa.Table.from_batches(held).sort_by([("key", "ascending"), ("place", "ascending")])
        part, parts, key, place = (t.column(c).to_numpy() for c in ("part", "parts", "key", "place"))
        bodies = t.column("body").to_pylist()
        raw = np.frombuffer(b"".join(bodies), np.uint8)
        size = np.array([len(b) for b in bodies])
        count = size - length + 1
        unit = np.repeat(np.arange(len(size)), count)
        step = np.arange(len(unit)) - np.repeat(np.cumsum(count) - count, count)
        at = (np.cumsum(size) - size)[unit] + step
        mine = np.ones(len(at), bool)
        for n in np.unique(parts[parts > 1]):
            of = np.flatnonzero(parts[unit] == n)
            mine[of] = prefix_bucket(raw, at[of], int(n)) == part[unit[of]]
        unit, step, at = unit[mine], step[mine], at[mine]
        where = place[unit].astype(np.int64) + step
        # Units under different anchors never hold equal strings, so one sort serves all.
        order = np.lexsort((where, key[unit]))
        unit, where, at = unit[order], where[order], at[order]
        flag = repeated(raw, at, length)
        doc, start, end = _runs(key[unit], where, flag, length)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
            names=["key", "start", "end"],
        )

    texts = rows.repartition("key")
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), windows // SORTED + 1)
    fine = (
        texts.join(asked, "key")
        .select("key", "text", "asked")
        .mapInArrow(fetched, "anchor long, part int, parts int, key long, place int, body binary")
        .repartition(tasks, "anchor", "part")
        .mapInArrow(sorted_, "key long, start int, end int")
    )
    spans = written(whole.unionByName(fine), "suffix-spans").groupBy("key").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )
    id_kind = dict(rows.dtypes)["__id"]
    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept"]

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for i, (text, spans, times) in enumerate(
                zip(*[batch.column(j).to_pylist() for j in (1, 2, 3)], strict=True)
            ):
                data, kept, end, n = text.encode(), [], 0, 0
                begin = None
                for s in sorted((x["start"], x["end"]) for x in spans or ()):
                    if begin is None or s[0] > end:
                        kept.append(data[end : s[0]])
                        n += 1
                        begin, end = s
                    else:
                        end = max(end, s[1])
                kept = b"".join(kept) + data[end:]
                out.append((len(data), len(data) - len(kept), n, kept))
                ids.append(i)
                for _ in range(times - 1):
                    gone = len(data) >= length
                    out.append((len(data), len(data) * gone, int(gone), b"" if gone else data))
                    ids.append(i)
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64()))]
                + [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=names,
            )

    return (
        texts.join(spans, "key", "left")
        .select("__id", "text", "spans", "__times")
        .mapInArrow(removed, f"`{id_col}` {id_kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    )
