"""SentencePiece encoding and decoding of merge-type vocabularies.

Adjacent symbols are merged by an agenda ordered by piece score, leftmost first, as the format
defines.  No piece joins a non-space to a following space mark, and none holds a line break, so
texts are cut there into segments whose agendas never meet; both properties are looked up in the
vocabulary and the cuts are left out where a vocabulary lacks them.  Segments repeat, so each
task remembers those it has seen.  In every Arrow batch the segments new to the task are also
given to the sentencepiece library; if the two should ever differ, the library's ids hold and
the row says so in ``n_corrected``.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = "▁"
#: Bytes of the segments a task remembers, in two generations; an entry's own share of it; and how
#: many segments that decode otherwise than they read are held.
REMEMBERED, ENTRY, FEW = 80 << 20, 220, 50_000
#: Characters encoded at once; a longer text is taken alone and whole.
PORTION = 1 << 20
#: Segments of up to two to this power characters are merged many at a time.
LONG = 6
NO_PAIR = np.iinfo(np.int32).max


class Vocabulary:
    def __init__(self, model_path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = self.library.get_piece_size()
        pieces = [self.library.id_to_piece(i) for i in range(size)]
        special = [
            self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i)
            for i in range(size)
        ]
        self.end = self.library.eos_id()
        self.ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        scores = sorted({self.library.get_score(i) for i in self.ids.values()}, reverse=True)
        place = {score: r for r, score in enumerate(scores)}
        self.rank = {p: place[self.library.get_score(i)] for p, i in self.ids.items()}
        self.bytes = {
            int(p[3:-1], 16): i for i, p in enumerate(pieces) if self.library.is_byte(i)
        }
        self.decimal = [str(i) for i in range(size)]
        self.surface = {i: p.encode() for p, i in self.ids.items()}
        self.written = {i: p.replace(SPACE, " ") for p, i in self.ids.items()}
        self.surface |= {i: bytes([b]) for b, i in self.bytes.items()}
        # Neighbours that no piece holds are never merged, nor anything across them.
        self.joined = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        spaced = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        broken = any("\n" in p for p in self.ids)
        if spaced:
            self.segments = re.compile(r"(?s).+")
        elif broken:
            self.segments = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        else:
            self.segments = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")
        #: Whether a line break stands alone in every text.
        self.breaks = not spaced and not broken
        # By number: which piece two neighbouring pieces make, and its rank.
        self.of_char = np.full(0x110000, -1, np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i
        made = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                left, right = self.ids.get(p[:k]), self.ids.get(p[k:])
                if left is not None and right is not None:
                    made[left << 32 | right] = self.rank[p], i
        self.pairs = np.array(sorted(made), np.int64)
        self.ranks, self.makes = (
            np.array([made[p][c] for p in self.pairs.tolist()], np.int32) for c in range(2)
        )

    def _pairs_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs among those that pieces are made of, and which are there at all."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return at, (self.pairs[at] == key) & (left >= 0) & (right >= 0)

    def merge_many(self, segments: list[str]) -> list[list[int]]:
        """Ids of many segments, their agendas kept as the rows of a matrix.

        A row holds the rank of each neighbouring pair; each turn merges the first best pair of
        every row and ranks its two new pairs, until no row has a pair that a piece joins.
        """
        n = len(segments)
        lengths = np.fromiter(map(len, segments), np.int64, n)
        chars = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        row, width = np.repeat(np.arange(n), lengths), int(lengths.max())
        ids = self.of_char[chars]
        symbols = np.full((n, width + 1), -1, np.int32)
        symbols[row, np.arange(len(chars)) - (np.cumsum(lengths) - lengths)[row]] = ids
        strange = np.bincount(row, ids < 0, n) > 0  # characters that are no pieces
        after = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))

        def ranked(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            at, known = self._pairs_of(left, right)
            return np.where(known, self.ranks[at], NO_PAIR)

        agenda = np.full(symbols.shape, NO_PAIR, np.int32)
        agenda[:, :-1] = ranked(symbols[:, :-1], symbols[:, 1:])
        active = np.arange(n)
        while len(active):
            ahead = agenda if len(active) == n else agenda[active]
            i = ahead.argmin(axis=1)
            open_ = ahead[np.arange(len(active)), i] != NO_PAIR
            active, i = active[open_], i[open_]
            j = after[active, i]
            k = after[active, j]
            made = self.makes[self._pairs_of(symbols[active, i], symbols[active, j])[0]]
            symbols[active, i], symbols[active, j] = made, -1
            after[active, i], before[active, np.minimum(k, width)] = k, i
            agenda[active, j] = NO_PAIR
            agenda[active, i] = ranked(made, symbols[active, np.minimum(k, width)])
            h = before[active, i]
            left = h >= 0
            agenda[active[left], h[left]] = ranked(symbols[active[left], h[left]], made[left])
        whole = symbols >= 0
        flat, ends = symbols[whole].tolist(), np.cumsum(whole.sum(axis=1)).tolist()
        return [
            self.merge(segment) if odd else flat[begin:end]
            for segment, odd, begin, end in zip(segments, strange.tolist(), [0, *ends], ends, strict=False)
        ]

    def merge(self, segment: str) -> list[int]:
        """Ids of one segment by the agenda: pairs by score, of one score the leftmost first.

        A symbol is a stretch of the segment, known by its start; ``after`` has its end.
        """
        rank, n = self.rank.get, len(segment)
        bits = n.bit_length()
        starts = (1 << bits) - 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # The agenda's entry of the pair that starts at each symbol; others are out of date.
        current = [-1] * n
        agenda = []
        for i in range(n - 1):
            r = rank(segment[i : i + 2])
            if r is not None:
                current[i] = entry = r << bits | i
                agenda.append(entry)
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            i = entry & starts
            if current[i] != entry:
                continue
            j = after[i]
            k = after[i] = after[j]
            current[i] = current[j] = -1
            if k < n:
                before[k] = i
                r = rank(segment[i : after[k]])
                if r is not None:
                    current[i] = entry = r << bits | i
                    heappush(agenda, entry)
            h = before[i]
            if h >= 0:
                r = rank(segment[h:k])
                if r is None:
                    current[h] = -1
                else:
                    current[h] = entry = r << bits | h
                    heappush(agenda, entry)
        found, i = [], 0
        while i < n:
            k = after[i]
            piece = self.ids.get(segment[i:k])
            if piece is not None:
                found.append(piece)
            else:
                found.extend(self.bytes[b] for b in segment[i:k].encode())
            i = k
        return found

    def parts(self, segment: str) -> list[str]:
        """The segment, cut between characters that no piece holds side by side."""
        cuts = [k for k in range(1, len(segment)) if segment[k - 1 : k + 1] not in self.joined]
        return [segment[a:b] for a, b in zip([0, *cuts], [*cuts, len(segment)], strict=True)]

    def decode(self, ids: list[int]) -> str:
        """Text of a segment's ids, its space marks as spaces."""
        try:
            return "".join([self.written[i] for i in ids])
        except KeyError:  # single bytes, or an end
            pass
        surface = b"".join(self.surface.get(i, b"") for i in ids)
        return surface.decode("utf-8", "replace").replace(SPACE, " ")

    def split(self, text: str) -> list[str]:
        return self.segments.findall(SPACE + text.replace(" ", SPACE)) if text else []


class Known(dict):
    """Segment -> its ids as decimal text, filled as segments are met.

    Two generations: once the younger holds ``REMEMBERED`` bytes it becomes the elder, of which
    only what is met again comes back.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.elder, self.size = vocabulary, {}, 0
        self.fresh: list[tuple[str, list[int]]] = []
        #: Segments whose ids decode to something else than their own text.
        self.decoded: dict[str, str] = {}

    def learn(self, segments: Iterable[str]) -> None:
        """Merges segments that are not known, those of like length together."""
        by_length: dict[int, list[str]] = {}
        for segment in set(segments):
            text = self.elder.get(segment)
            if text is not None:
                self.put(segment, text)
            else:
                by_length.setdefault((len(segment) - 1).bit_length(), []).append(segment)
        decimal = self.vocabulary.decimal
        for bits, alike in by_length.items():
            if bits <= LONG:
                found = self.vocabulary.merge_many(alike)
            else:
                merge, parts = self.vocabulary.merge, self.vocabulary.parts
                found = [[i for part in parts(segment) for i in merge(part)] for segment in alike]
            self.fresh.extend(zip(alike, found, strict=True))
            for segment, ids in zip(alike, found, strict=True):
                self.note(segment, ids)
                self.put(segment, " ".join([decimal[i] for i in ids]))

    def note(self, segment: str, ids: list[int]) -> None:
        surface = self.vocabulary.decode(ids)
        if surface != segment.replace(SPACE, " "):
            self.decoded[segment] = surface

    def put(self, segment: str, text: str) -> None:
        self[segment] = text
        self.size += ENTRY + 2 * len(segment) + len(text)

    def turn(self) -> None:
        if self.size > REMEMBERED:
            self.elder = dict(self)
            self.clear()
            self.size = 0
        if len(self.decoded) > FEW:
            self.elder, self.size = {}, 0
            self.clear()
            self.decoded.clear()


class Encoder:
    """Encodes texts, remembering segments and checking new ones by the library."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known, self.wrong = vocabulary, Known(vocabulary), set()

    def check(self) -> None:
        """Compares what is new with the library, whose ids hold."""
        fresh, self.known.fresh = self.known.fresh, []
        library = self.vocabulary.library
        # Behind a line break, where no piece joins one, a segment is encoded as it is inside a
        # text; elsewhere all segments start with the space mark that the library itself adds.
        if self.vocabulary.breaks:
            lead = len(library.encode("\n"))
            texts = ["\n" + s.replace(SPACE, " ") for s, _ in fresh]
        else:
            lead = 0
            fresh = [(s, own) for s, own in fresh if s[0] == SPACE != s]
            texts = [s[1:].replace(SPACE, " ") for s, _ in fresh]
        for (segment, own), ids in zip(fresh, library.encode(texts, num_threads=1), strict=True):
            if own != ids[lead:]:
                self.known.put(segment, " ".join(map(str, ids[lead:])))
                self.known.decoded.pop(segment, None)
                self.known.note(segment, ids[lead:])
                self.wrong.add(segment)

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[str, str, int]]:
        """Ids as decimal text, the text they decode to and corrected segments, of each text."""
        known, end = self.known, str(self.vocabulary.end)
        known.turn()
        cut = [self.vocabulary.split(t or "") for t in texts]
        found = [list(map(known.get, segments)) for segments in cut]
        open_ = [row for row, ids in enumerate(found) if None in ids]
        if open_:
            known.learn(
                s for row in open_ for s, ids in zip(cut[row], found[row], strict=True) if ids is None
            )
            self.check()
            for row in open_:
                found[row] = list(map(known.__getitem__, cut[row]))
        for text, segments, parts in zip(texts, cut, found, strict=True):
            parts.append(end)
            decoded = (text or "").replace(SPACE, " ")
            if known.decoded and not known.decoded.keys().isdisjoint(segments):
                decoded = "".join(known.decoded.get(s) or s.replace(SPACE, " ") for s in segments)[1:]
            wrong = sum(s in self.wrong for s in segments) if self.wrong else 0
            yield " ".join(parts), decoded, wrong


def portions(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """The first row and the texts of portions of few rows and bytes."""
    begin, held, size = 0, [], 0
    for row, text in enumerate(texts):
        held.append(text.as_py())
        size += len(held[-1] or "")
        if len(held) == 256 or size > PORTION:
            yield begin, held
            begin, held, size = row + 1, [], 0
    if held:
        yield begin, held


_loaded: dict[str, Encoder] = {}


def encode(
    docs: DataFrame,
    model_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    digests: bool = False,
) -> DataFrame:
    """Ids (with an end id) and the text they decode to, one row for each row of ``docs``.

    Columns: the id, ``n_tokens, ids, decoded, n_corrected``; with ``digests`` the ids (decimal,
    one space between) and the decoded text are given as ``ids_sha256, decoded_sha256``.  NULL
    and empty texts give the end id alone and an empty text; NULL ids and repeated rows are kept
    as they are; an empty table gives an empty result.  The model's path must exist on every
    executor, and its normalisation must be the identity with a leading space mark.
    """
    kind = dict(docs.dtypes)[id_col]
    names = [id_col, "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])]
    names.append("n_corrected")
    out = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if model_path not in _loaded:
            _loaded[model_path] = Encoder(Vocabulary(model_path))
        encoder = _loaded[model_path]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for frame in frames:
            for begin, texts in portions(frame.column(1)):
                ids, decoded, wrong = zip(*encoder(texts), strict=True)
                counts = np.array([i.count(" ") + 1 for i in ids], np.int64)
                if digests:
                    first = pa.array([sha(i) for i in ids], pa.string())
                    second = pa.array([sha(t) for t in decoded], pa.string())
                else:
                    flat = np.fromstring(" ".join(ids), np.int32, sep=" ")
                    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                    first = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                    second = pa.array(decoded, pa.string())
                own = frame.column(0).slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array(counts), first, second, pa.array(wrong, pa.int64())], names=names
                )

    return docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).mapInArrow(
        batches, f"`{id_col}` {kind}, n_tokens long, {out}, n_corrected long"
    )


def default_model(spark: SparkSession | None = None) -> str:
    """The model's path: ``spark.strata.sentencepiece.model``, or the installed public one."""
    configured = spark.conf.get("spark.strata.sentencepiece.model", None) if spark else None
    if configured:
        return configured
    import public_tokenizers

    return os.fspath(public_tokenizers.path("piece_bpe_32k.model"))
