"""Word shingles as hashed sets, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    flat = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64)
    size = np.array([len(w) for w in words])
    start = np.cumsum(size) - size
    powers = np.full(int(size.max()), _ODD)
    powers[0] = 1
    powers = np.cumprod(powers)
    place = np.arange(len(flat)) - np.repeat(start, size)
    return mixed(np.add.reduceat((flat + np.uint64(1)) * powers[place], start) + size.astype(np.uint64))


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's shingles of ``size`` words.

    Words are ASCII-lower-cased and split at ASCII white space; fewer words than ``size`` make
    one shingle, no words none.
    """
    words = [(t or "").encode().lower().split() for t in texts]
    hashes = word_hashes([w for ws in words for w in ws])
    sets, at = [], 0
    for ws in words:
        own = hashes[at : at + len(ws)]
        at += len(ws)
        width = min(size, len(own))
        if not width:
            sets.append(own)
            continue
        h = np.full(len(own) - width + 1, np.uint64(width))
        for k in range(width):
            h = h * _ODD + own[k : len(own) - width + 1 + k]
        sets.append(np.unique(mixed(h)))
    return sets
