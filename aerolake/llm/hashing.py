"""64-bit hashes of words and shingles, over whole Arrow columns at a time.

A word's hash is the sum of a random number per byte times a power of an odd
random number by place, modulo 2 ** 64, then mixed. Two of a billion different
words meet with a chance below 3 in a hundred; every use says what a meeting does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE[_SPACE] = 0
_LOWER = _BYTE.copy()
_LOWER[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
#: Bytes of text handled at once.
_CHUNK = 2 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of the numbers over all bits; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_run(data: np.ndarray, starts: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the bytes and, for each document start, the words before it."""
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    inside = starts[starts < len(data)]
    first[inside] = ~space[inside]  # a document begins a word of its own
    at = np.flatnonzero(first)
    before = np.searchsorted(at, starts)
    if not len(at):
        return np.zeros(0, np.uint64), before
    # place of each byte in its word; what stands before the first word is 0 anyway
    place = np.arange(len(data), dtype=np.int32)
    place -= at.astype(np.int32)[np.maximum(np.cumsum(first, dtype=np.int32) - 1, 0)]
    np.maximum(place, 0, out=place)
    powers = np.full(int(place.max()) + 1, _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    values = table[data]
    values *= powers[place]
    return mix(np.add.reduceat(values, at) + np.uint64(1)), before


def word_hashes(column: pa.Array, lower: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Hashes of the words of consecutive documents, in chunks.

    Gives (first document, hashes, offsets): words of document first + i are
    hashes[offsets[i] : offsets[i + 1]]. Null texts have none.
    """
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    table, doc = _LOWER if lower else _BYTE, 0
    while doc < len(column):
        end = int(np.searchsorted(offsets, offsets[doc] + _CHUNK, side="right")) - 1
        end = min(max(end, doc + 1), len(column))
        own = data[offsets[doc] : offsets[end]]
        hashes, before = _hash_run(own, offsets[doc : end + 1] - offsets[doc], table)
        before[-1] = len(hashes)
        yield doc, hashes, before
        doc = end


_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` words (none, if there are fewer)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n] * _PLACE[0]
    for i in range(1, size):
        total += words[i : i + n] * _PLACE[i]
    return mix(total)


def whole(words: np.ndarray) -> np.ndarray:
    """One hash for the whole sequence."""
    powers = np.full(len(words), _BASE, np.uint64)
    return mix((words * np.cumprod(powers)).sum(dtype=np.uint64)[None] + np.uint64(len(words)))


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first document, sorted distinct shingle hashes of each document).

    ASCII letters count as lower case. With fewer words than ``size`` the whole
    sequence is the one shingle; without words the set is empty.
    """
    for doc, hashes, offsets in word_hashes(column, True):
        spans = zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
        runs = grams(hashes, size)
        sets = []
        for a, b in spans:
            if b - a >= size:
                own = np.sort(runs[a : b - size + 1])
                new = np.empty(len(own), bool)
                new[0] = True
                np.not_equal(own[1:], own[:-1], out=new[1:])
                sets.append(own[new])
            else:
                sets.append(whole(hashes[a:b]) if b > a else np.zeros(0, np.uint64))
        yield doc, sets
