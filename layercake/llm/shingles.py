"""Word shingles of many texts at once, as 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from layercake.llm.common import text_buffer

_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWER = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every word; A-Z count as a-z, words end at
    space, tab, line feed, vertical tab, form feed and carriage return."""
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    low = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    space = (low == 32) | ((low >= 9) & (low <= 13))
    begin = ~space
    begin[1:] &= space[:-1]
    first = offsets[:-1][np.diff(offsets) > 0]
    begin[first] = ~space[first]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.arange(len(low), dtype=np.int32)  # a text is below 2 GB
    place = np.where(begin, at, np.int32(0))
    np.maximum.accumulate(place, out=place)
    np.subtract(at, place, out=place)
    table = powers(_POWER, int(place.max()) + 1)
    value = table[place]
    value *= low.astype(np.uint16) + np.uint16(1)
    value[space] = 0
    return mix(np.add.reduceat(value, starts)), np.searchsorted(offsets, starts, "right") - 1


def shingle_sets(texts: pa.Array, words: int = 5, block: int = 1 << 20):
    """(text number, sorted distinct shingle hashes) of every text; a text of
    fewer words is one shingle, one without words has none."""
    data, offsets = text_buffer(texts)
    n = len(offsets) - 1
    s = 0
    while s < n:  # blocks of texts of about ``block`` bytes, one text at least
        e = max(s + 1, int(np.searchsorted(offsets, offsets[s] + block, "right")) - 1)
        hashes, owner = _words(data[offsets[s]:offsets[e]], offsets[s:e + 1] - offsets[s])
        counts = np.bincount(owner, minlength=e - s)
        ends = np.cumsum(counts)
        chained = hashes.copy()
        for k in range(1, words):
            if len(hashes) > k:
                chained[:-k] = mix(chained[:-k] * _ODD + hashes[k:])
        for i, (count, end) in enumerate(zip(counts.tolist(), ends.tolist())):
            if count >= words:
                yield s + i, np.unique(chained[end - count:end - words + 1])
            elif count:
                h = np.uint64(count)
                for w in hashes[end - count:end]:
                    h = mix(np.array([h], np.uint64) * _ODD + w)[0]
                yield s + i, np.array([h], np.uint64)
            else:
                yield s + i, np.empty(0, np.uint64)
        s = e
