"""UTF-8 columns of an Arrow batch as numpy arrays, and rolling hashes over them.

A word is a run of bytes outside space, tab, newline, vertical tab, form feed and
carriage return; ``bytes.split()`` cuts at the same six bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Odd multipliers of the 64-bit finaliser of the splitmix generator.
_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: Bytes that one numpy pass holds at most, unless a single text is longer.
BLOCK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _table(seed: int) -> np.ndarray:
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * seed)) * _STEP)


_TABLES = [_table(0), _table(1)]
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(int(base))
    if have is None or len(have) < n:
        size = max(n, BLOCK + 1)
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        if size > 8 * BLOCK:
            return out
        _POWERS[int(base)] = have = out
    return have[:n]


def prefix_hash(data: np.ndarray, table: int = 0) -> np.ndarray:
    """Sums ``p`` such that ``span_hash(p, s, e)`` depends on the bytes of ``data[s:e]`` only."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_TABLES[table][data] * _powers(_BASE, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans, length included."""
    body = (prefix[end] - prefix[start]) * _powers(_INVERSE, len(prefix))[start]
    return mix(body + (end - start).astype(np.uint64) * _STEP)


def window_hash(prefix: np.ndarray, size: int) -> np.ndarray:
    """``span_hash`` of every span of one size."""
    body = (prefix[size:] - prefix[:-size]) * _powers(_INVERSE, len(prefix))[: len(prefix) - size]
    body += np.uint64(size * int(_STEP) % (1 << 64))
    return mix(body)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n, at = len(column), column.offset
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[at : at + n + 1] if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(data: np.ndarray, offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0), each of about ``limit`` bytes or of one text."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and where each text's words begin; no word crosses texts."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~is_space(data)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


#: Places of a word whose byte values are looked up; those of further bytes are computed.
_LOOKED_UP = 256
_PLACES: dict[int, np.ndarray] = {}


def _place_values(place: np.ndarray, byte: np.ndarray, table: int) -> np.ndarray:
    """A pseudo-random number for each place and byte."""
    return mix(((place.astype(np.uint64) << np.uint64(8)) | byte) * _STEP + np.uint64(0x51ED27 * (table + 1)))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: int = 0) -> np.ndarray:
    """Hashes of the words, made piece by piece so that a long text needs no long tables.

    A word's hash is the sum of a random number for each of its places and bytes, so no
    rule in the bytes of two words can make their hashes equal.
    """
    if table not in _PLACES:
        place, byte = np.divmod(np.arange(_LOOKED_UP << 8), 256)
        _PLACES[table] = _place_values(place, byte.astype(np.uint8), table)
    values_of = _PLACES[table]
    out = np.empty(len(starts), dtype=np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + BLOCK, side="right")))
        size = ends[lo:hi] - starts[lo:hi]
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        byte = data[place + np.repeat(starts[lo:hi], size)]
        values = values_of[(np.minimum(place, _LOOKED_UP - 1) << 8) | byte]
        if size.max() > _LOOKED_UP:
            far = np.flatnonzero(place >= _LOOKED_UP)
            values[far] = _place_values(place[far], byte[far], table)
        out[lo:hi] = mix(np.add.reduceat(values, first) + size.astype(np.uint64) * _STEP)
        lo = hi
    return out


def gram_hashes(items: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive items that stay inside one text, and the index of each first item."""
    count = len(items) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = items[:count].copy()
    for k in range(1, n):
        value = value * _BASE + items[k : k + count]
    fits = np.ones(count, dtype=bool)
    for b in range(1, n):  # a start closer than n to the end of its text doesn't fit
        stop = bounds[1:] - b
        stop = stop[(stop >= bounds[:-1]) & (stop < count)]
        fits[stop] = False
    at = np.flatnonzero(fits)
    return mix(value[at] + np.uint64(n * int(_STEP) % (1 << 64))), at
