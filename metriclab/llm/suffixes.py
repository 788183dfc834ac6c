"""Suffix sorting by induction, with queues that go to disk.

A suffix that is greater than its right neighbour (type L) gets its place from that
neighbour's, and so does a smaller one (type S) in a scan from the other end; only the
leftmost S suffixes need sorting of their own.  Both scans are a priority queue over
first symbols: symbols leave in order, and within one the suffixes leave in the order
in which they came.  Whole runs of a symbol are handled at once in numpy.

The text is an array in memory, as is the order, and a queue holds at most ``held`` suffixes in
memory; the rest waits in a file of the task's own, deleted when the sort ends.
"""

from __future__ import annotations

import tempfile

import numpy as np

from .bytesets import prefix_hash, span_hash

#: Symbols of a shard: end of the text, end of a body, and bytes from here on.
END, STOP, FIRST = 0, 1, 2
SYMBOLS = 258
#: Pairs of strings that are compared at once.
COMPARED = 1 << 14


class BucketQueue:
    """Suffixes by first symbol, first in first out for each, spilling to a file."""

    def __init__(self, symbols: int, held: int) -> None:
        self._blocks: list[list] = [[] for _ in range(symbols)]
        self._sizes = np.zeros(symbols, dtype=np.int64)
        self._limit, self._held, self._file, self.spilled = held, 0, None, 0

    def push(self, keys: np.ndarray, places: np.ndarray) -> None:
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, places = keys[order], places[order]
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            self._blocks[keys[lo]].append(places[lo:hi])
            self._sizes[keys[lo]] += hi - lo
        self._held += len(keys)
        while self._held > self._limit:
            self._spill(int(self._sizes.argmax()))

    def _spill(self, key: int) -> None:
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        for i, block in enumerate(self._blocks[key]):
            if isinstance(block, np.ndarray):
                at = self._file.seek(0, 2)
                self._file.write(block.tobytes())
                self._blocks[key][i] = (at, len(block), block.dtype)
                self.spilled += len(block)
        self._held -= int(self._sizes[key])
        self._sizes[key] = 0

    def pop(self, key: int) -> np.ndarray:
        """All suffixes of a symbol that have come since it was last asked for."""
        out = []
        for block in self._blocks[key]:
            if not isinstance(block, np.ndarray):
                at, n, kind = block
                self._file.seek(at)
                block = np.frombuffer(self._file.read(n * kind.itemsize), dtype=kind)
            out.append(block)
        self._held -= int(self._sizes[key])
        self._sizes[key] = 0
        self._blocks[key] = []
        return np.concatenate(out) if len(out) > 1 else out[0] if out else np.zeros(0, np.int32)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()


def types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their right neighbours; the end symbol's is."""
    n = len(text)
    # the end symbol differs from its neighbour, so every place has a next one that differs
    differs = np.flatnonzero(text[1:] != text[:-1])
    small = np.ones(n, dtype=bool)
    small[:-1] = np.repeat(text[differs] < text[differs + 1], np.diff(differs, prepend=-1))
    return small


def _induced(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, held: int) -> np.ndarray:
    """All suffixes in order, from the leftmost S suffixes in order."""
    queue = BucketQueue(SYMBOLS, held)
    first = np.searchsorted(text[seeds], np.arange(SYMBOLS + 1))
    large: list[np.ndarray] = []

    def before(places: np.ndarray, kind: bool) -> None:
        left = places[places > 0] - 1
        left = left[small[left] == kind]
        queue.push(text[left], left)

    for symbol in range(SYMBOLS):
        waves = []
        while len(wave := queue.pop(symbol)):
            waves.append(wave)
            before(wave, False)
        large.append(np.concatenate(waves) if waves else np.zeros(0, np.int32))
        before(seeds[first[symbol] : first[symbol + 1]], False)
    out = []
    for symbol in range(SYMBOLS - 1, -1, -1):
        if symbol == END:
            out.append(np.array([len(text) - 1], dtype=np.int32))
            break
        waves = []
        while len(wave := queue.pop(symbol)):
            waves.append(wave)
            before(wave, True)
        if waves:
            out.append(np.concatenate(waves))
        out.append(large[symbol][::-1])
        before(large[symbol][::-1], True)
    queue.close()
    return np.concatenate(out)[::-1]


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes a and b, up to ``most``, symbol by symbol in blocks of eight."""
    out = np.zeros(len(a), dtype=np.int64)
    live = np.flatnonzero(most > 0)
    step = np.arange(8)
    last = len(text) - 1
    while len(live):
        at = out[live]
        x = text[np.minimum((a[live] + at)[:, None] + step, last)]
        y = text[np.minimum((b[live] + at)[:, None] + step, last)]
        same = x == y
        run = np.where(same.all(axis=1), 8, same.argmin(axis=1))
        out[live] = np.minimum(at + run, most[live])
        live = live[(run == 8) & (out[live] < most[live])]
    return out


def suffix_order(text: np.ndarray, depth: int, held: int = 1 << 24) -> np.ndarray:
    """Suffixes of ``text`` in order of their first ``depth`` symbols or more.

    ``text`` ends with the only END.  The leftmost S suffixes are sorted in three steps:
    one induction sorts the stretches from each to the next, equal stretches share a
    name, and names are sorted by doubling until they tell apart what ``depth`` symbols can.
    """
    small = types(text)
    marks = np.flatnonzero(small[1:] & ~small[:-1]).astype(np.int32) + 1
    by_symbol = marks[np.argsort(text[marks], kind="stable")]
    order = _induced(text, small, by_symbol, held)
    is_mark = np.zeros(len(text), dtype=bool)
    is_mark[marks] = True
    order = order[is_mark[order]]
    number = np.empty(len(text), dtype=np.int32)
    number[marks] = np.arange(len(marks))
    which = number[order]
    size = np.diff(marks, append=len(text)) + 1
    size[-1] = 1
    equal = np.zeros(len(order), dtype=bool)
    pairs = np.flatnonzero(size[which[1:]] == size[which[:-1]]) + 1
    most = size[which[pairs]].astype(np.int64)
    equal[pairs] = common_prefix(text, order[pairs - 1].astype(np.int64), order[pairs].astype(np.int64), most) >= most
    rank = np.empty(len(marks), dtype=np.int64)
    rank[which] = np.cumsum(~equal) - 1
    step, names = 1, int(rank.max()) + 1
    while names < len(marks) and 2 * step < depth:  # a stretch has two symbols or more
        ahead = np.zeros(len(marks), dtype=np.int64)
        ahead[:-step] = rank[step:] + 1
        key = rank * (names + 1) + ahead
        which = np.argsort(key)
        new = np.cumsum(np.concatenate([[0], key[which[1:]] != key[which[:-1]]]))
        rank[which] = new
        names, step = int(new[-1]) + 1, 2 * step
    seeds = marks[np.argsort(rank)]
    return _induced(text, small, seeds, held)


def shard_text(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the bodies put together, and where each body begins."""
    sizes = np.array([len(b) for b in bodies], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    text = np.full(int(starts[-1]) + 1, STOP, dtype=np.int16)
    inside = np.ones(int(starts[-1]), dtype=bool)
    inside[starts[1:] - 1] = False
    text[:-1][inside] = np.frombuffer(b"".join(bodies), dtype=np.uint8).astype(np.int16) + FIRST
    text[-1] = END
    return text, starts[:-1]


def repeated_starts(bodies: list[bytes], owners: np.ndarray, offsets: np.ndarray, length: int, held: int = 1 << 24) -> list[np.ndarray]:
    """For each body the starts of strings of ``length`` bytes that also occur elsewhere.

    Body k is the text of ``owners[k]`` from ``offsets[k]`` on; what two bodies hold of
    the same place of one owner is the same occurrence.
    """
    text, starts = shard_text(bodies)
    sizes = np.array([len(b) for b in bodies], dtype=np.int64)
    order = suffix_order(text, length, held).astype(np.int64)
    body = np.searchsorted(starts, order, side="right") - 1
    within = order - starts[body]
    fits = within + length <= sizes[body]
    order, body, within = order[fits], body[fits], within[fits]
    if len(order) < 2:
        return [np.zeros(0, np.int64)] * len(bodies)
    # neighbours that agree in a hash of this length are compared byte by byte
    raw = np.frombuffer(b"\0".join(bodies), dtype=np.uint8)
    hashes = span_hash(prefix_hash(raw), order, order + length)
    shared = hashes[1:] == hashes[:-1]
    strings = np.lib.stride_tricks.sliding_window_view(raw, length)
    alike = np.flatnonzero(shared)
    for lo in range(0, len(alike), COMPARED):
        some = alike[lo : lo + COMPARED]
        shared[some] = (strings[order[some]] == strings[order[some + 1]]).all(axis=1)
    opens = np.concatenate([[True], ~shared])
    run, first = np.cumsum(opens) - 1, np.flatnonzero(opens)
    owner, place = owners[body], offsets[body] + within
    other = (owner != owner[first][run]) | (place != place[first][run])
    real = np.bitwise_or.reduceat(other, first)[run]
    chosen, at = body[real], within[real]
    by = np.lexsort((at, chosen))
    chosen, at = chosen[by], at[by]
    cuts = np.searchsorted(chosen, np.arange(len(bodies) + 1))
    return [at[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
