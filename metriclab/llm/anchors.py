"""Anchors: where texts must be looked at to find strings that occur twice.

Of all positions in a string of ``length`` bytes, the leftmost with the smallest hash
of the ``gram`` bytes behind it is the string's anchor.  Equal strings have equal
anchors at equal places, so all occurrences of a string meet under its anchor's hash,
and a hash that occurs once needs no further look.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np

from .bytesets import mix, prefix_hash, window_hash

#: Bytes of a text that are looked at together; longer texts are cut with overlap.
PART = 1 << 20
_BITS = np.uint64(22)
_PLACE = np.uint64((1 << 22) - 1)


@dataclass(frozen=True)
class Anchors:
    length: int = 400
    gram: int = 200

    def parts(self, sizes: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, start, end) of the stretches to look at; each string lies in exactly one."""
        out = []
        for row in np.flatnonzero(sizes >= self.length).tolist():
            n = int(sizes[row])
            for start in range(0, n - self.length + 1, PART):
                out.append((row, start, min(n, start + PART + self.length - 1)))
        return out

    def found(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Anchors of the parts that ``ends`` cuts ``data`` into: hash, place, start and end of the context, digest of the context.

        The context of an anchor holds every string of the part that has it.
        """
        k, width, n = self.gram, self.length - self.gram + 1, len(data)
        none = np.zeros(0, np.int64)
        if n < self.length:
            return none.view(np.uint64), none, none, none, none.view(np.uint64)
        prefix = prefix_hash(data)
        count = n - k + 1
        hashes = window_hash(prefix, k)
        ranked = hashes & ~_PLACE
        ranked |= np.arange(count, dtype=np.uint64)
        padded = np.full(-(-count // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
        padded[:count] = ranked
        table = padded.reshape(-1, width)
        ahead = np.minimum.accumulate(table, axis=1).ravel()
        behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = count - width + 1
        least = np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows])
        ends = np.asarray(ends, dtype=np.int64)
        limit = np.repeat(ends, np.diff(ends, prepend=0))
        inside = np.arange(windows) + self.length <= limit[:windows]
        chosen = least[inside] & _PLACE
        place = chosen[np.flatnonzero(np.diff(chosen.astype(np.int64), prepend=-1))].astype(np.int64)
        begin = np.concatenate([[0], ends[:-1]])[np.searchsorted(ends, place, side="right")]
        lo = np.maximum(place - (self.length - k), begin)
        hi = np.minimum(place + self.length, limit[place])
        raw, digest = memoryview(data), hashlib.blake2b
        digests = b"".join([digest(raw[a:b], digest_size=8).digest() for a, b in zip(lo.tolist(), hi.tolist())])
        context = np.frombuffer(digests, dtype=np.uint64) ^ mix((place - lo).astype(np.uint64) + np.uint64(5))
        return hashes[place], place, lo, hi, context
