"""Stretches of words that repeat with a period, and texts without those repeats.

Blocks of 1, 2, 4, ... words are named so that equal blocks of a text have equal names:
a block's name comes from the names of its two halves.  Two places are compared by going
down the levels, so how far they agree is known after a step per level.  Places to compare
lie on a grid for each period, dense enough that no run slips through; names are exact, so
no hashes and no suffix sorting are needed.  Each text is judged on its own, in one pass
over the table without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesets import blocks, is_space, utf8, words

#: Bytes of text that are named together, unless one text is longer.
TOGETHER = 1 << 21
#: Pairs of places that are extended together.
PAIRS = 1 << 20
#: Words of the blocks that grid places are compared by.
SEED = 4


def renamed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dense names of pairs of names."""
    both = left.astype(np.int64) * (int(right.max()) + 1) + right
    return np.unique(both, return_inverse=True)[1].astype(np.int32)


def doubled(names: np.ndarray, size: int) -> np.ndarray:
    """Names of blocks of twice ``size`` from those of ``size``."""
    return renamed(names[:-size], names[size:]) if len(names) > size else names[:0]


class Joined:
    """Texts behind one another, the longest first, each closed by an item that occurs nowhere else."""

    def __init__(self, texts: list[np.ndarray], different: int):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.order = np.argsort(-sizes, kind="stable")
        self.sizes = sizes[self.order]
        self.begins = np.concatenate([[0], np.cumsum(self.sizes + 1)])
        self.items = np.empty(self.begins[-1], dtype=np.int32)
        for k, i in enumerate(self.order):
            self.items[self.begins[k] : self.begins[k + 1] - 1] = texts[i]
        self.items[self.begins[1:] - 1] = different + np.arange(len(texts))
        two = doubled(self.items, 1)
        self.seeds = doubled(two, 2)

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, places, side="right") - 1

    def grid_hits(self, min_words: int) -> Iterator[tuple[int, np.ndarray]]:
        """(period, places) where a block of SEED words stands again a period later in the same text.

        A run of period q agrees with itself q words later for max(min_words - q, q) words at
        least, so blocks of SEED words at every (that - SEED + 1)th place miss none.
        """
        for q in range(1, int(self.sizes[0]) // 2 + 1):
            far = int(np.searchsorted(-self.sizes, -max(min_words, 2 * q), side="right"))
            step, stop = max(min_words - q, q) - SEED + 1, int(self.begins[far]) - q - SEED + 1
            hits = np.flatnonzero(self.seeds[0:stop:step] == self.seeds[q : q + stop : step]) * step
            if len(hits):
                hits = hits[self.text_of(hits) == self.text_of(hits + q)]
                if len(hits):
                    yield q, hits

    def levels(self) -> list[np.ndarray]:
        """Names of all blocks of 1, 2, 4, ... items, up to where all differ."""
        out = [self.items]
        size = 1
        while 2 * size <= int(self.sizes[0]):
            nxt = doubled(out[-1], size)
            if not len(nxt) or int(nxt.max()) + 1 == len(nxt):
                break
            out.append(nxt)
            size *= 2
        return out


def extended(levels: list[np.ndarray], at: np.ndarray, later: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many items agree before and from the two places on; that is less than two blocks of the highest level."""
    back, ahead = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        names, size = levels[k], 1 << k
        most = len(names) - 1
        i, j = at + ahead, later + ahead
        ahead += size * ((j <= most) & (names[np.minimum(i, most)] == names[np.minimum(j, most)]))
        i, j = at - back - size, later - back - size
        back += size * ((i >= 0) & (names[np.maximum(i, 0)] == names[np.clip(j, 0, most)]))
    return back, ahead


def runs_of(texts: list[np.ndarray], different: int, min_words: int) -> dict[int, np.ndarray]:
    """Runs of each text that has any, as rows of (start, length, period) by start, then period.

    ``texts`` hold numbers below ``different``.  A run of period q has ``min_words`` and 2q items
    or more; of periods that give the same stretch only the smallest counts.
    """
    some = [i for i, t in enumerate(texts) if len(t) >= min_words]
    if not some:
        return {}
    joined = Joined([texts[i] for i in some], different)
    found = np.zeros(len(some), dtype=bool)
    for _, places in joined.grid_hits(min_words):
        found[joined.text_of(places)] = True
    some = [some[k] for k in joined.order[found]]
    if not some:
        return {}
    joined = Joined([texts[i] for i in some], different)
    levels = joined.levels()
    kept = np.zeros((0, 3), dtype=np.int64)
    waiting: list[tuple[int, np.ndarray]] = []

    def settle() -> np.ndarray:
        if not waiting:
            return kept
        at = np.concatenate([p for _, p in waiting])
        q = np.concatenate([np.full(len(p), q, dtype=np.int64) for q, p in waiting])
        waiting.clear()
        back, ahead = extended(levels, at, at + q)
        size = back + ahead + q
        good = size >= np.maximum(min_words, 2 * q)
        rows = np.concatenate([kept, np.stack([at - back, size, q], axis=1)[good]])
        # periods come in order, so the first of equal stretches has the smallest
        return rows[np.sort(np.unique(rows[:, 0] * (len(joined.items) + 1) + rows[:, 1], return_index=True)[1])]

    held = 0
    for q, places in joined.grid_hits(min_words):
        waiting.append((q, places))
        held += len(places)
        if held >= PAIRS:
            kept, held = settle(), 0
    kept = settle()
    kept = kept[np.lexsort((kept[:, 2], kept[:, 0]))]
    of = joined.text_of(kept[:, 0])
    out = {}
    for k in np.unique(of):
        rows = kept[of == k].copy()
        rows[:, 0] -= joined.begins[k]
        out[some[joined.order[k]]] = rows
    return out


def word_numbers(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], int]:
    """The words of each text as numbers, equal for equal words, and how many numbers there are."""
    starts, ends, bounds = words(data, offsets)
    ends_at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    listed = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends_at), pa.py_buffer(np.ascontiguousarray(data[~is_space(data)]))])
    coded = listed.dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
    return [numbers[a:b] for a, b in zip(bounds[:-1], bounds[1:])], len(coded.dictionary)


def with_runs(docs: DataFrame, text: str = "text", min_words: int = 12) -> DataFrame:
    """The columns of ``docs`` but the text, with ``runs`` and ``collapsed``.

    ``runs`` lists (start, length, period) in words of every run of ``min_words`` (8 or more) and two
    periods at least, by start, then period.  ``collapsed`` has the words that no run contains
    after its first period, joined by one space.  A null, empty or blank text has no runs and
    collapses to nothing; texts of any length are read whole; repeated rows are judged each; an
    empty table gives an empty table.  Other columns that clash with the results are replaced.
    A text of n words takes memory for n numbers a level, log2(n) levels at most.
    """
    if min_words < 8:
        raise ValueError("min_words must be 8 or more")  # below, a run could agree with itself for fewer than SEED words
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("runs", "collapsed") or c == text])
    own = [c for c in docs.columns if c != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text), "runs array<struct<start: bigint, length: bigint, period: bigint>>", "collapsed string"])
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            for lo, hi, part, cut in blocks(data, offsets, TOGETHER):
                numbers, different = word_numbers(part, cut)
                found = runs_of(numbers, different, min_words)
                texts = []
                for i in range(hi - lo):
                    ws = part[cut[i] : cut[i + 1]].tobytes().split()
                    if i in found:
                        edge = np.zeros(len(ws) + 1, dtype=np.int64)
                        np.add.at(edge, found[i][:, 0] + found[i][:, 2], 1)
                        np.add.at(edge, found[i][:, 0] + found[i][:, 1], -1)
                        ws = compress(ws, (np.cumsum(edge)[:-1] == 0).tolist())
                    texts.append(b" ".join(ws))
                rows = np.concatenate([found[i] for i in range(hi - lo) if i in found] or [np.zeros((0, 3), np.int64)])
                ends = np.cumsum([0, *(len(found.get(i, ())) for i in range(hi - lo))]).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, k])) for k in range(3)], ["start", "length", "period"])
                listed = pa.ListArray.from_arrays(pa.array(ends), spans)
                kept = [c for k, c in enumerate(batch.slice(lo, hi - lo).columns) if k != at]
                yield pa.RecordBatch.from_arrays([*kept, listed, pa.array(texts, pa.binary()).cast(pa.string())], names=[*own, "runs", "collapsed"])

    return docs.mapInArrow(run, schema)


def with_tails(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text) where every tenth text by its key's checksum repeats a few of its words to its end.

    h is the checksum of the key in decimal, g its tenth.  From word g % n on, the words repeat
    with period 1 + floor((n - g % n) / (3 + g % 8)).  A text without a key stays as it is.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    listed = F.when(h % 10 == 0, F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    rows = docs.select(F.col(key), F.col(text), F.floor(h / 10).cast("long").alias("g"), listed.alias("w"))
    n = F.nullif(F.size("w"), F.lit(0))
    a = (F.col("g") % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.col("g") % 8))).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice("w", a + 1, p), F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    tailed = F.array_join(F.concat(F.slice("w", F.lit(1), a), again), " ")
    return rows.select(key, F.coalesce(tailed, F.col(text)).alias(text))


def run_digests(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_runs, the longest run's columns, runs_sha256, collapsed_sha256) from ``with_runs``."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    sha = F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256)
    rows = found.select(key, F.size("runs").cast("long").alias("n_runs"), best.alias("_best"), sha.alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    exponent = F.expr("(1000 * _best.length) div (-_best.period)").cast("long")
    return rows.select(key, "n_runs", (-F.col("_best.start")).alias("start"), F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"), exponent.alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
