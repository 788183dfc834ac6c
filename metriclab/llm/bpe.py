"""Byte-level BPE encoding and decoding: speculate, verify, and merge only what fails.

A word's tokens are first proposed by greedy longest match.  A proposal is the BPE
encoding exactly when every adjacent pair of its tokens would stay apart if the two
were encoded together, so all pairs of all new words are tested at once in numpy.
Only words with a failing pair are merged step by step.

The tables come from a tokenizer file that the caller names; each Python worker
reads it once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .bytesets import blocks, utf8

#: Fixed value: the published pattern that cuts a text into words for byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words kept from batch to batch in a worker, and words held at once of a long text.
CACHE_WORDS, HELD_WORDS = 1_000_000, 500_000
_SHIFT = np.int64(20)


def _byte_alphabet() -> dict[str, int]:
    """Character that stands for each byte in the file: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBPE:
    """Tables of one tokenizer and the encoder over them."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, alphabet = spec["model"], _byte_alphabet()
        vocab: dict[str, int] = model["vocab"]
        raw = lambda token: bytes(alphabet[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        n = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * n
        for token, i in vocab.items():
            self.bytes_of[i] = raw(token)
        for text, i in self.special.items():
            self.bytes_of[i] = text.encode()
        self.rank, self.left, self.right = (np.full(n, -1, dtype=np.int64) for _ in range(3))
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.whole_of: list[int] = []
        for r, (a, b) in enumerate(m.split(" ") if isinstance(m, str) else m for m in model["merges"]):
            a, b, whole = vocab[a], vocab[b], vocab[a + b]
            if self.rank[whole] >= 0:
                raise ValueError(f"token {whole} is made by two merges")
            self.pair_rank[a, b] = r
            self.whole_of.append(whole)
            self.rank[whole], self.left[whole], self.right[whole] = r, a, b
        keys = np.array([(a << int(_SHIFT)) | b for a, b in self.pair_rank], dtype=np.int64)
        order = np.argsort(keys)
        self._keys, self._ranks = keys[order], order.astype(np.int64)
        self.id_of = {self.bytes_of[i]: i for i in vocab.values()}
        self.byte_ids = [self.id_of[bytes([b])] for b in range(256)]
        self.longest: dict[bytes, int] = {}
        for token in self.id_of:
            self.longest[token[:3]] = max(len(token), self.longest.get(token[:3], 0))
        self.words = regex.compile(PATTERN)
        self._stop = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self._cache: dict[str, bytes] = {}
        self.merged_words = 0

    def proposed(self, word: bytes) -> list[int]:
        """Greedy longest match from the left."""
        if (whole := self.id_of.get(word)) is not None:
            return [whole]
        out, at, get, longest = [], 0, self.id_of.get, self.longest.get
        while at < len(word):
            # no token is longer than the longest that begins with the same three bytes
            for size in range(min(longest(word[at : at + 3], 2), len(word) - at), 0, -1):
                if (found := get(word[at : at + size])) is not None:
                    out.append(found)
                    at += size
                    break
        return out

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of tokens stay apart when their bytes are encoded together.

        Merging is followed backwards along the seam.  ``x`` is the last part of
        ``a`` and ``y`` the first part of ``b`` at some moment; the later made of the
        two is taken apart next.  If ``x`` and ``y`` could merge before either was
        used up, the tokens would not have come about.
        """
        ok = np.ones(len(a), dtype=bool)
        live, x, y = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        until = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            keys = (x << _SHIFT) | y
            at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
            joins = (self._keys[at] == keys) & (self._ranks[at] < until)
            ok[live[joins]] = False
            rx, ry = self.rank[x], self.rank[y]
            back_x = rx > ry
            go = ~joins & ((rx >= 0) | (ry >= 0))
            # of equal merges the left one comes first: x's own merge goes before the seam's, y's after it
            until = np.where(back_x, rx, ry + 1)[go]
            x, y = np.where(back_x, self.right[x], x)[go], np.where(back_x, y, self.left[y])[go]
            live = live[go]
        return ok

    def merged(self, word: bytes) -> list[int]:
        """The encoding by its definition: the lowest pair merges first, the leftmost among equals."""
        ids = [self.byte_ids[b] for b in word]
        return self._merged_long(ids) if len(ids) > 32 else self._merged_short(ids)

    def _merged_short(self, ids: list[int]) -> list[int]:
        get, none = self.pair_rank.get, len(self.whole_of)
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks and (low := min(ranks)) < none:
            i = ranks.index(low)
            ids[i : i + 2] = [self.whole_of[low]]
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        """The same with a heap and linked neighbours, for words of any length."""
        n, get = len(ids), self.pair_rank.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = self.whole_of[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (r, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (r := get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (r, h, ids[h], ids[i]))
        return [i for i in ids if i >= 0]

    def _learn(self, new: list[str]) -> None:
        """Encode words and keep them as little-endian 32-bit ids."""
        raw = [w.encode() for w in new]
        tokens = [self.proposed(w) for w in raw]
        flat = np.fromiter(chain.from_iterable(tokens), dtype=np.int64)
        ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)))
        inner = np.ones(max(len(flat) - 1, 0), dtype=bool)
        inner[ends[:-1] - 1] = False
        at = np.flatnonzero(inner)
        failing = at[~self.apart(flat[at], flat[at + 1])]
        for w in np.unique(np.searchsorted(ends, failing, side="right")).tolist():
            tokens[w] = self.merged(raw[w])
            self.merged_words += 1
        for w, t in zip(new, tokens):
            self._cache[w] = np.array(t, dtype="<u4").tobytes()

    def _encoded(self, words: list[str]) -> bytes:
        known = self._cache
        if new := [w for w in set(words) if w not in known]:
            if len(known) > CACHE_WORDS:
                known.clear()
                new = list(set(words))
            self._learn(new)
        return b"".join(map(known.__getitem__, words))

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit integers.  Special strings in it are their tokens."""
        out, at = [], 0
        stops = [*self._stop.finditer(text)] if self._stop else []
        for start, end, name in [*((m.start(), m.end(), m[0]) for m in stops), (len(text), len(text), None)]:
            piece = text[at:start]
            if len(piece) < HELD_WORDS:
                out.append(self._encoded(self.words.findall(piece)))
            else:
                found = (m[0] for m in self.words.finditer(piece))
                while part := list(islice(found, HELD_WORDS)):
                    out.append(self._encoded(part))
            if name is not None:
                out.append(self.special[name].to_bytes(4, "little"))
            at = end
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Text of ids, special tokens included; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def loaded(path: str) -> ByteBPE:
    return ByteBPE(path)


def encoded(docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``docs`` with the column ``ids``: its text's tokens as little-endian 32-bit integers (binary).

    A null or empty text has no tokens.  Texts are encoded whole; a long one is held
    in parts of ``HELD_WORDS`` words.  Repeated rows are encoded each.  A column of
    ``docs`` named like the result is replaced.  ``path`` must exist on every executor.
    """
    docs = docs.drop(ids)
    own, schema = docs.columns, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{ids}` binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            data, offsets = utf8(batch.column(own.index(text)))
            for lo, hi, part, at in blocks(data, offsets):
                raw = part.tobytes()
                found = [bpe.encode(raw[a:b].decode("utf-8", "replace")) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, pa.array(found, pa.binary())], names=[*own, ids])

    return docs.mapInArrow(run, schema)


def decoded(rows: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the column ``text`` decoded from ``ids``; null ids give an empty text."""
    rows = rows.drop(text)
    own, schema = rows.columns, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), f"`{text}` string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                some = batch.slice(lo, 500)
                found = [bpe.decode(i or b"") for i in some.column(own.index(ids)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(found, pa.string())], names=[*own, text])

    return rows.mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row, encoded and decoded again in one pass."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi, part, at in blocks(data, offsets):
                raw, rows = part.tobytes(), []
                for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                    ids = bpe.encode(raw[a:b].decode("utf-8", "replace"))
                    rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids).encode()).hexdigest()))
                columns = [pa.array(c) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *columns], names=[key, "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
