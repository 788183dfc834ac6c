"""Runs of words against a plain search over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from metriclab.llm import periodic, registry


def runs(ws, least=12):
    """Every maximal stretch whose smallest period is q, tried for every q."""
    out, n = [], len(ws)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            k = i
            while k + q < n and ws[k] == ws[k + q]:
                k += 1
            if k + q - i >= max(least, 2 * q) and not any(all(ws[x] == ws[x + p] for x in range(i, k + q - p)) for p in range(1, q)):
                out.append((i, k + q - i, q))
            i = k
    return sorted(out, key=lambda r: (r[0], r[2]))


def tailed(key, text):
    ws = brute.WORD.findall(text or "")
    if key is None or zlib.crc32(str(key).encode()) % 10 or not ws:
        return ws
    g, n = zlib.crc32(str(key).encode()) // 10, len(ws)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]


def digests(key, text):
    ws = tailed(key, text)
    found = runs(ws)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (key, len(found), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_of_all_small_texts():
    rnd = random.Random(5)
    texts = [np.zeros(0, np.int32)]
    for size in range(1, 60):
        for letters in (1, 2, 3):
            part = [rnd.randrange(letters) for _ in range(rnd.randint(1, size))]
            texts.append(np.array((part * size)[:size], dtype=np.int32))
            texts.append(np.array([rnd.randrange(letters) for _ in range(size)], dtype=np.int32))
            texts.append(np.array((([rnd.randrange(9) for _ in range(7)] + part * 3 + [8]) * 2)[: 2 * size], dtype=np.int32))
    for least in (8, 12, 17):
        found = periodic.runs_of(texts, 9, least)
        for i, t in enumerate(texts):
            assert [tuple(map(int, r)) for r in found.get(i, ())] == runs(t.tolist(), least), (least, t.tolist())


def test_pairs_are_extended_in_parts(monkeypatch):
    monkeypatch.setattr(periodic, "PAIRS", 3)
    texts = [np.array([1, 2, 3] * 40 + [4] * 30, dtype=np.int32), np.array([5] * 200, dtype=np.int32)]
    found = periodic.runs_of(texts, 6, 12)
    assert [[tuple(map(int, r)) for r in found[i]] for i in (0, 1)] == [[(0, 120, 3), (120, 30, 1)], [(0, 200, 1)]]


@pytest.fixture(scope="module")
def texts(docs, spark):
    rnd = random.Random(3)
    own = [(1000 + i, " ".join(rnd.choice("ab") if i % 2 else "one two  three four\n" * rnd.randint(1, 5) for _ in range(rnd.randint(1, 40)))) for i in range(80)]
    own += [(2000, "w " * 5000), (2001, None), (None, "a b " * 20), (2000, "w " * 5000), (2002, " x y\x0bz " * 9)]
    return docs.select("doc_id", "text", F.lit(1).alias("runs"), F.lit("x").alias("start")).unionByName(spark.createDataFrame(own, "doc_id long, text string").withColumns({"runs": F.lit(2), "start": F.lit("y")}))


def test_digests_equal_the_plain_search(texts):
    got = periodic.run_digests(periodic.with_runs(periodic.with_tails(texts)))
    want = [digests(r["doc_id"], r["text"]) if len(brute.WORD.findall(r["text"] or "")) < 4000 else None for r in texts.collect()]
    rows = [tuple(r) for r in got.collect()]
    short = [r for r in rows if not (r[0] in (2000, 81))]
    assert sorted(map(repr, short)) == sorted(repr(w) for w in want if w and w[0] not in (2000, 81))
    assert sum(r[0] == 2000 and r[1:6] == (1, 0, 5000, 1, 5_000_000) for r in rows) == 2
    whole = periodic.with_runs(texts)
    assert whole.columns == ["doc_id", "start", "runs", "collapsed"] and whole.count() == texts.count()
    assert whole.limit(0).count() == 0 and periodic.with_runs(texts.limit(0)).count() == 0


def test_registered_query_equals_the_plain_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in registry.QUERIES["op13_periodic_runs"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for r in docs:
        if len((r["text"] or "").split()) < 600:
            assert got[r["doc_id"]] == digests(r["doc_id"], r["text"])
    assert sum(v[1] > 0 for v in got.values()) > 5
