"""Words that are built so that sums of powers collide, and sets told by words."""

from __future__ import annotations

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from metriclab.llm import bytesets, jaccard, quality


def thue_morse(n: int) -> tuple[str, str]:
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


@pytest.mark.parametrize("n", [2, 255, 256, 257, 512, 1024, 4096])
def test_words_of_alternating_letters_differ(n):
    texts = [t.encode() for t in thue_morse(n)]
    data, offsets = np.frombuffer(b" ".join(texts), dtype=np.uint8), np.array([0, 2 * n + 1])
    starts, ends, _ = bytesets.words(data, offsets)
    for table in (0, 1):
        a, b = bytesets.word_hashes(data, starts, ends, table)
        assert a != b
        assert bytesets.word_hashes(data[n + 1 :], np.array([0]), np.array([n]), table)[0] == b


@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_such_texts_neither_link_nor_repeat(spark, n):
    a, b = thue_morse(n)
    docs = spark.createDataFrame([(5, a), (3, b), (8, f"x y {a} x y {b} x y c")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard.with_components(docs).collect())) == [(3, 1, 3), (5, 1, 5), (8, 6, 8)]
    found = {r["doc_id"]: r["n_repeat_words"] for r in quality.with_quality(docs).collect()}
    assert found == {3: 0, 5: 0, 8: 0}


@pytest.mark.parametrize("size", [1, 2, 4, 5])
def test_exact_sets_agree_with_plain_ones(size):
    rnd = random.Random(size)
    texts = [" ".join(rnd.choice(["a", "B", "b", "cc", "D"]) for _ in range(rnd.randint(0, 30))) for _ in range(40)]
    plain, found = [brute.shingles(t, size) for t in texts], jaccard.exact_sets([t.encode() for t in texts], size)
    assert [len(x) for x in found] == [len(x) for x in plain]
    for i in range(40):
        for j in range(i):
            assert len(np.intersect1d(found[i], found[j])) == len(plain[i] & plain[j])


def test_a_list_of_one_group_is_dealt_in_cells(spark):
    rules = jaccard.JaccardJoin(cell=8)
    head = " ".join(f"h{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{head} t{i}") for i in range(60)], "doc_id long, text string")
    assert jaccard.with_components(docs, rules=rules).filter("component_id = 0").count() == 60
    found = jaccard.sets_table(docs, "doc_id", "text", rules)
    nodes = found.groupBy("set").agg(F.first("gid").alias("gid"), F.first("n").alias("n"))
    sizes = [r["count"] for r in jaccard._cells(found, nodes, rules).groupBy("list", "cell").count().collect()]
    assert max(sizes) <= 24
