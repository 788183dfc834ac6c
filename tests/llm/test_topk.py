"""Top lists against a plain search."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from metriclab.llm import topk


def plain(rows, k, every):
    real = [(key, [math.floor(256 * x) if abs(x) < 1e300 else int(x) * 256 for x in v]) for key, v in rows if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    hold = lambda s: max(-(2**63) + 1, min(2**63 - 1, s))
    out = []
    for i, (q, a) in enumerate(real):
        if q % every == 0:
            some = sorted((-hold(sum(x * y for x, y in zip(a, b))), key) for j, (key, b) in enumerate(real) if j != i and len(a) == len(b))
            out += [(q, r + 1, key, -s) for r, (s, key) in enumerate(some[:k])]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    out = [(int(i), [float(np.float32(x)) for x in rng.normal(size=6)]) for i in rng.permutation(300)]
    out += [(300 + i, out[0][1]) for i in range(20)] + [out[1], (0, [1.0] * 6), (0, [1.0] * 6)]
    out += [(400, None), (401, []), (450, []), (402, [float("nan")] * 6), (500, [None] + [1.0] * 5), (None, [1.0] * 6), (550, [0.0] * 6), (600, [1.0] * 3), (601, [-2.0] * 3), (650, [float("inf")] * 6)]
    out += [(700, [200.0, -300.5] * 3), (701, [1e6] * 6), (750, [1e9, -1e9] * 3), (751, [3e15, 1.0] * 3), (800, [1e306] * 6), (801, [-1e300] + [0.1] * 5), (850, [1e12] * 4), (851, [1e12] * 4), (900, [7.25, -9e17] * 1)]
    return out


def test_top_lists(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"shard": F.lit("x"), "score": F.lit(1)}).repartition(3)
    asked = F.col("vec_id") % 50 == 0
    for rules in (topk.Search(), topk.Search(k=3, shard_rows=7, tile_rows=2, lane_shards=2, lane_tiles=2, fan_in=2), topk.Search(k=1, shard_rows=50, tile_rows=5)):
        got = sorted(map(tuple, topk.top_k(df, asked, rules=rules).collect()))
        assert got == plain(rows, rules.k, 50), rules
    assert topk.top_k(df, asked).dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    asked = F.col("vec_id") % 50 == 0
    assert list(map(tuple, topk.top_k(df, asked).collect())) == [(0, 1, 1, 256 * 512)]
    assert topk.top_k(df.filter("vec_id = 0"), asked).collect() == [] and topk.top_k(df.filter("vec_id = 1"), asked).collect() == []
    assert topk.top_k(df.limit(0), asked).collect() == []
