"""What the vector join leaves on the disk, and its blocks."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import functions as F

from metriclab.llm import vectors


def shuffled(spark) -> int:
    context = spark.sparkContext._jsc.sc()
    context.listenerBus().waitUntilEmpty(30_000)
    found = context.statusStore().executorList(False)
    return sum(found.apply(i).totalShuffleWrite() for i in range(found.size()))


def written_bytes(spark) -> int:
    top = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(top) for f in names)


def test_vectors_are_dealt_and_written_once_whatever_cells_they_visit(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(1500, 64)))] + [(5000 + i, [1.0] * 64) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    rules = vectors.RangeJoin(cell_rows=50, block_rows=25)  # 31 cells, each visited by nearly all vectors above it
    before = shuffled(spark), written_bytes(spark)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.with_components(df, rules=rules).collect()}
    assert got == {i: (0, i) if i < 5000 else (499, 5000) for i, _ in rows}
    size = 2000 * 64 * 8
    assert shuffled(spark) - before[0] < 3 * size and written_bytes(spark) - before[1] < 2 * size


def test_blocks_hold_each_vector_once_and_all_pairs_meet_once(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(8, 6))
    plain = np.concatenate([base[i % 8] + 0.2 * rng.normal(size=6) for i in range(300)]).reshape(300, 6).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(plain)], "vec_id long, embedding array<float>")
    units = plain.astype(float) / np.linalg.norm(plain.astype(float), axis=1)[:, None]
    want = (units @ units.T >= 0.9).sum(axis=1) - 1
    for rules in (vectors.RangeJoin(cell_rows=10, block_rows=4), vectors.RangeJoin(cell_rows=1000), vectors.RangeJoin(pivots=2, block_rows=7)):
        assert {r["vec_id"]: r["n_links"] for r in vectors.with_components(df.unionAll(df.limit(0)).repartition(3), rules=rules).collect()} == dict(enumerate(want.tolist()))
    known = vectors.classes(df, "vec_id", "embedding").filter("cls is not null").select("cls", "vec", "dim")
    rules = vectors.RangeJoin(block_rows=4, numbers=vectors.number_kind(df, "embedding"))
    pivots = known.limit(5).collect()
    blocks = vectors._blocks(vectors._visits(known.unionAll(known), pivots, rules), 3, rules)
    sizes = blocks.select(F.length("cls").alias("c"), F.length("vec").alias("v"), F.length("copies").alias("n")).collect()
    assert sum(r["c"] for r in sizes) == 16 * 300 and all((r["v"], r["n"]) == (r["c"] // 16 * 24, r["c"] // 2) and r["c"] <= 64 for r in sizes)
