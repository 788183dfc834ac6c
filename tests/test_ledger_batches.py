"""What the ledger adds up in Arrow batches, against plain values."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from metriclab.functions.sketches import Sketch, weighted_values
from metriclab.operators import candidates as C
from metriclab.operators import roles
from metriclab.plans import discovery, ledger


@pytest.mark.parametrize("n", [1, 9_999, 10_001, 500_000])
def test_a_sketch_misses_ranks_by_little(n):
    values = np.random.default_rng(n).permutation(n).astype(float)
    parts = []
    for half in np.array_split(values, 2):  # two tasks
        sketch = Sketch(points=1000, chunk=5000)
        for lo in range(0, len(half), 700):
            sketch.add(np.append(half[lo : lo + 700], np.nan))
        parts += sketch.parts()
    assert sum(len(v) * w for v, w in parts) == pytest.approx(n) and sum(len(v) for v, _ in parts) <= 2 * max(1000, 5700)
    shares = [0.01, 0.25, 0.5, 0.99]
    assert np.abs(weighted_values(parts, shares) - [np.ceil(p * n) - 1 for p in shares]).max() <= (3 * n / 1000 if n > 1000 else 0)


def test_keys_are_found_as_a_join_finds_them():
    for keys, column, want in (
        (pa.array([0.0, float("nan"), 2.5]), pa.array([-0.0, None, float("nan"), 2.5, 7.0]), [0, 3, 1, 2, 3]),
        (pa.array([5, 0, 2**60 + 1]), pa.array([0, None, 2**60 + 1, 2**60, 5]), [1, 3, 2, 3, 0]),
        (pa.array(["a", ""]), pa.array(["", None, "b", "a", "a"]), [1, 2, 2, 0, 0]),
    ):
        assert ledger._places(keys)(column).tolist() == want


def test_values_of_batches_are_those_of_columns(spark):
    rows = [(i, float(i % 7), None if i % 9 == 0 else float(i % 5), f"d{i % 4}" if i % 11 else None, None if i % 13 == 0 else i % 30, 1 + i % 3, 2000 + i % 3 if i % 10 else None, float(i % 13)) for i in range(900)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, d string, e int, f long, yr int, y double")
    ratio = C.Candidate("ratio", (("a",), ("b",)))
    found = [ratio, C.Candidate("plain", ("a",)), C.Candidate("mean", ("a", "d")), C.Candidate("mean", (ratio, "e")), C.Candidate("count", ("e",)), C.Candidate("count", ("f",))]
    made = ledger.Ledger(df, "y", "yr", ["a", "b", "d", "e", "f"])
    made.add(found[:2])
    made.add(found)
    table = made.table.toPandas().set_index("__row").sort_index()
    for s in made.found:
        f = made.facts[s]
        values = table[ledger.value(f.place)]
        assert f.filled_mean() == pytest.approx(values.mean()) and f.n == 900 and dict(f.yearly).keys() == {2000, 2001, 2002}
    assert made.products == pytest.approx(np.cov(table[[ledger.value(made.facts[s].place) for s in made.found]].to_numpy().T) * 899)
    packed = {r["__row"]: list(r["codes"]) for r in made.codes(made.rows, ["__row"]).collect()}
    want = table[[ledger.code(made.facts[s].place) for s in made.found]]
    assert packed == {i: r.tolist() for i, r in zip(want.index, want.to_numpy())}


def test_a_measuring_round_makes_no_row_for_a_value(spark, monkeypatch):
    df = spark.range(500).selectExpr("id AS row_id", "cast(id % 7 AS double) AS a", "id % 5 AS k", "2000 AS yr", "cast(id AS double) AS y")
    plans, real = [], type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, *a, **k: plans.append(self._jdf.queryExecution().optimizedPlan().toString()) or real(self, *a, **k))
    made = ledger.Ledger(df, "y", "yr", ["a", "k"])
    made.add([C.Candidate("plain", ("a",)), C.Candidate("mean", ("a", "k")), C.Candidate("count", ("k",))])
    assert len(plans) == 2 and not any("Generate explode" in p or "Join" in p for p in plans)


def test_extended_dims_are_those_of_both_tables(spark):
    df = spark.range(400).selectExpr("cast(id % 5 AS double) AS few", "cast(id AS double) AS many", "CASE WHEN id % 2 = 0 THEN 3 END AS half", "cast(NULL AS double) AS none", "cast(id % 90 AS double) AS rare", "id AS y")
    numbers = ["few", "many", "half", "none", "rare"]
    both = roles.cardinality(df, numbers).join(roles.repetition(df, numbers), "column_name").filter("distinct_ratio < 0.3 AND repeats")
    assert roles.extended_dims(df, roles.WorkingLists(), "y") == sorted(r["column_name"] for r in both.collect()) == ["few", "half"]
    assert discovery.numbered(df.withColumn("m", F.array("many"))).select("row_id").distinct().count() == 400
