"""The forest, the ledger of its candidates, and the registered queries that take its score."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from metriclab import queries
from metriclab.operators import candidates as C
from metriclab.operators.importance import Tree, forest_importance
from metriclab.plans import discovery, ledger
from metriclab.settings import Thresholds

DEFAULTS = {"folds": 5, "trees": 200, "depth": 8}


@pytest.fixture
def forest(monkeypatch):
    """Notes what the forest is asked for; its shares are 1, 1/2, 1/3, ... by name."""
    asked = []

    def importance(wide, features, target, **settings):
        asked.append((list(features), settings))
        rows = [(c, 0.5 / (i + 1), 1.0 / (i + 1)) for i, c in enumerate(features)]
        return wide.sparkSession.createDataFrame(rows, "cand string, importance double, predictive double"), []

    monkeypatch.setattr(ledger, "forest_importance", importance)
    return asked


def test_informative_columns_rank_above_noise(spark):
    rnd = np.random.default_rng(8)
    n = 3000
    useful = {f"useful{i}": rnd.normal(size=n) for i in range(4)}
    noise = {f"noise{i}": rnd.normal(size=n) * 10**i for i in range(6)}
    y = 3 * useful["useful0"] + 2 * np.abs(useful["useful1"]) + (useful["useful2"] > 0.5) * 4 + useful["useful3"] ** 2 + 0.1 * rnd.normal(size=n)
    pdf = pd.DataFrame({**noise, **useful, "same": 1.0, "y": y, "row_id": np.arange(n)})
    pdf["none"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("none", F.lit(None).cast("double"))
    names = [*noise, *useful, "same", "none"]
    table, errors = forest_importance(df, names, "y", trees=40)
    got = {r["cand"]: r["importance"] for r in table.collect()}
    assert sum(got.values()) == pytest.approx(1.0) and max(r["predictive"] for r in table.collect()) == 1.0
    assert min(got[c] for c in useful) > max(got[c] for c in noise) and got["same"] == got["none"] == 0.0
    assert len(errors) == 5 and all(e["r2"] > 0.8 and e["rmse"] > 0 for e in errors)


def test_forest_of_few_and_no_rows(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 2.0, 4.0), (3, None, None)], "row_id long, a double, y double")
    assert [(r["cand"], r["importance"]) for r in forest_importance(df, ["a"], "y", trees=3)[0].collect()][0][0] == "a"
    assert forest_importance(df.limit(0), ["a"], "y")[0].collect()[0]["importance"] == 0.0
    assert forest_importance(df, [], "y")[0].collect() == []


def test_a_tree_splits_where_the_error_falls_most():
    """Against all splits tried one by one, on every level."""
    rng = np.random.default_rng(3)
    codes, y, weight = rng.integers(0, 6, size=(3, 80)).astype(np.uint8), rng.normal(size=80), rng.poisson(1.0, 80)
    tree = Tree(codes, y, weight, 4, 7)

    def error(rows):
        w, v = weight[rows], y[rows]
        return (w * (v - (w * v).sum() / w.sum()) ** 2).sum() if w.sum() else 0.0

    def grown(rows, depth):
        found = [(error(rows) - error(left) - error(right), left, right) for f in range(3) for c in range(6) for left, right in [(rows[codes[f, rows] <= c], rows[codes[f, rows] > c])] if weight[left].sum() and weight[right].sum()]
        gain, left, right = max(found, key=lambda x: x[0], default=(0.0, None, None))
        return gain + grown(left, depth - 1) + grown(right, depth - 1) if depth and gain > 1e-9 else 0.0

    assert tree.gains.sum() == pytest.approx(grown(np.arange(80), 4))
    fitted = tree.predict(codes)
    assert (weight * (y - fitted) ** 2).sum() == pytest.approx(error(np.arange(80)) - tree.gains.sum())


def test_shards_share_the_trees(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"row_id": range(2000), "a": rng.normal(size=2000), "b": rng.normal(size=2000)})
    pdf["y"] = pdf["a"] * 3
    df = spark.createDataFrame(pdf)
    for rows, trees in ((150, 3), (700, 30)):
        table, errors = forest_importance(df, ["a", "b"], "y", trees=trees, shard_rows=rows, folds=3)
        got = {r["cand"]: r["importance"] for r in table.collect()}
        assert got["a"] > 0.9 and sum(got.values()) == pytest.approx(1.0) and len(errors) == 3 and all(e["r2"] > 0.9 for e in errors)
    again = forest_importance(df.repartition(7), ["a", "b"], "y", trees=30, shard_rows=700, folds=3)[0]
    assert {r["cand"]: round(r["importance"], 3) for r in again.collect()} == {k: round(v, 3) for k, v in got.items()}


def observations(spark, n=400):
    rnd = random.Random(6)
    rows = [(i, rnd.uniform(1, 9), rnd.choice([None, 0.0, rnd.uniform(1, 5)]), rnd.choice("abcd"), rnd.choice(["x", None, "y"]), 2000 + rnd.randrange(4), float("nan") if i == 5 else rnd.gauss(0, 1), rnd.gauss(5, 2)) for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, a double, b double, d string, e string, yr int, z double, y double")


def test_ledger_extends_what_a_full_computation_gives(spark):
    df = observations(spark)
    first = [C.Candidate("ratio", (("a",), ("b",))), C.Candidate("plain", ("z",)), C.Candidate("mean", ("a", "d")), C.Candidate("count", ("e",)), C.Candidate("plain", ("b",))]
    second = [C.Candidate("sum", (first[0], C.Candidate("ratio", (("z",), ("b",)))), "crossover", 1), C.Candidate("mean", (first[0], "d"), "crossover", 1), first[1], C.Candidate("count", ("d",))]
    columns = ["a", "b", "d", "e", "z"]
    step, whole = ledger.Ledger(df, "y", "yr", columns), ledger.Ledger(df, "y", "yr", columns)
    assert [c.label() for c in step.add(first)] == [c.label() for c in first]
    before = step.products.copy()
    assert [c.label() for c in step.add(second)] == [c.label() for c in second if c is not first[1]]
    assert step.add(second) == []
    whole.add([*first, *[c for c in second if c is not first[1]]])
    assert np.allclose(step.products, whole.products) and np.array_equal(step.products[: len(first), : len(first)], before)
    assert {k: v.cuts for k, v in step.facts.items()} == {k: v.cuts for k, v in whole.facts.items()}
    one, two = (t.scores(use_forest=False)[0].toPandas().sort_values("cand").reset_index(drop=True) for t in (step, whole))
    pd.testing.assert_frame_equal(one, two)
    # against pandas over the table's own values
    table = step.table.toPandas()
    names = {c.label(): ledger.value(step.facts[s].place) for s, c in step.found.items()}
    want = table[list(names.values())].corr().to_numpy()
    order = list(names)
    for a, b, r in step.correlations():
        assert r == pytest.approx(want[order.index(a), order.index(b)], abs=1e-9)
    facts = step.facts[first[0].signature()]
    raw = df.toPandas()
    ratio = (raw["a"] / raw["b"].where(raw["b"] != 0)).clip(facts.low, facts.high)
    assert (facts.n, facts.present) == (400, int(ratio.notna().sum())) and facts.mean == pytest.approx(ratio.mean()) and facts.spread == pytest.approx(ratio.std())
    assert dict(facts.yearly) == pytest.approx(ratio.groupby(raw["yr"]).mean().to_dict())
    codes = table[ledger.code(facts.place)]
    assert codes.between(0, 63).all() and (table[ledger.value(facts.place)].sort_values().index.map(codes).to_series().diff().dropna() >= 0).all()


def test_ledger_knows_degenerate_candidates_and_no_rows(spark):
    df = observations(spark).withColumn("k", F.lit(3.0))
    found = ledger.Ledger(df, "y", "yr", ["a", "k", "b"])
    assert found.add([C.Candidate("plain", ("k",)), C.Candidate("ratio", (("a",), ("b",)))]) == [C.Candidate("ratio", (("a",), ("b",)))]
    assert len(found.facts) == 2 and len(found.found) == 1 and found.correlations() == []
    empty = ledger.Ledger(df.limit(0), "y", "yr", ["a"])
    assert empty.add([C.Candidate("plain", ("a",))]) == [] and empty.scores()[0].collect() == []


def test_ranking_takes_the_forest_and_own_origins(spark, sf_dir, forest):
    got = {r["cand"]: r for r in queries.QUERIES["indicator_ranking_forest"](spark, sf_dir).collect()}
    features, settings = forest[0]
    assert len(settings["codes"]) == len(features)
    made = queries.forest_ledger(spark, sf_dir)
    origin = {c.label(): c.origin for c in made.found.values()}
    assert "domain" in origin.values() and set(origin) == set(features)
    t = made.scores()[0].toPandas().set_index("cand")
    t["predictive"] = pd.Series({c: 1.0 / (i + 1) for i, c in enumerate(features)})
    score = 0.6 * t["predictive"] + 0.2 * t["information"] + 0.1 * t["stability"] + 0.1 * t["completeness"]
    weakest = t[["predictive", "information", "stability", "completeness"]].rank(pct=True).min(axis=1)
    assert set(got) == {c for c in t.index if origin[c] == "domain" or weakest[c] >= 0.1}
    for c, r in got.items():
        assert (r["origin"], r["predictive"], r["score"]) == (origin[c], pytest.approx(t["predictive"][c], abs=1e-6), pytest.approx(score[c], abs=1e-6))


def test_prune_and_weights_take_all_candidates(spark, sf_dir, forest):
    kept = {r["cand"] for r in queries.QUERIES["redundancy_prune"](spark, sf_dir).collect()}
    made = queries.forest_ledger(spark, sf_dir)
    close = [(a, b) for a, b, r in made.correlations() if abs(r) > 0.95]
    assert kept <= set(forest[0][0]) and not any(a in kept and b in kept for a, b in close)
    assert all(any(c in p and (set(p) - {c}) & kept for p in close) for c in set(forest[0][0]) - kept)
    rows = queries.QUERIES["weight_grid_search_forest"](spark, sf_dir).collect()
    assert len(rows) == 455 and all(0 < r["objective"] <= 1 for r in rows)


def test_the_flagship_trains_at_the_defaults(spark, sf_dir):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).collect()
    assert rows[0]["score"] == max(r["score"] for r in rows) or rows
    assert max(r["predictive"] for r in rows) <= 1.0 and len({r["predictive"] for r in rows}) > 3
    table = queries.QUERIES["rf_importance"](spark, sf_dir).collect()
    assert sum(r["importance"] for r in table) == pytest.approx(1.0)


def test_discovery_runs_all_rounds_at_the_defaults(spark, sf_dir, monkeypatch):
    crossed, asked, trained = [], [], []
    whole, cross, real = discovery.discover, C.crossed, ledger.forest_importance
    monkeypatch.setattr(queries, "discover", lambda *a, **k: asked.append(k["options"]) or whole(*a, **k))
    monkeypatch.setattr(C, "crossed", lambda best, dims, n: crossed.append((len(best), n)) or cross(best, dims, n))
    monkeypatch.setattr(ledger, "forest_importance", lambda *a, **k: trained.append({x: k[x] for x in DEFAULTS}) or real(*a, **k))
    rows = queries.QUERIES["discovery_rounds"](spark, sf_dir).collect()
    assert asked == [discovery.Options()] and trained == [DEFAULTS] * len(trained)
    assert [n for _, n in crossed] == [1, 2][: len(crossed)] and len(trained) >= 2  # ends early only where crossing gives nothing new
    assert rows and sum(r["origin"] != "domain" for r in rows) <= Thresholds().final
    assert any(r["origin"] == "crossover" for r in rows)
