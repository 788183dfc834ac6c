"""Statistics, cleaning and scores at their limits, on frames worked out by hand."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from metriclab.functions.stats import average_ranks, guarded_corr, quantiles, rank_correlations, spearman
from metriclab.operators import cleaning, effects, roles, scoring, selection
from metriclab.operators.selection import greedy_prune, weight_grid


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-3, 3), min_size=1, max_size=30))
def test_average_ranks(spark, values):
    df = frame(spark, [("k", i, float(v)) for i, v in enumerate(values)], "key string, i int, v double")
    got = {r["i"]: r["rank"] for r in average_ranks(df, ["key"], "v").collect()}
    want = pd.Series(values).rank()
    assert [got[i] for i in range(len(values))] == want.tolist()


def test_constant_has_no_correlation(spark):
    df = frame(spark, [(1.0, 2.0), (1.0, 3.0), (1.0, None)], "a double, b double")
    assert df.agg(guarded_corr("a", "b").alias("r")).first()["r"] is None


def test_spearman_uses_pairs_that_are_whole(spark):
    rows = [("x", 1.0, 10.0), ("x", 2.0, None), ("x", 3.0, 30.0), ("x", 4.0, 20.0), ("x", None, 1.0)]
    got = spearman(frame(spark, rows, "k string, a double, b double"), ["k"]).first()["rho"]
    assert got == pytest.approx(0.5)


def test_dates_need_more_than_the_share(spark):
    rows = [("01/02/2020", "01/02/2020"), ("31/12/2021", "x"), (" 05/06/2020 ", "05/06/2020"), ("07/08/2020", "07/08/2020"), ("09/08/2020", "09/08/2020")]
    df, taken = cleaning.promote_dates(frame(spark, rows, "DATE_A string, DATE_B string"))
    assert taken == {"DATE_A": 0} and dict(df.dtypes) == {"DATE_A": "date", "DATE_B": "string"}


def test_white_space(spark):
    rows = [("  a \t b ",), ("nan",), (" None ",), ("",), (None,), ("a b",)]
    df = cleaning.clean_whitespace(frame(spark, rows, "v string"))
    assert [r["v"] for r in df.collect()] == ["a b", None, None, None, None, "a b"]
    assert cleaning.whitespace_audit(frame(spark, rows, "v string")).first()["modified"] == 5


def test_zero_share_at_the_limit(spark):
    df = frame(spark, [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 1.0), (None, 0.0)], "a double, b double")
    assert [(r["column_name"], r["zero_share"]) for r in cleaning.zero_heavy(df).collect()] == [("a", 0.5)]


def test_outliers_need_ten_rows_and_a_spread(spark):
    few = frame(spark, [(float(i),) for i in range(8)] + [(1e6,)], "v double")
    enough = frame(spark, [(float(i),) for i in range(9)] + [(1e6,)], "v double")
    flat = frame(spark, [(1.0,)] * 20 + [(9.0,)], "v double")
    assert cleaning.iqr_outliers(few).count() == 0 and cleaning.iqr_outliers(flat).count() == 0
    assert cleaning.iqr_outliers(enough).first()["outliers"] == 1


def test_rows_repeat_with_nulls_equal(spark):
    assert cleaning.dedup_rows(frame(spark, [(1, None), (1, None), (1, "a")], "a int, b string")).count() == 2


def test_repetition_counts_rows(spark):
    df = frame(spark, [("a",)] * 10 + [("b",)] * 2 + [(None,)] * 5, "v string")
    row = roles.repetition(df, ["v"]).first()
    assert row["repeat_share"] == pytest.approx(10 / 12) and row["repeats"]


def test_leakage_of_the_target_and_of_a_constant(spark):
    df = frame(spark, [(float(i), float(i * i), 1.0) for i in range(12)], "y double, x double, c double")
    got = {r["column_name"]: (r["correlation"], r["leaks"]) for r in roles.leakage(df, "y").collect()}
    assert got["y"] == (1.0, True) and got["x"][1] and got["c"] == (None, None)


def test_extended_dims_leave_the_target_out(spark):
    df = frame(spark, [(float(i % 2), i % 3, "a") for i in range(60)], "target double, few int, t string")
    assert roles.extended_dims(df, roles.WorkingLists(dims=["t"]), "target") == ["t", "few"]


def test_winsorize_keeps_missing_and_bounds(spark):
    rows = [("c", float(i)) for i in range(101)] + [("c", None)]
    out = [r["v"] for r in scoring.winsorized(frame(spark, rows, "cand string, v double")).collect()]
    assert out.count(None) == 1 and min(v for v in out if v is not None) == 1.0 and max(v for v in out if v is not None) == 99.0


def test_degenerate_filter_limits(spark):
    rows = [("sparse", 1.0), ("sparse", 2.0), ("sparse", 3.0)] + [("sparse", None)] * 7 + [("flat", 5.0)] * 4 + [("good", 1.0), ("good", 2.0)]
    got = {r["cand"]: r["kept"] for r in scoring.degenerate_filter(scoring.statistics(frame(spark, rows, "cand string, v double"))).collect()}
    assert got == {"sparse": False, "flat": False, "good": True}


def test_stability_of_one_year_is_unknown(spark):
    rows = [("a", 2020, 1.0), ("a", 2020, 2.0), ("b", 2020, 3.0)]
    assert [r["stability"] for r in scoring.stability(frame(spark, rows, "cand string, year int, v double")).collect()] == [None, None]


def test_greedy_prune_prefers_domain_and_leaves_no_close_pair():
    rng = np.random.default_rng(1)
    names = [f"c{i}" for i in range(12)]
    pairs = [(a, b, float(rng.uniform(-1, 1))) for i, a in enumerate(names) for b in names[i + 1 :]]
    kept = greedy_prune([(n, float(rng.random()), "domain" if n == "c3" else "exhaustive") for n in names], pairs)
    assert kept[0] == "c3" and not [p for p in pairs if abs(p[2]) > 0.95 and p[0] in kept and p[1] in kept]


def test_weight_grid_sizes():
    assert len(weight_grid()) == 1771 and len(weight_grid(floor=0.10)) == 455
    assert all(abs(sum(w) - 1) < 1e-9 for _, *w in weight_grid(floor=0.1))


def test_no_domain_candidate_gives_no_weights(spark):
    scores = frame(spark, [("a", "exhaustive", 0.1, 0.2, 0.3, 0.4)], "cand string, origin string, predictive double, information double, stability double, completeness double")
    assert selection.best_weights(selection.weight_search(scores)) is None


def test_effect_needs_four_values(spark):
    rows = [("three", float(i % 3), float(i)) for i in range(30)] + [("many", float(i), float(i)) for i in range(30)]
    got = effects.quartile_effects(frame(spark, rows, "cand string, v double, y double")).collect()
    assert [(r["cand"], r["direction"], r["low_n"], r["high_n"]) for r in got] == [("many", "positive", 8, 8)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_quantiles_are_exact(spark, values):
    df = frame(spark, [("k", None if v is None else float(v)) for v in values] + [("few", 1.0), ("few", 2.0)], "key string, v double")
    got = {r["key"]: r for r in quantiles(df, ["key"], "v", {"lo": 0.01, "mid": 0.5, "hi": 0.99}).collect()}
    some = [float(v) for v in values if v is not None]
    assert ("k" in got) == bool(some) and got["few"]["mid"] == 1.5
    if some:
        assert [got["k"][c] for c in ("lo", "mid", "hi")] == pytest.approx(np.quantile(some, [0.01, 0.5, 0.99]).tolist()) and got["k"]["n"] == len(some)


def test_quantiles_where_the_sketch_misses(spark, monkeypatch):
    import metriclab.functions.stats as stats

    monkeypatch.setattr(stats, "MISS", -0.3)  # bounds that leave the quantile out
    df = frame(spark, [("k", float(i)) for i in range(101)], "key string, v double")
    assert quantiles(df, ["key"], "v", {"a": 0.25, "b": 0.505}).first().asDict() == {"key": "k", "n": 101, "least": 0.0, "most": 100.0, "a": 25.0, "b": 50.5}


def test_mostly_zeros_are_ranked_and_cut(spark):
    df = spark.range(4000).selectExpr("cast(if(id % 20 = 0, id, 0) as double) AS x", "cast(id as double) AS y", "cast(if(id % 7 = 0, null, id % 5) as double) AS z", "1.0D AS c")
    plain = df.toPandas()
    got = {(r["a"], r["b"]): r["rho"] for r in rank_correlations(df, [("x", "y"), ("z", "y"), ("x", "z"), ("c", "y")]).collect()}
    for a, b in (("x", "y"), ("z", "y"), ("x", "z")):
        both = plain[[a, b]].dropna()
        assert got[a, b] == pytest.approx(both[a].rank().corr(both[b].rank()), abs=1e-9)
    assert got["c", "y"] is None
    found = scoring.winsorized(df.selectExpr("'x' AS cand", "x AS v")).agg({"v": "max"}).first()[0]
    assert found == pytest.approx(np.quantile(plain["x"], 0.99))
