"""Steps whose work has to grow in proportion to the rows, against plain counts on small tables."""

from __future__ import annotations

import pytest

from metriclab import contract_queries, queries
from metriclab.functions import stats
from metriclab.functions.stats import guarded_corr, pairs_below
from metriclab.operators import candidates as C
from metriclab.operators import roles, scoring
from metriclab.plans import ledger


def test_pairs_are_counted_as_a_join_would_list_them(spark):
    rows = [("a", 1, 5), ("a", 1, 5), ("a", 1, 7), ("a", 1, 9), ("a", 2, 1), ("b", 1, 3), ("b", 1, 3), (None, 1, 1), (None, 1, 2), ("a", None, 3), ("a", 1, None), ("c", 3, 1), ("c", 3, 2)]
    df = spark.createDataFrame(rows, "brand string, size int, k int")
    df.createOrReplaceTempView("pair_rows")
    want = spark.sql("SELECT a.brand, a.size, count(*) AS pairs FROM pair_rows a JOIN pair_rows b ON a.brand = b.brand AND a.size = b.size AND a.k < b.k GROUP BY a.brand, a.size")
    assert sorted(pairs_below(df, ["brand", "size"], "k").collect()) == sorted(want.collect())


def test_self_join_query_lists_no_pairs(spark, sf_dir, tmp_path):
    parts = spark.range(30_000).selectExpr("id AS p_partkey", "'one' AS p_brand", "1 AS p_size")
    for name in queries._TABLES:
        (parts if name == "part" else queries.table(spark, sf_dir, name)).write.parquet(f"{tmp_path}/{name}.parquet")
    found = queries.QUERIES["sql_self_join"](spark, str(tmp_path))
    assert [tuple(r) for r in found.collect()] == [("one", 30_000 * 29_999 // 2)]
    assert "(p_partkey" not in found._jdf.queryExecution().optimizedPlan().toString()  # no join on a smaller key


def test_scores_of_one_pass_are_those_of_the_rows(spark):
    rows = [("a", 1990 + i % 3, float(i * i % 7), float(i)) for i in range(20)] + [("a", None, 4.0, 1.0), ("a", 1990, 2.0, None), ("a", 1991, None, 3.0)]
    rows += [("k", 1990 + i % 2, 0.1, float(i)) for i in range(13)] + [("n", 1990, None, 1.0), ("s", 1990, 5.0, 1.0)]
    df = spark.createDataFrame(rows, "cand string, year int, v double, y double")
    parts = scoring.moments(df)
    got, want = ({r["cand"]: r.asDict() for r in t.collect()} for t in (scoring.combined(parts), scoring.statistics(df)))
    assert got.keys() == want.keys()
    for c, r in want.items():
        assert got[c] == pytest.approx(r, nan_ok=True)
    assert got["k"]["spread"] == 0.0
    one, two = ({(r["cand"], r["year"]): r["m"] for r in t.collect()} for t in (scoring.yearly(parts), df.filter("year IS NOT NULL").groupBy("cand", "year").agg({"v": "avg"}).toDF("cand", "year", "m")))
    assert one == pytest.approx(two)
    strong = {r["cand"]: r["c"] for r in df.groupBy("cand").agg(guarded_corr("v", "y").alias("c")).collect()}
    found = {r["cand"]: r["correlation"] for r in scoring.correlation(parts).collect()}
    assert found.get("a") == pytest.approx(strong["a"]) and found.get("k") is None and found.get("s") is None


def test_fine_groups_give_what_joined_groups_give(spark):
    df = spark.createDataFrame([(k, float(i)) for i, k in enumerate([1] * 12 + [2] * 3 + [None] * 11)], "k int, v double")
    found = [C.Candidate("mean", ("v", "k")), C.Candidate("count", ("k",))]
    fine = C.projected(C.with_fine(df, found, ["k"]), found, ["v"])
    assert sorted(fine.collect()) == sorted(C.projected(df, found, ["v"]).collect())


def test_scoring_queries_shuffle_lineitem_twice(spark, sf_dir):
    plan = queries.flat(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    depth = {line.strip(" :+-").split(" ")[0]: len(line) - len(line.lstrip(" :+-")) for line in plan.splitlines() if "Relation" in line}
    assert plan.count("Join Inner") == 3 and depth
    keys = [line[line.index("(") :] for line in plan.splitlines() if "Join Inner" in line]
    assert "l_orderkey" in keys[0] and "l_partkey" in keys[1] and "c_custkey" in keys[2]  # customers meet orders, not lines


def test_ledger_writes_no_values(spark, monkeypatch):
    rows = [(i, float(i % 7), float(i % 11 + 1), f"d{i % 4}", i % 30, 2000 + i % 3, float(i % 13)) for i in range(600)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, d string, e int, yr int, y double")
    ratio = C.Candidate("ratio", (("a",), ("b",)))
    found = [ratio, C.Candidate("plain", ("a",)), C.Candidate("mean", ("a", "d")), C.Candidate("mean", (ratio, "e")), C.Candidate("count", ("e",))]
    tables, once = [], ledger.once
    monkeypatch.setattr(ledger, "once", lambda df, name: tables.append((name, df.columns)) or once(df, name))
    coarse = ledger.Ledger(df, "y", "yr", ["a", "b", "d", "e"])
    coarse.add(found)
    assert tables == []  # groups were broadcast, values computed where they are read
    monkeypatch.setattr(ledger, "COARSE_BYTES", 0)
    fine = ledger.Ledger(df, "y", "yr", ["a", "b", "d", "e"])
    fine.prepare(found)
    fine.add(found[:3])
    fine.add(found)
    assert [n for n, _ in tables] == ["fine"] and sum(c.startswith("__g") for c in tables[0][1]) == 3
    assert fine.products == pytest.approx(coarse.products) and {s: f.cuts for s, f in fine.facts.items()} == {s: f.cuts for s, f in coarse.facts.items()}


def joined_tables(monkeypatch, *modules):
    """Names of the tables that are written from the four-table join."""
    found = []
    for m in modules:
        monkeypatch.setattr(m, "once", lambda df, name, real=m.once: ("o_orderkey" in df._jdf.queryExecution().optimizedPlan().toString() and found.append(name)) or real(df, name))
    return found


def test_correlation_pairs_join_the_tables_once(spark, sf_dir, monkeypatch):
    found = joined_tables(monkeypatch, queries, C, roles)
    assert queries.QUERIES["correlation_pairs"](spark, sf_dir).count() and found == ["observations"]


def test_classification_joins_the_tables_once(spark, sf_dir, monkeypatch):
    found = joined_tables(monkeypatch, contract_queries, stats, roles)
    assert queries.QUERIES["classification_merge"](spark, sf_dir).count() and found == ["leaky"]


def test_scores_join_and_write_only_what_they_read(spark, sf_dir, monkeypatch):
    written, joined = {}, {}

    def noted(df, name, real=queries.once):
        written[name], joined[name] = df.columns, df._jdf.queryExecution().optimizedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(queries, "once", noted)
    assert queries.QUERIES["score_information"](spark, sf_dir).count() == len(queries.SCORED)
    assert queries.TARGET not in joined["observations"].split("Relation")[0]  # the relations name all their columns
    assert not {queries.TARGET, "l_orderkey"} & set(written["observations"])
    assert {"year", "y", "cand", "v"} == set(queries.long(spark, sf_dir).columns) and queries.TARGET in written["observations"]
