"""Candidates, proposals, export, dictionary, language contracts and the SQL guard."""

from __future__ import annotations

import json

import pytest

from metriclab import language
from metriclab.operators import candidates as C
from metriclab.operators.roles import WorkingLists
from metriclab.plans.discovery import Options, discover
from metriclab.plans.export import bi_script, unique_names
from metriclab.settings import Settings, Thresholds
from metriclab.sources import readers, sinks
from metriclab.streaming.events import windowed_counts
from metriclab.text2sql import explore
from metriclab.text2sql.guard import RefusedQuery, checked, stripped
from metriclab.text2sql.runner import ask


def test_signatures_ignore_order_and_round():
    a, b = C.Candidate("ratio", (("x", "y"), ("z",))), C.Candidate("ratio", (("y", "x"), ("z",)), "domain", 2, "other")
    assert a.signature() == b.signature() and len(C.unique([a, b])) == 1
    assert C.Candidate("sum", (a, C.Candidate("plain", ("q",)))).signature() == C.Candidate("sum", (C.Candidate("plain", ("q",)), b)).signature()


def test_values_of_every_kind(spark):
    rows = [(1.0, 0.0, "g", "2020-01-02 00:00:00", "2020-01-01 23:59:59.5"), (4.0, 2.0, "g", "2020-01-01 00:00:00", "2020-01-01 00:00:00.5"), (6.0, None, None, None, "2020-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "a double, b double, g string, d string, e string").selectExpr("a", "b", "g", "CAST(d AS TIMESTAMP_NTZ) d", "CAST(e AS TIMESTAMP_NTZ) e")
    ratio = C.Candidate("ratio", (("a",), ("b",)))
    found = [ratio, C.Candidate("count", ("g",)), C.Candidate("mean", ("a", "g")), C.Candidate("mean", (ratio, "g")), C.Candidate("gap", ("d", "e")), C.Candidate("complement", ("b", 1)), C.Candidate("sum", (ratio, C.Candidate("plain", ("a",))))]
    out = C.projected(df, found, ["a"], Thresholds(group_min_rows=2)).orderBy("a").collect()
    assert [tuple(r)[1:] for r in out] == [(None, 2.0, 2.5, 2.0, 0.0, 1.0, None), (2.0, 2.0, 2.5, 2.0, -1.0, -1.0, 6.0), (None, None, None, None, None, None, None)]


def test_small_groups_have_no_mean(spark):
    df = spark.createDataFrame([("g", 1.0)] * 9 + [("h", 1.0)] * 10, "g string, t double")
    got = {(r["g"], r["mean__t__by__g"]) for r in C.projected(df, [C.Candidate("mean", ("t", "g"))], ["g"]).collect()}
    assert got == {("g", None), ("h", 1.0)}


def test_proposals_are_checked():
    p = lambda **k: {"name": "n", **k}
    listed = [p(operation="ratio", numerator=["a"], denominator=["b"]), p(operation="ratio", numerator=["a"], denominator=["b"]), p(operation="ratio", numerator=["a"], denominator=None), p(operation="plain", column="y"), p(operation="plain", column="t"), p(operation="odd"), p(operation="plain", column="none")]
    good, bad = C.checked_proposals(listed, ["a", "b", "t", "y"], ["a", "b", "y"], "y")
    assert len(good) == 1
    assert [r for _, r in bad] == ["repeats another", "an empty side", "uses the target", "not numeric: t", "unknown operation odd", "unknown columns none"]


def test_complements(spark):
    df = spark.createDataFrame([(0.5, 50.0, 500.0)] * 10, "share double, pct double, big double")
    assert C.complement_wholes(df, ["share", "pct", "big"]) == {"share": 1, "pct": 100, "big": None}


def test_crossover_needs_one_denominator():
    r = lambda n, d: C.Candidate("ratio", ((n,), (d,)))
    out = C.crossed([r("a", "x"), r("b", "x"), r("c", "y")], ["g"], 1)
    assert [c.kind for c in out] == ["sum", "mean", "mean", "mean"]


def test_script_and_names():
    found = [C.Candidate("ratio", (("a",), ("b",))), C.Candidate("mean", ("a", "g")), C.Candidate("gap", ("d", "e"))]
    text, failed = bi_script(found, ["One", "one", 'A "b" [c]'], "T")
    assert failed == [] and "DIVIDE(T[a], T[b])" in text and "AVERAGEX" in text and '"A b c"' in text
    assert unique_names(["One", "one"]) == ["One", "one (2)"]


def test_dictionary_forms(spark, tmp_path):
    assert readers.dictionary_columns(["#", "Nom du champ", "Définition"]) == ("Nom du champ", "Définition")
    assert readers.dictionary_columns(["a", "b"]) == ("a", "b")
    file = tmp_path / "d.txt"
    file.write_text("col_a, -- first   one\ncol_b\n?? !!\nnan -- x\n", encoding="utf-8")
    assert {tuple(r) for r in readers.read_dictionary(spark, str(file)).collect()} == {("col_a", "first one"), ("col_b", "")}
    csv = tmp_path / "d.csv"
    csv.write_text("colonne,définition\n a ,text\n,none\n", encoding="utf-8")
    assert [tuple(r) for r in readers.read_dictionary(spark, str(csv)).collect()] == [("a", "text")]


def test_validation(spark, tmp_path):
    data = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1.0, float("nan"))], "y double, x double").write.parquet(data)
    file = tmp_path / "d.txt"
    file.write_text("y -- target\n", encoding="utf-8")
    df, _, warnings = readers.validated(spark, data, str(file), "y")
    assert df.first()["x"] is None and warnings == ["column x has no definition"]
    for bad in ((data, str(file), "z"), (str(tmp_path / "no.parquet"), str(file), "y"), (data, "", "y")):
        with pytest.raises(readers.InputError):
            readers.validated(spark, *bad)


def test_sinks_and_settings(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    sinks.write_csv(df, str(tmp_path / "c"), single=True)
    sinks.write_json({"a": 1}, str(tmp_path / "j.json"))
    sinks.write_json(df, str(tmp_path / "j"))
    sinks.write_table(df, "registered_rows", f"file://{tmp_path}/registered")
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 1 and spark.table("registered_rows").count() == 1
    assert json.loads((tmp_path / "j.json").read_text()) == {"a": 1}
    assert Settings.from_env({"METRICLAB_TARGET": "y"}).target == "y"


def test_discovery_finds_the_signal(spark):
    import random

    rnd = random.Random(5)
    rows = []
    for i in range(300):
        a, b, c = rnd.uniform(1, 9), rnd.uniform(1, 9), rnd.uniform(1, 9)
        rows.append((a, b, c, rnd.choice("uv"), f"{2015 + i % 5}-03-01 00:00:00", 10 * a / b + rnd.gauss(0, 0.1)))
    df = spark.createDataFrame(rows, "a double, b double, c double, g string, d string, y double").selectExpr("a", "b", "c", "g", "CAST(d AS TIMESTAMP_NTZ) d", "y")
    lists = WorkingLists(dates=["d"], dims=["g"], denominators=["b", "c"], numerators=["a"], targets=["c"])
    found = discover(df, "y", lists, options=Options(limits=Thresholds(rounds=2, best_ratios=2, final=5, veto=0.0), trees=5, folds=2, depth=4))
    ranked = [r["cand"] for r in found.ranking.collect()]
    assert ranked[0] == "ratio__a__over__b" and len(ranked) <= 5 and found.errors[0]["r2"] > 0.5


def test_tolerant_replies():
    assert language.tolerant_json('```json\n{"a": 1}\n```') == {"a": 1} and language.tolerant_json('so: {"a": {"b": 2}} done') == {"a": {"b": 2}}
    with pytest.raises(ValueError):
        language.tolerant_json("nothing")
    assert language.pick({"columns": {"Col A": {"role": "x"}}}, ["col_a"]) == {"col_a": {"role": "x"}}
    assert language.repaired_role({"Role": "Numérique (measure)", "is rate": "yes"})["role"] == "numeric"
    model = language.ScriptedModel(["junk", '{"c0": {"role": "numeric", "can_divide": true}, "c1": {"role": "dimension"}}', "junk", "junk"])
    found, failed = language.classify(model, [{"name": f"c{i}", "type_class": "numeric"} for i in range(7)])
    assert found["c0"]["can_divide"] is True and found["c1"]["role"] == "categorical" and failed == ["c2", "c3", "c4", "c5", "c6"]
    assert "x" in language.explained(None, {"name": "x", "formula": "a / b", "effect": {"high_median": 2, "low_median": 1}})


ALLOWED = [
    "SELECT * FROM t", "WITH c AS (SELECT a FROM t) SELECT * FROM c", "SELECT replace(s, 'update', 'x') FROM t -- limit", "SELECT x.a FROM t x JOIN t y ON x.a = y.a WHERE x.a IN (SELECT a FROM t)",
    "SELECT a, rank() OVER (ORDER BY a) FROM t", "(SELECT a FROM t) UNION SELECT a FROM t ORDER BY 1 LIMIT 3", "SELECT a, count(*) FROM t GROUP BY ROLLUP (a) HAVING count(*) > 0",
    "SELECT upper(s), round(a / 2, 1), coalesce(s, 'x'), CAST(a AS STRING), year(current_date()), get_json_object(s, '$.a') FROM t WHERE s LIKE 's%'", "SELECT e FROM t LATERAL VIEW explode(array(a)) v AS e",
    "SELECT transform(array(a), x -> abs(x)), percentile_approx(a, 0.5) OVER (PARTITION BY s) FROM t",
]
REFUSED = ["DROP TABLE t", "INSERT INTO t SELECT * FROM t", "SELECT 1; SELECT 2", "SELECT * FROM parquet.`/etc`", "SELECT * FROM other", "CREATE TABLE z AS SELECT * FROM t", "SELECT * FROM range(5)", "SELECT * FROM t WHERE a IN (SELECT a FROM other)", "not sql"]
CALLS = [
    "java_method('java.lang.System', 'setProperty', 'x', 'y')", "reflect('java.lang.System', 'getProperty', 'user.home')", "try_reflect('java.lang.System', 'getProperty', 'user.home')", "input_file_name()",
    "abs(length(reflect('java.lang.System', 'getProperty', 'user.home')))", "own_udf(a)", "current_user()", "session_user", "raise_error('x')", "no_such_function(a)",
]
REFUSED += [f"SELECT {c} FROM t" for c in CALLS] + [f"SELECT a FROM t WHERE s = {c}" for c in CALLS] + [f"SELECT a FROM t WHERE a IN (SELECT length({CALLS[1]}) FROM t)", f"WITH c AS (SELECT {CALLS[0]} AS x FROM t) SELECT x FROM c"]
REFUSED += [f"SELECT transform(array(a), x -> {CALLS[1]}) FROM t", f"SELECT max(a) OVER (ORDER BY {CALLS[1]}) FROM t", f"SELECT a FROM t ORDER BY {CALLS[1]}", f"SELECT a FROM t LATERAL VIEW explode(array({CALLS[1]})) v AS e"]


@pytest.mark.parametrize("sql", ALLOWED)
def test_guard_allows(spark, sql):
    spark.createDataFrame([(1, "s")], "a int, s string").createOrReplaceTempView("t")
    assert spark.sql(checked(spark, sql, ["t"])).count() >= 1


@pytest.mark.parametrize("sql", REFUSED)
def test_guard_refuses(spark, sql):
    spark.udf.register("own_udf", lambda a: a)
    with pytest.raises(RefusedQuery):
        checked(spark, sql, ["t"])


def test_questions_are_repaired_and_limited(spark):
    spark.range(500).selectExpr("id AS a").createOrReplaceTempView("big_rows")
    model = language.ScriptedModel(["DROP TABLE big_rows", "SELECT nope FROM big_rows", "```sql\nSELECT a FROM big_rows -- all\n```", "There are many."])
    answer = ask(spark, model, "which?", "big_rows")
    assert len(answer.rows) == 200 and answer.text == "There are many." and len(answer.errors) == 2
    lost = ask(spark, language.ScriptedModel(["x"] * 3), "which?", "big_rows")
    assert lost.rows == [] and "could not" in lost.text
    assert stripped("```\nSELECT 1;\n```") == "SELECT 1"
    with pytest.raises(RefusedQuery):
        checked(spark, "SELECT replace('a', 'b', 'c') FROM big_rows", ["big_rows"], strict_keywords=True)
    assert explore.row_count(spark.table("big_rows")).first()["n"] == 500


def test_stream_counts_like_a_table(spark, tmp_path):
    rows = spark.createDataFrame([("2020-01-01 01:00:00", "a", 1.0), ("2020-01-01 05:00:00", "a", 2.0), ("2020-01-03 00:00:00", "b", 3.0)], "ts string, event_type string, value double").selectExpr("CAST(ts AS TIMESTAMP_NTZ) ts", "event_type", "value")
    rows.write.parquet(str(tmp_path / "in"))
    stream = windowed_counts(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")))
    query = stream.writeStream.format("memory").queryName("counted").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(map(tuple, spark.table("counted").collect())) == sorted(map(tuple, windowed_counts(rows).collect()))
