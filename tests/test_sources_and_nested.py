"""Partitions that are run again, previews by data version, JSON keys, sketches, and replies in other words."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from metriclab import language
from metriclab.functions import sketches
from metriclab.operators import nested
from metriclab.sources import sinks
from metriclab.text2sql.explore import Previews


def test_a_rerun_changes_its_partitions_only(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = spark.createDataFrame([(i, f"d{i % 4}", i % 2) for i in range(40)], "v long, day string, h int")
    sinks.write_partitions(rows, path, ["day", "h"])
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet") if "day=d1" not in str(p)}
    for _ in range(2):
        sinks.write_partitions(rows.filter("day = 'd1'").withColumn("v", F.col("v") + 100), path, ["day", "h"])
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.select("v", "day").collect())) == sorted((v + 100 if d == "d1" else v, d) for v, d, _ in rows.collect())
    assert before == {p.name: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet") if "day=d1" not in str(p)}
    sinks.write_partitions(rows.limit(0), path, ["day", "h"])
    assert spark.read.parquet(path).count() == 40
    plan = back.filter("day = 'd1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_saved_table_replaces_the_last(spark, tmp_path):
    for n in (3, 5):
        sinks.write_table(spark.range(n), "saved_rows", f"file://{tmp_path}/saved")
        assert spark.table("saved_rows").count() == n
    assert spark.read.parquet(f"file://{tmp_path}/saved").count() == 5


def test_previews_are_read_once_a_version(spark, tmp_path):
    path = f"file://{tmp_path}/p"
    spark.range(20).coalesce(1).write.parquet(path)
    kept = Previews(spark, most=2)
    assert [r["id"] for r in kept.rows(path, ["id"], 3)] == [0, 1, 2] and kept.rows(path, ["id"], 3) and kept.reads == 1
    spark.range(-5, 0).write.mode("append").parquet(path)
    assert [r["id"] for r in kept.rows(path, ["id"], 3)] == [-5, -4, -3] and kept.reads == 2
    for n in (4, 5):
        kept.rows(path, ["id"], n)
    kept.rows(path, ["id"], 3)
    assert kept.reads == 5


def flat_keys(value, path=""):
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in flat_keys(v, f"{path}.{k}" if path else k)]
    if isinstance(value, list):
        return [x for v in value for x in flat_keys(v, f"{path}[]")]
    return [(path, value)]


def test_keys_of_every_depth(spark):
    rnd = random.Random(2)
    values = [{"a": i, "b": {"c": rnd.choice([None, "x", 1.5, True]), "d": [{"e": j} for j in range(i % 3)]}, **({"f": [[1, 2], []]} if i % 4 == 0 else {})} for i in range(40)]
    texts = [json.dumps(v) for v in values] + [None, "", "no json {", "[]", "{}", "7", "null"]
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "id long, j string, path string")
    rows = nested.leaves(df, "j", ["id", "path"])
    assert rows.columns == ["id", "path", "path", "value", "kind"]
    want = sorted((i, p) for i, v in enumerate(values) for p, _ in flat_keys(v))
    assert sorted((r[0], r[2]) for r in rows.select("*").toDF("id", "own", "path", "value", "kind").select("id", "own", "path").collect()) == want
    profile = {r["path"]: r for r in nested.key_profile(df, "j").collect()}
    assert profile["a"]["n"] == 40 and (profile["a"]["least"], profile["a"]["most"]) == (0, 39) and profile["a"]["kinds"] == "BIGINT"
    found = [x for v in values for p, x in flat_keys(v) if p == "b.c"]
    assert profile["b.c"]["n_null"] == sum(x is None for x in found) and profile["b.c"]["n_distinct"] == len({str(x) for x in found if x is not None})
    assert profile["b.c"]["kinds"] == "BOOLEAN,DECIMAL,STRING" and profile["f[][]"]["n"] == 20
    typed = nested.with_frequent_keys(df, "j", 0.8)
    assert typed.dtypes[3:] == [("a", "bigint"), ("b.c", "string")]
    assert [r["a"] for r in typed.orderBy("id").collect()] == [*range(40), *[None] * 7]
    assert nested.key_profile(df.limit(0), "j").count() == 0 and nested.with_frequent_keys(df.limit(0), "j").columns == df.columns


@pytest.mark.parametrize("span", [("2024-01-05", "2024-01-09"), ("2024-01-01", "2024-03-31")])
def test_sketches_of_days_give_any_span(spark, span):
    rows = spark.range(60_000).selectExpr("date_add(DATE '2024-01-01', cast(id % 91 AS int)) AS day", "CASE WHEN id % 50 > 0 THEN hash(id) % 9000 END AS user", "pow(rand(5) * 10, 3) AS v", "IF(id % 2 = 0, 'a', 'b') AS k")
    rows = rows.withColumn("ts", F.col("day").cast("timestamp_ntz"))
    days = sketches.by_day(rows, "ts", ["user"], ["v"], ["k"])
    assert days.count() == 182
    got = {r["k"]: r for r in sketches.merged(days.filter(F.col("day").between(*span)), ["k"], ["user"], ["v"]).collect()}
    some = rows.filter(F.col("day").between(*span)).toPandas()
    for k, part in some.groupby("k"):
        users = part["user"].nunique()
        assert got[k]["n"] == len(part) and abs(got[k]["distinct_user"] - users) <= sketches.DISTINCT_ERROR * users
        for q, found in zip((0.25, 0.5, 0.75), got[k]["quantiles_v"]):
            assert abs((part["v"] <= found).mean() - q) <= sketches.RANK_ERROR + 1 / len(part)
    assert sketches.merged(days.limit(0), ["k"], ["user"], ["v"]).count() == 0


@pytest.mark.parametrize("said, role", [("rate", "numeric"), ("Taux", "numeric"), ("montant", "numeric"), ("amount", "numeric"), ("pourcentage", "numeric"), ("percentage", "numeric"), ("identifiant", "categorical"), ("odd", "categorical"), ("date", "date"), (None, "categorical")])
def test_roles_in_other_words(said, role):
    assert language.repaired_role({"role": said})["role"] == role


def test_misspelt_fields_are_read():
    found = language.repaired_role({"rôle": "numeric", "can_divid": "yes", "is_rte": True, "notes": "n"})
    assert found == {"role": "numeric", "is_rate": True, "can_divide": True, "is_dimension": None, "note": "n"}
    assert language.repaired_role({"main role": "text", "dimension": "oui", "rate": True}) == {"role": "categorical", "is_rate": None, "can_divide": None, "is_dimension": True, "note": ""}
    assert language.repaired_role({"is_rate": True, "rate": False, "role": "rate"})["is_rate"] is True


def test_a_dry_run_asks_three_columns():
    model = language.ScriptedModel(['{"a": {"role": "amount"}}', "nothing", '{"c": {"role": "label"}}', "never asked"])
    rows = language.diagnostic(model, [{"name": n} for n in "abcd"])
    assert [(r["name"], r["role"], r["failed"]) for r in rows] == [("a", "numeric", False), ("b", None, True), ("c", "categorical", False)]
    assert len(model.prompts) == 3 and all(r["seconds"] >= 0 for r in rows)
