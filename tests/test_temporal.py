"""Joins and frames over time against plain loops, and sessions of a stream against those of a table."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from metriclab.operators import candidates as C
from metriclab.operators import temporal
from metriclab.streaming.sessions import sessions

START = datetime(2024, 1, 1)
HOUR = 3600 * temporal.SECOND


@pytest.fixture(scope="module")
def rows():
    """Events of one hot user, of rare ones, without a user, without a time, with equal times, before 1970, and repeated."""
    rnd = random.Random(9)
    out = [(i, rnd.choice([1, 1, 1, 1, 2, 3, None]), START + timedelta(minutes=rnd.randrange(6000)), rnd.choice("abc"), float(rnd.randrange(10))) for i in range(300)]
    out += [(300, 1, None, "a", 1.0), (301, None, None, "b", 2.0), (302, 4, datetime(1960, 5, 1), "a", None), (303, 4, datetime(1960, 5, 9), "b", 3.0), out[0], out[0]]
    return out


SCHEMA = "id long, user long, ts timestamp_ntz, kind string, v double"


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("width", [HOUR, 24 * HOUR, 10_000 * 24 * HOUR])
@pytest.mark.parametrize("strict", [True, False])
def test_asof(spark, df, rows, width, strict):
    left, right = df.filter("kind != 'a'"), df.filter("kind = 'a'")
    got = temporal.asof_join(left, right, ["user"], strict=strict, width=width, name="last")
    assert got.columns == [*df.columns, "last"]
    want = []
    for r in rows:
        if r[3] != "a":
            some = [x for x in rows if x[3] == "a" and None not in (x[1], x[2], r[1], r[2]) and x[1] == r[1] and (x[2] < r[2] if strict else x[2] <= r[2])]
            want.append((r[0], max((x[2] for x in some), default=None)))
    assert sorted(((r["id"], r["last"] and r["last"]["ts"]) for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert temporal.asof_join(left.limit(0), right, ["user"]).count() == 0
    assert temporal.asof_join(left, right.limit(0), ["user"]).filter("found IS NOT NULL").count() == 0


def test_asof_with_ties_takes_the_order_of_both(df, rows):
    got = temporal.asof_join(df, df, ["user"], tie=["id"], width=HOUR)
    want = []
    for r in rows:
        some = [(x[2], x[0]) for x in rows if None not in (x[1], x[2], r[1], r[2]) and x[1] == r[1] and (x[2], x[0]) < (r[2], r[0])]
        want.append((r[0], max(some)[1] if some else None))
    assert sorted(((r["id"], r["found"] and r["found"]["id"]) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_intervals(spark, df, rows):
    rnd = random.Random(4)
    spans = [(i, rnd.choice([1, 2, None]), START + timedelta(minutes=(m := rnd.randrange(6000))), START + timedelta(minutes=m + rnd.choice([0, 1, 50, 3000, 10**6]))) for i in range(60)] + [(60, 1, None, START), (61, 4, datetime(1950, 1, 1), datetime(1960, 5, 9))]
    other = spark.createDataFrame(spans, "id long, user long, since timestamp_ntz, until timestamp_ntz")
    for width in (HOUR, 24 * HOUR):
        got = sorted((r["point"]["id"], r["interval"]["id"]) for r in temporal.interval_join(df, other, ["user"], "ts", "since", "until", width).collect())
        assert got == sorted((r[0], s[0]) for r in rows for s in spans if None not in (r[1], r[2], s[2]) and r[1] == s[1] and s[2] <= r[2] < s[3])
    assert temporal.interval_join(df, other.limit(0), ["user"], "ts", "since", "until").count() == 0


@pytest.mark.parametrize("stretch", [0, 7 * HOUR, 90 * HOUR])
def test_rolling(df, rows, stretch):
    got = temporal.rolling(df, ["user", "kind"], "ts", 8 * HOUR, {"total": F.sum("v"), "n": F.count("*")}, stretch)
    want = []
    for r in rows:
        some = [x for x in rows if r[2] and x[2] and (x[1], x[3]) == (r[1], r[3]) and r[2] - timedelta(hours=8) <= x[2] <= r[2]]
        sums = [x[4] for x in some if x[4] is not None]
        want.append((r[0], sum(sums) if sums else None, len(some) if r[2] else None))
    assert got.columns == [*df.columns, "total", "n"]
    assert sorted(((r["id"], r["total"], r["n"]) for r in got.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("width", [HOUR, 24 * HOUR])
def test_neighbours(df, rows, width):
    distinct = list(dict.fromkeys(rows))
    got = temporal.neighbours(df.dropDuplicates(), ["user"], "ts", ["id"], tie=["id"], width=width)
    want = []
    for r in distinct:
        before = [(x[2], x[0]) for x in distinct if r[2] and x[2] and x[1] == r[1] and (x[2], x[0]) < (r[2], r[0])]
        after = [(x[2], x[0]) for x in distinct if r[2] and x[2] and x[1] == r[1] and (x[2], x[0]) > (r[2], r[0])]
        want.append((r[0], max(before)[1] if before else None, min(after)[1] if after else None))
    assert sorted(((r["id"], r["before"] and r["before"]["id"], r["after"] and r["after"]["id"]) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_a_hot_key_is_split(spark):
    """No window or join deals rows by the key alone, but for a row per stretch."""
    hot = spark.range(2000).selectExpr("1 AS user", "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, id) AS ts", "1.0 AS v")
    plan = temporal.rolling(hot, ["user"], "ts", 24 * HOUR, {"n": F.count("*")})._jdf.queryExecution().executedPlan().toString()
    assert "_s#" in next(x for x in plan.splitlines() if "hashpartitioning" in x)
    found = temporal.asof_join(hot, hot, ["user"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in found.splitlines() if " Window [" in x or x.strip().startswith("Window")]
    assert len(windows) == 2 and sum("_s#" in x.split("], [")[1] for x in windows) == 1


def test_group_families_scan_once(spark, df):
    plan = C.group_families(df, ["user", "kind"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Scan") <= 1
    means = [C.Candidate("mean", ("v", "user")), C.Candidate("mean", ("v", "kind")), C.Candidate("count", ("user",)), C.Candidate("count", ("kind",))]
    together = C.projected(df, means, ["id"]).collect()
    alone = [C.projected(df, [m], ["id"]).collect() for m in means]
    for m, some in zip(means, alone):
        assert sorted(((r["id"], r[m.label()]) for r in together), key=repr) == sorted(map(tuple, some), key=repr)


@pytest.mark.parametrize("order", [1, 2])
def test_sessions_of_a_stream_equal_those_of_a_table(spark, tmp_path, order):
    """Files out of order, with repeats in other files, and rows that come too late to count."""
    rnd = random.Random(order)
    start = datetime(2024, 3, 1)
    rows = [(i, rnd.choice([1, 2, None]), start + timedelta(minutes=rnd.randrange(4 * 1440)), float(rnd.randrange(9))) for i in range(400)]
    schema = "event_id long, user_id long, ts timestamp_ntz, value double"
    shuffled = sorted(rows, key=lambda r: r[2] + timedelta(minutes=rnd.randrange(1400)))  # nearly a day late at most
    parts = [shuffled[i : i + 80] + rnd.sample(shuffled[max(0, i - 40) : i + 1], 1) * 2 for i in range(0, len(rows), 80)]
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    (tmp_path / "in").mkdir()
    stream = sessions(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path), "40 minutes", late="2 days")
    late = [(1000 + i, 1, start - timedelta(days=40) + timedelta(minutes=i), 1.0) for i in range(5)]
    close = [(2000, 9, start + timedelta(days=60), 0.0), (2001, 9, start + timedelta(days=120), 0.0)]
    for part in [*parts, close[:1], late, close[1:]]:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination()
    got = [tuple(r) for r in spark.read.parquet(out).filter("user_id IS NULL OR user_id <> 9").collect()]
    want = [tuple(r) for r in sessions(spark.createDataFrame(rows, schema), "40 minutes").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(want) > 50
