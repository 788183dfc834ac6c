"""Queries over time, groups and nested values: as-of and interval joins, rolling frames, sessions, group families, JSON keys, sketches by day, partitions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .functions import sketches
from .functions.scratch import once, shared_dir
from .operators import candidates as C
from .operators import nested, temporal
from .queries import FLAT_SQL, flat, register, table
from .sources import sinks
from .streaming.sessions import sessions


@register(
    "asof_last_error",
    "WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), e AS (SELECT user_id, ts, event_id, value FROM events WHERE event_type = 'error') "
    "SELECT p.event_id, e.event_id AS error_id, e.value AS error_value FROM p ASOF LEFT JOIN e ON p.user_id = e.user_id AND p.ts > e.ts",
)
def _(spark, sf_dir):
    """Each purchase with its user's latest error before it."""
    events = table(spark, sf_dir, "events")
    found = temporal.asof_join(events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), events.filter("event_type = 'error'").select("event_id", "user_id", "ts", "value"), ["user_id"])
    return found.select("event_id", F.col("found.event_id").alias("error_id"), F.col("found.value").alias("error_value"))


@register(
    "asof_other_type",
    "WITH t AS (SELECT DISTINCT event_type AS for_type FROM events), r AS (SELECT user_id, for_type, ts, max(event_id) AS other_id FROM events JOIN t ON event_type <> for_type GROUP BY ALL) "
    "SELECT e.event_id, r.other_id FROM events e ASOF LEFT JOIN r ON e.user_id = r.user_id AND e.event_type = r.for_type AND e.ts > r.ts",
)
def _(spark, sf_dir):
    """Each event with its user's previous event of another type: the one before the stretch of equal types that it is in."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    rows = temporal.neighbours(events, ["user_id"], "ts", ["event_id", "event_type"], tie=["event_id"]).drop("after")
    starts = rows.filter(~F.col("before.event_type").eqNullSafe(F.col("event_type")))
    found = temporal.asof_join(rows, starts, ["user_id"], tie=["event_id"], strict=False)
    return found.select("event_id", F.col("found.before.event_id").alias("other_id"))


@register(
    "interval_before_purchase",
    "WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase') "
    "SELECT p.event_id, count(e.event_id) AS n, round(coalesce(sum(e.value), 0), 4) AS total FROM p LEFT JOIN events e ON p.user_id = e.user_id AND e.ts >= p.ts - INTERVAL 3 DAY AND e.ts < p.ts GROUP BY p.event_id",
)
def _(spark, sf_dir):
    """What each buyer did in the three days before a purchase."""
    events = table(spark, sf_dir, "events")
    spans = events.filter("event_type = 'purchase'").select("event_id", "user_id", F.expr("ts - INTERVAL 3 DAYS").alias("since"), "ts")
    found = temporal.interval_join(events.select("event_id", "user_id", "ts", "value"), spans, ["user_id"], "ts", "since", "ts")
    sums = found.groupBy(F.col("interval.event_id").alias("event_id")).agg(F.count("*").alias("n"), F.sum("point.value").alias("total"))
    return spans.select("event_id").join(sums, "event_id", "left").select("event_id", F.coalesce("n", F.lit(0)).alias("n"), F.round(F.coalesce("total", F.lit(0.0)), 4).alias("total"))


@register(
    "rolling_week",
    "SELECT event_id, round(sum(value) OVER w, 4) AS total, count(*) OVER w AS n, lag(event_id) OVER o AS previous_id, round(value - lag(value) OVER o, 4) AS change, lead(event_id) OVER o AS next_id FROM events "
    "WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW), o AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)",
)
def _(spark, sf_dir):
    """Sums of the last seven days by user and type, with the rows before and after."""
    events, keys = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value"), ["user_id", "event_type"]
    rows = temporal.rolling(events, keys, "ts", 7 * temporal.DAY, {"total": F.sum("value"), "n": F.count("*")})
    rows = temporal.neighbours(rows, keys, "ts", ["event_id", "value"], tie=["event_id"], width=7 * temporal.DAY)
    return rows.select("event_id", F.round("total", 4).alias("total"), "n", F.col("before.event_id").alias("previous_id"), F.round(F.col("value") - F.col("before.value"), 4).alias("change"), F.col("after.event_id").alias("next_id"))


@register(
    "user_sessions",
    "WITH e AS (SELECT DISTINCT * FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 10 = 0)), s AS (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 12 HOUR, true) AS opens FROM e), "
    "g AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM s) "
    "SELECT user_id, CAST(min(ts) AS TIMESTAMP) AS session_start, CAST(max(ts) + INTERVAL 12 HOUR AS TIMESTAMP) AS session_end, count(*) AS n, round(sum(value), 4) AS total FROM g GROUP BY user_id, k",
)
def _(spark, sf_dir):
    """Sessions with twelve hours between events at most, of a table in which every tenth event stands twice."""
    events = table(spark, sf_dir, "events")
    found = sessions(events.unionByName(events.filter("event_id % 10 = 0")), "12 hours")
    return found.select("user_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"), F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n", F.round("total", 4).alias("total"))


_DIMS = ["p_brand", "o_orderpriority", "l_returnflag", "c_mktsegment", "p_size"]


@register(
    "group_families",
    f"WITH {FLAT_SQL}, g AS (SELECT {', '.join(_DIMS)}, grouping({', '.join(_DIMS)}) AS family, count(*) AS n, avg(l_quantity) AS quantity, avg(c_acctbal) AS balance FROM flat GROUP BY GROUPING SETS ({', '.join(f'({d})' for d in _DIMS)})) "
    "SELECT CASE family " + " ".join(f"WHEN {C.family_id(k, len(_DIMS))} THEN '{d}'" for k, d in enumerate(_DIMS)) + " END AS dimension, coalesce(" + ", ".join(f"CAST({d} AS VARCHAR)" for d in _DIMS) + ") AS group_key, CAST(n AS DOUBLE) AS n, "
    "round(CASE WHEN n >= 10 THEN quantity END, 6) AS mean_quantity, round(CASE WHEN n >= 10 THEN balance END, 6) AS mean_balance FROM g",
)
def _(spark, sf_dir):
    """Size and means of the groups of five dimensions, from one scan of the flat table."""
    found = C.group_families(flat(spark, sf_dir), _DIMS, ["l_quantity", "c_acctbal"])
    names = F.create_map(*[x for k, d in enumerate(_DIMS) for x in (F.lit(C.family_id(k, len(_DIMS))).cast("long"), F.lit(d))])
    key = F.coalesce(*[F.col(f"_d{k}").cast("string") for k in range(len(_DIMS))])
    return found.select(names[F.col("_family")].alias("dimension"), key.alias("group_key"), F.col("_n").alias("n"), F.round("_m0", 6).alias("mean_quantity"), F.round("_m1", 6).alias("mean_balance"))


#: Nested JSON around the events' own, with keys that some rows lack, nulls, and text that is no JSON; both engines run it.
_JSON = (
    "CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'broken {' ELSE '{\"props\": ' || props || CASE WHEN event_id % 2 = 0 THEN ', \"score\": ' || CAST(event_id % 7 AS STRING) || '.5' ELSE '' END || "
    "', \"at\": {\"page\": \"' || event_type || '\", \"depth\": ' || CASE WHEN event_id % 5 = 0 THEN 'null' ELSE CAST(event_id % 5 AS STRING) END || '}}' END"
)


@register(
    "json_key_profile",
    f"WITH j AS (SELECT {_JSON} AS j FROM events), v AS (SELECT j FROM j WHERE json_valid(j)), a AS (SELECT j, unnest(json_keys(j)) AS path FROM v), b AS (SELECT path, json_extract(j, '$.' || path) AS x FROM a), "
    "c AS (SELECT path, x, unnest(json_keys(x)) AS key FROM b WHERE json_type(x) = 'OBJECT'), l AS (SELECT path, x FROM b WHERE json_type(x) <> 'OBJECT' UNION ALL SELECT path || '.' || key, json_extract(x, '$.' || key) FROM c), "
    "k AS (SELECT path, x, CASE json_type(x) WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'BIGINT' THEN 'BIGINT' WHEN 'DOUBLE' THEN 'DECIMAL' WHEN 'VARCHAR' THEN 'STRING' END AS kind FROM l) "
    "SELECT path, count(*) AS n, count(*) FILTER (WHERE kind IS NULL) AS n_null, count(DISTINCT CASE WHEN kind IS NOT NULL THEN CAST(x AS VARCHAR) END) AS n_distinct, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds, "
    "min(CASE WHEN kind IN ('BIGINT', 'DECIMAL') THEN CAST(x AS DOUBLE) END) AS least, max(CASE WHEN kind IN ('BIGINT', 'DECIMAL') THEN CAST(x AS DOUBLE) END) AS most FROM k GROUP BY path",
)
def _(spark, sf_dir):
    """Every key of the events' JSON, at every depth."""
    return nested.key_profile(table(spark, sf_dir, "events").selectExpr(f"{_JSON} AS j"), "j")


@register(
    "json_frequent_keys",
    f"WITH j AS (SELECT event_id, {_JSON} AS j FROM events), v AS (SELECT event_id, CASE WHEN json_valid(j) THEN j END AS j FROM j) "
    "SELECT event_id, TRY_CAST(json_extract_string(j, '$.at.depth') AS BIGINT) AS depth, json_extract_string(j, '$.at.page') AS page, TRY_CAST(json_extract_string(j, '$.props.k') AS BIGINT) AS k FROM v",
)
def _(spark, sf_dir):
    """The keys that three quarters of the events have, as typed columns."""
    found = nested.with_frequent_keys(table(spark, sf_dir, "events").selectExpr("event_id", f"{_JSON} AS j"), "j", 0.75)
    assert found.columns == ["event_id", "j", "at.depth", "at.page", "props.k"]
    return found.toDF("event_id", "j", "depth", "page", "k").drop("j")


@register(
    "sketched_months",
    "SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS n, min(value) AS least, max(value) AS most, true AS users_within, true AS quartiles_within FROM events GROUP BY ALL",
)
def _(spark, sf_dir):
    """Months from the sketches of their days, and whether they keep the stated errors beside the exact values."""
    events = table(spark, sf_dir, "events")
    days = once(sketches.by_day(events, "ts", ["user_id"], ["value"]), "days")
    found = sketches.merged(days, [F.trunc("day", "month").alias("month")], ["user_id"], ["value"])
    exact = events.groupBy(F.trunc(F.to_date("ts"), "month").alias("of")).agg(F.count_distinct("user_id").alias("users"))
    place = events.select(F.trunc(F.to_date("ts"), "month").alias("of"), "value").join(F.broadcast(found.select("month", F.col("quantiles_value").alias("q"))), F.col("of") == F.col("month"))  # a row per month
    ranks = place.groupBy("of").agg(*[F.avg((F.col("value") < F.col("q")[i]).cast("double")).alias(f"under{i}") for i in range(3)], *[F.avg((F.col("value") <= F.col("q")[i]).cast("double")).alias(f"upto{i}") for i in range(3)])
    close = [(F.col(f"under{i}") <= p + sketches.RANK_ERROR) & (F.col(f"upto{i}") >= p - sketches.RANK_ERROR) for i, p in enumerate((0.25, 0.5, 0.75))]
    rows = found.join(exact.join(ranks, "of"), F.col("month") == F.col("of"))
    return rows.select("month", "n", F.col("least_value").alias("least"), F.col("most_value").alias("most"), (F.abs(F.col("distinct_user_id") - F.col("users")) <= sketches.DISTINCT_ERROR * F.col("users")).alias("users_within"), (close[0] & close[1] & close[2]).alias("quartiles_within"))


_MONTH = "substr(CAST(o_orderdate AS STRING), 1, 7)"


@register(
    "partition_rerun",
    f"SELECT {_MONTH} AS month, count(*) AS n, round(sum(CASE WHEN {_MONTH} = '1996-03' THEN o_totalprice + 1 ELSE o_totalprice END), 2) AS total FROM orders WHERE {_MONTH} BETWEEN '1996-02' AND '1996-04' GROUP BY 1",
)
def _(spark, sf_dir):
    """A table by month, one month of which is run again twice with another price; the others stay as they are."""
    rows = table(spark, sf_dir, "orders").withColumn("month", F.expr(_MONTH))
    path = f"{shared_dir(spark)}/orders-{uuid.uuid4().hex}"
    sinks.write_partitions(rows, path, ["month"])
    for _ in range(2):
        sinks.write_partitions(rows.filter("month = '1996-03'").withColumn("o_totalprice", F.col("o_totalprice") + 1), path, ["month"])
    back = spark.read.parquet(path).filter("month BETWEEN '1996-02' AND '1996-04'")
    return back.groupBy("month").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).withColumn("month", F.col("month").cast("string"))
