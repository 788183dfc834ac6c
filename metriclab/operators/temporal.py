"""Joins and frames over time that don't hold a key's history in one task.

Time is cut into stretches.  Rows are grouped by key and stretch; what a stretch needs of
earlier ones comes as one carried row, or as copies of the rows just before its edge.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import once

SECOND = 1_000_000
DAY = 86_400 * SECOND


def micros(time: str) -> Column:
    """Microseconds since 1970 of a date or timestamp, whatever the session's time zone."""
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"), F.col(time).cast("timestamp_ntz"))


def _stretch(at: Column, width: int) -> Column:
    return F.floor(at / F.lit(width)).cast("long")


def _packed(df: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def _same(a: DataFrame, b: DataFrame, pairs: Mapping[str, str]) -> Column:
    found = F.lit(True)
    for x, y in pairs.items():
        found = found & a[x].eqNullSafe(b[y])
    return found


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], time: str = "ts", tie: Sequence[str] = (), strict: bool = True, width: int = DAY, name: str = "found") -> DataFrame:
    """``left`` with ``name``, the row of ``right`` with the same keys that is the latest before it (or at it, if not ``strict``).

    ``tie`` names columns of both sides that order rows of one time; of right rows equal in all
    that, it is open which counts.  Rows of both sides meet in stretches of ``width`` microseconds;
    from earlier stretches only the latest right row is carried, so a task holds one stretch of a
    key and a key has a row per stretch beside it.  A left row without keys, time or match stays
    with a null.
    """
    keys = list(keys)
    ks = [f"_k{i}" for i in range(len(keys))]

    def side(df: DataFrame, place: int, is_left: bool) -> DataFrame:
        own, other = ("_left", "_right") if is_left else ("_right", "_left")
        ties = [F.col(f"`{c}`").alias(f"_t{i}") for i, c in enumerate(tie)]
        return df.select(*[F.col(f"`{k}`").alias(a) for k, a in zip(keys, ks)], micros(time).alias("_at"), *ties, F.lit(place).alias("_side"), _packed(df).alias(own), F.lit(None).alias(other))

    order = ["_at", *[f"_t{i}" for i in range(len(tie))], "_side"]
    rows = side(right.dropna(subset=[*keys, time]), 2 if strict else 0, False).unionByName(side(left, 1, True))
    rows = once(rows.withColumn("_s", _stretch(F.col("_at"), width)), "asof")
    inside = Window.partitionBy(*ks, "_s").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    edges = rows.groupBy(*ks, "_s").agg(F.max_by("_right", F.when(F.col("_right").isNotNull(), F.struct(*order))).alias("_edge"))
    earlier = Window.partitionBy(*ks).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(*[F.col(k).alias(f"_e{k}") for k in ks], F.col("_s").alias("_es"), F.last("_edge", ignorenulls=True).over(earlier).alias("_carried"))
    found = rows.withColumn("_last", F.last("_right", ignorenulls=True).over(inside)).filter("_left IS NOT NULL")
    found = found.join(edges, _same(found, edges, {**{k: f"_e{k}" for k in ks}, "_s": "_es"}), "left")
    known = F.col("_at").isNotNull()
    for k in ks:
        known = known & F.col(k).isNotNull()
    return found.select("_left", F.when(known, F.coalesce("_last", "_carried")).alias("_f")).select("_left.*", F.col("_f").alias(name))


def interval_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str], time: str, start: str, end: str, width: int = DAY) -> DataFrame:
    """(point, interval) structs of equal keys with start <= time < end.

    An interval lies in at most two stretches of the level whose stretches are as long as it is;
    levels double from ``width`` on.  Points are looked up once a level that occurs, of which there
    are at most some dozens, so neither side is copied for every stretch of a long interval.
    Nulls and empty intervals match nothing.
    """
    keys = list(keys)
    ks = [f"_k{i}" for i in range(len(keys))]
    named = lambda df: [F.col(f"`{k}`").alias(a) for k, a in zip(keys, ks)]
    spans = intervals.select(*named(intervals), micros(start).alias("_a"), micros(end).alias("_b"), _packed(intervals).alias("interval")).filter("_a < _b").dropna(subset=ks)
    level = F.greatest(F.lit(0), F.ceil(F.log2((F.col("_b") - F.col("_a")) / F.lit(float(width))))).cast("int")
    size = lambda c: F.lit(float(width)) * F.pow(F.lit(2.0), c)
    spans = once(spans.withColumn("_level", level), "intervals")
    levels = [r["_level"] for r in spans.select("_level").distinct().collect()]  # at most some dozens
    cell = lambda at, c: F.floor(at / size(c)).cast("long")
    spans = spans.withColumn("_s", F.explode(F.sequence(cell(F.col("_a"), F.col("_level")), cell(F.col("_b") - 1, F.col("_level")))))
    rows = points.select(*named(points), micros(time).alias("_at"), _packed(points).alias("point")).dropna(subset=[*ks, "_at"])
    rows = rows.withColumn("_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn("_s", cell(F.col("_at"), F.col("_level")))
    return rows.join(spans, [*ks, "_level", "_s"]).filter("_a <= _at AND _at < _b").select("point", "interval")


def rolling(df: DataFrame, keys: Sequence[str], time: str, width: int, sums: Mapping[str, Column], stretch: int = 0) -> DataFrame:
    """``df`` with aggregates over the rows of equal keys from ``width`` microseconds before a row up to its time, its peers included.

    Time is cut into stretches (four widths, if not given); rows less than a width before an edge are
    copied over it, and windows stay inside a stretch, so a key's history is split over tasks.
    Null keys are a key of their own; a row without a time has nulls and is in no frame.
    """
    stretch = stretch or 4 * width
    at, own = F.col("_at"), F.col("_own")
    rows = df.select(_packed(df).alias("_row"), *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], micros(time).alias("_at"), *[F.col(f"`{c}`") for c in df.columns])
    rows = rows.withColumn("_own", _stretch(at, stretch)).withColumn("_s", F.explode_outer(F.sequence(own, _stretch(at + F.lit(width), stretch))))
    frame = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))], "_s").orderBy("_at").rangeBetween(-width, 0)
    found = rows.select("_row", "_at", "_own", "_s", *[F.when(at.isNotNull(), c.over(frame)).alias(n) for n, c in sums.items()])
    return found.filter(F.col("_s").eqNullSafe(own)).select("_row.*", *sums)


def neighbours(df: DataFrame, keys: Sequence[str], time: str, columns: Sequence[str], tie: Sequence[str] = (), width: int = DAY) -> DataFrame:
    """``df`` with ``before`` and ``after``: the columns of the previous and the next row of equal keys by time, then ``tie``.

    Lag and lead stay inside stretches of ``width`` microseconds; over an edge the last row of the
    nearest earlier stretch and the first of the nearest later one are carried.  Null keys are a key of
    their own; rows without a time have no neighbours.
    """
    ks = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(_packed(df).alias("_row"), *[F.col(f"`{k}`").alias(a) for k, a in zip(keys, ks)], micros(time).alias("_at"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_v"), F.struct(micros(time).alias("_at"), *[F.col(f"`{c}`").alias(f"_t{i}") for i, c in enumerate(tie)]).alias("_o"))
    rows = once(rows.withColumn("_s", _stretch(F.col("_at"), width)), "neighbours")
    inside, along = Window.partitionBy(*ks, "_s").orderBy("_o"), Window.partitionBy(*[f"_e{k}" for k in ks]).orderBy("_es")
    edges = rows.filter("_at IS NOT NULL").groupBy(*ks, "_s").agg(F.min_by("_v", "_o").alias("_first"), F.max_by("_v", "_o").alias("_last"))
    edges = edges.select(*[F.col(k).alias(f"_e{k}") for k in ks], F.col("_s").alias("_es"), "_first", "_last")
    edges = edges.withColumns({"_from": F.lag("_last").over(along), "_to": F.lead("_first").over(along)}).drop("_first", "_last")
    found = rows.withColumns({"_b": F.lag("_v").over(inside), "_a": F.lead("_v").over(inside)})
    found = found.join(edges, _same(found, edges, {**{k: f"_e{k}" for k in ks}, "_s": "_es"}), "left")
    timed = lambda a, b: F.when(F.col("_at").isNotNull(), F.coalesce(a, b))
    return found.select("_row", timed("_b", "_from").alias("before"), timed("_a", "_to").alias("after")).select("_row.*", "before", "after")
