"""How the target differs between low and high values of an indicator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import once
from ..functions.stats import quantiles


def quartile_effects(long: DataFrame, target: str = "y", exact: bool = True, min_distinct: int = 4, min_rows: int = 10, min_side: int = 5) -> DataFrame:
    """(cand, q1, q3, low_median, high_median, direction, low_n, high_n) where an effect can be stated.

    ``long`` is read several times; write what it comes from first if that is costly.
    """
    rows = long.filter(F.col("v").isNotNull() & F.col(target).isNotNull()).select("cand", "v", target)
    bounds = quantiles(rows, ["cand"], "v", {"q1": 0.25, "q3": 0.75}, exact, min_distinct)
    bounds = bounds.filter((F.col("n") >= min_rows) & (F.col("q1") != F.col("q3"))).select("cand", "q1", "q3")
    bounds = once(bounds, "bounds")
    side = F.when(F.col("v") <= F.col("q1"), "low").when(F.col("v") >= F.col("q3"), "high")
    sides = rows.join(F.broadcast(bounds), "cand").select("cand", side.alias("side"), F.col(target).cast("double").alias("y")).filter("side is not null")  # a row per candidate
    found = quantiles(sides, ["cand", "side"], "y", {"median": 0.5}, exact)
    of = lambda c, s, name: F.max(F.when(F.col("side") == s, F.col(c))).alias(name)
    found = found.groupBy("cand").agg(of("median", "low", "low_median"), of("median", "high", "high_median"), of("n", "low", "low_n"), of("n", "high", "high_n")).join(bounds, "cand")
    direction = F.when(F.col("high_median") > F.col("low_median"), "positive").otherwise("negative")
    found = found.filter((F.col("low_n") >= min_side) & (F.col("high_n") >= min_side)).withColumn("direction", direction)
    return found.select("cand", "q1", "q3", "low_median", "high_median", "low_n", "high_n", "direction")
