"""Scores of candidates, all on the long form (cand, v, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import correlation_matrix, quantiles, rank_pct  # noqa: F401
from ..settings import Thresholds


def winsorized(long: DataFrame, limits: Thresholds = Thresholds(), exact: bool = True) -> DataFrame:
    """Values clipped to the outer quantiles of their candidate; a missing value stays missing.

    ``long`` is read several times; write what it comes from first if that is costly.
    """
    bounds = quantiles(long, ["cand"], "v", {"_lo": limits.clip_low, "_hi": limits.clip_high}, exact).select("cand", "_lo", "_hi")
    clipped = F.when(F.col("v").isNotNull(), F.greatest("_lo", F.least("_hi", "v")))
    return long.join(F.broadcast(bounds), "cand", "left").withColumn("v", clipped).drop("_lo", "_hi")  # a row per candidate


def statistics(long: DataFrame) -> DataFrame:
    """(cand, n, present, lo, hi, mean, spread): one aggregation for all candidates."""
    return long.groupBy("cand").agg(
        F.count("*").alias("n"), F.count("v").alias("present"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("spread"),
    )


def moments(long: DataFrame, year: str = "year", target: str = "y") -> DataFrame:
    """(cand, year, judged, n, present, lo, hi, mean, var, and of the target beside a value y_mean, y_var, both): all that the scores read, in one pass.

    ``judged`` tells rows with a target from those without.  Means are kept between the ends, so a constant stays one.
    """
    y = F.when(F.col("v").isNotNull(), F.col(target).cast("double"))
    found = long.groupBy("cand", F.col(year).alias("year"), F.col(target).isNotNull().alias("judged")).agg(
        F.count("*").alias("n"), F.count("v").alias("present"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.avg("v").alias("mean"), F.var_pop("v").alias("var"),
        F.min(y).alias("_y_lo"), F.max(y).alias("_y_hi"), F.avg(y).alias("y_mean"), F.var_pop(y).alias("y_var"), F.covar_pop("v", y).alias("both"),
    )
    between = lambda c, lo, hi: F.when(F.col(c).isNotNull(), F.greatest(lo, F.least(hi, c)))
    return found.withColumns({"mean": between("mean", "lo", "hi"), "y_mean": between("y_mean", "_y_lo", "_y_hi")}).drop("_y_lo", "_y_hi")


def _centre(mean: str, over: Window) -> tuple[Column, Column]:
    """The least of the parts' means, and how far the mean of all lies above it: exactly zero for a constant."""
    least = F.min(mean).over(over)
    return least, F.try_divide(F.sum(F.col("present") * (F.col(mean) - least)).over(over), F.sum(F.when(F.col(mean).isNotNull(), F.col("present"))).over(over))


def combined(parts: DataFrame) -> DataFrame:
    """``statistics`` from ``moments``."""
    least, above = _centre("mean", Window.partitionBy("cand"))
    rows = parts.withColumns({"_least": least, "_above": above})
    rows = rows.withColumn("_squares", F.col("present") * (F.col("var") + (F.col("mean") - F.col("_least") - F.col("_above")) ** 2))
    out = rows.groupBy("cand").agg(*[f(c).alias(c) for c, f in (("n", F.sum), ("present", F.sum), ("lo", F.min), ("hi", F.max))], F.max(F.col("_least") + F.col("_above")).alias("mean"), F.sum("_squares").alias("_squares"))
    return out.withColumn("spread", F.when(F.col("present") > 1, F.sqrt(F.col("_squares") / (F.col("present") - 1)))).drop("_squares")


def yearly(parts: DataFrame) -> DataFrame:
    """(cand, year, m) from ``moments``: means of the years that are known."""
    least, above = _centre("mean", Window.partitionBy("cand", "year"))
    return parts.filter("year IS NOT NULL").withColumn("m", least + above).groupBy("cand", "year").agg(F.max("m").alias("m"))


def correlation(parts: DataFrame) -> DataFrame:
    """(cand, correlation) from ``moments``: of the values with the target where both are present; NULL for a constant."""
    own = Window.partitionBy("cand")
    rows = parts.filter("judged AND present > 0")
    for c in ("mean", "y_mean"):
        least, above = _centre(c, own)
        rows = rows.withColumn(f"_d_{c}", F.col(c) - least - above)
    x, y, n = F.col("_d_mean"), F.col("_d_y_mean"), F.col("present")
    sums = rows.groupBy("cand").agg(F.sum(n * (F.col("both") + x * y)).alias("xy"), F.sum(n * (F.col("var") + x * x)).alias("xx"), F.sum(n * (F.col("y_var") + y * y)).alias("yy"))
    return sums.select("cand", F.try_divide("xy", F.sqrt("xx") * F.sqrt("yy")).alias("correlation"))


def degenerate_filter(stats: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """(cand, kept): enough values, and a range that is not nothing beside their size."""
    wide = F.col("hi") - F.col("lo")
    size = F.greatest(F.abs("mean"), F.abs("hi"), F.lit(1.0))
    kept = (F.col("present") / F.col("n") > limits.min_completeness) & (wide > 0) & (wide / size > limits.min_spread)
    return stats.select("cand", F.coalesce(kept, F.lit(False)).alias("kept"))


def completeness(stats: DataFrame) -> DataFrame:
    return stats.select("cand", (F.col("present") / F.col("n")).alias("completeness"))


def information(stats: DataFrame) -> DataFrame:
    """(cand, variation, information): spread over mean, and its rank among the candidates."""
    variation = F.coalesce(F.try_divide("spread", F.abs("mean")), F.lit(0.0))
    return stats.select("cand", variation.alias("variation")).withColumn("information", rank_pct("variation"))


def stability(long: DataFrame, year: str = "year") -> DataFrame:
    """(cand, drift, stability): how little the yearly means vary.  Undefined drift counts as the largest.

    With one year for all, nothing is known: stability is NULL.
    """
    return drifted(long.filter(F.col(year).isNotNull()).groupBy("cand", year).agg(F.avg("v").alias("m")))


def drifted(yearly: DataFrame) -> DataFrame:
    """``stability`` from (cand, m), a row per candidate and year."""
    drift = yearly.groupBy("cand").agg(F.try_divide(F.stddev_samp("m"), F.abs(F.avg("m"))).alias("drift"))
    filled = F.coalesce("drift", F.max("drift").over(Window.partitionBy()))
    return drift.withColumn("_filled", filled).withColumn("stability", 1 - rank_pct("_filled")).select("cand", "drift", "stability")


def median_imputed(long: DataFrame, exact: bool = True) -> DataFrame:
    """Missing values as the median of their candidate, which has one unless all are missing; ``long`` is read several times."""
    medians = quantiles(long, ["cand"], "v", {"_median": 0.5}, exact).select("cand", "_median")
    return long.join(F.broadcast(medians), "cand", "left").withColumn("v", F.coalesce("v", "_median")).drop("_median")  # a row per candidate


def composite(scores: DataFrame, limits: Thresholds = Thresholds(), neutral: float | None = None) -> DataFrame:
    """``scores`` with ``score``: the weighted sum of the four; ``neutral`` stands for a missing one."""
    names = ("predictive", "information", "stability", "completeness")
    term = lambda c: F.coalesce(F.col(c), F.lit(neutral)) if neutral is not None else F.col(c)
    total = sum((F.lit(w) * term(c) for w, c in zip(limits.weights[1:], names[1:])), F.lit(limits.weights[0]) * term(names[0]))
    return scores.withColumn("score", total)
