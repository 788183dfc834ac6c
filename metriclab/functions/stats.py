"""Statistics that every operator shares, in forms that distribute.

Wide tables are scored in long form: a row per observation and column, grouped by the
column's name.  Ranks and exact quantiles come from counted values: values are dealt in
ranges and running totals go over the ranges, so no task holds a column, and a value that
most rows have is one row.  What is read more than once is written once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import once


def melted(df: DataFrame, columns: Sequence[str], keep: Sequence[str | Column] = (), name: str = "column_name", value: str = "v") -> DataFrame:
    """(keep..., name, value DOUBLE): one row per row and column, without a shuffle."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast("double").alias(value)) for c in columns])
    return df.select(*keep, F.explode(pairs).alias("_pair")).select(*[c if isinstance(c, str) else c for c in df.select(*keep).columns], f"_pair.{name}", f"_pair.{value}")


def guarded_corr(a: str, b: str) -> Column:
    """Pearson correlation of the rows where both are present; NULL for a constant, where ``corr`` raises."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def counted(df: DataFrame, keys: Sequence[str], value: str, n: Column | None = None) -> DataFrame:
    """(keys, value, _n): rows of each value that isn't missing; ``n`` is what a row counts, else 1."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg((F.count("*") if n is None else F.sum(n)).alias("_n"))


def placed(counts: DataFrame, keys: Sequence[str], value: str, carry: Sequence[str] = ()) -> DataFrame:
    """``counts`` with ``_before``, the rows of smaller values of the key, and ``_all``, those of the key; columns ``carry`` are kept.

    Values lie in ranges; the table is written with its ranges, so that one cut holds for
    the sums inside a range and over the ranges.
    """
    keys = list(keys)
    ranged = once(counts.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id()), "values")
    totals = ranged.groupBy(*keys, "_part").agg(F.sum("_n").alias("_own"))
    over = Window.partitionBy(*keys)
    totals = totals.withColumns({"_base": F.coalesce(F.sum("_own").over(over.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_all": F.sum("_own").over(over)})
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn("_in", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(totals, [*keys, "_part"])
    return rows.select(*keys, value, "_n", *carry, (F.col("_base") + F.col("_in")).alias("_before"), "_all")


def pairs_below(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, pairs): how many pairs of rows of one key have a smaller and a larger value; a missing key or value makes none.

    A row has a pair with each row of a smaller value, so running totals count the pairs
    without listing them: work grows with the rows, not with their square.
    """
    keys = list(keys)
    rows = placed(counted(df.dropna(subset=keys), keys, value), keys, value)
    return rows.groupBy(*keys).agg(F.sum(F.col("_n") * F.col("_before")).alias("pairs")).filter("pairs > 0")


#: Share of the rows by which a sketch of 10,000 samples may miss a rank, doubled.
MISS = 2e-4


def quantiles(df: DataFrame, keys: Sequence[str], value: str, wanted: dict[str, float], exact: bool = True, least_values: int = 0) -> DataFrame:
    """(keys, n, least, most, ...): rows, ends and the wanted interpolated quantiles of each key.

    A sketch of fixed size tells in one pass between which values each quantile lies; a
    second pass counts what is below and the values between, and only those are ranked, so no
    shuffle is as large as the table.  Where a sketch should miss, the key's values are all ranked.
    Without ``exact`` the sketch decides.  Keys with fewer different values than
    ``least_values`` are left out.  ``df`` is read several times; write it first if it is costly.
    """
    keys, names = list(keys), list(wanted)
    df = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    ends = [F.count("*").alias("n"), F.min("_v").alias("least"), F.max("_v").alias("most")]
    if not exact:
        found = df.groupBy(*keys).agg(*ends, *[F.percentile_approx("_v", F.lit(q), F.lit(10_000)).alias(c) for c, q in wanted.items()])
    else:
        steps = [min(1.0, max(0.0, q + d)) for q in wanted.values() for d in (-MISS, MISS)]
        stats = once(df.groupBy(*keys).agg(*ends, F.percentile_approx("_v", F.array(*map(F.lit, steps)), F.lit(10_000)).alias("_cuts")), "sketches")
        low = lambda i: F.when(F.lit(steps[2 * i] <= 0), F.col("least")).otherwise(F.col("_cuts")[2 * i])
        high = lambda i: F.when(F.lit(steps[2 * i + 1] >= 1), F.col("most")).otherwise(F.col("_cuts")[2 * i + 1])
        ends_of = F.broadcast(stats.drop("n"))  # a row per column or candidate
        inside = [F.col("_v").between(low(i), high(i)) for i in range(len(names))]
        under = sum((F.when(F.col("_v") < low(i), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(len(names))), F.lit(0))
        # one pass: values outside all ranges are told apart only by the ranges they lie below
        counts = df.join(ends_of, keys).groupBy(*keys, under.alias("_under"), F.when(reduce(or_, inside), F.col("_v")).alias("_w")).agg(F.count("*").alias("_n"))
        counts = once(counts, "counts")
        below = counts.groupBy(*keys).agg(*[F.sum(F.when(F.col("_under").bitwiseAND(F.lit(1 << i)) > 0, F.col("_n")).otherwise(F.lit(0))).alias(f"_under{i}") for i in range(len(names))])
        picked = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(inside)]))).alias("_k")
        rows = counts.filter("_w IS NOT NULL").select(*keys, F.col("_w").alias("_v"), "_n").join(ends_of, keys).select(*keys, "_v", "_n", picked)
        between = placed(counted(rows, [*keys, "_k"], "_v", F.col("_n")), [*keys, "_k"], "_v")
        found = once(stats.drop("_cuts").join(F.broadcast(below), keys), "below")
        found = once(found.join(_reached(between.join(F.broadcast(found), keys), keys, wanted), keys, "left"), "quantiles")
        missed = found.filter(reduce(or_, [F.col(f"_high_{c}").isNull() | ~F.col(f"_from_{c}") for c in names])).select(*keys)
        if not missed.isEmpty():
            again = placed(counted(df.join(missed, keys), keys, "_v"), keys, "_v").withColumn("_k", F.explode(F.array(*[F.lit(i) for i in range(len(names))])))
            known = stats.drop("_cuts").withColumns({f"_under{i}": F.lit(0) for i in range(len(names))})
            found = found.join(missed, keys, "left_anti").unionByName(known.join(_reached(again.join(F.broadcast(known), keys), keys, wanted), keys))
        part = lambda q: (F.col("n") - 1) * F.lit(float(q)) - F.floor((F.col("n") - 1) * F.lit(float(q)))
        found = found.select(*keys, "n", "least", "most", *[(F.col(f"_low_{c}") + (F.col(f"_high_{c}") - F.col(f"_low_{c}")) * part(q)).alias(c) for c, q in wanted.items()])
    if least_values:
        rough = once(df.groupBy(*keys).agg(F.approx_count_distinct("_v").alias("_d")), "distinct")
        few = df.join(F.broadcast(rough.filter(F.col("_d") <= 10 * least_values)), keys).groupBy(*keys).agg(F.count_distinct("_v").alias("_d")).filter(F.col("_d") < least_values)
        found = found.join(F.broadcast(few), keys, "left_anti")
    return found


def _reached(rows: DataFrame, keys: list[str], wanted: dict[str, float]) -> DataFrame:
    """(keys, _low_*, _high_*, _from_*): the values at the ranks around each quantile, and whether ``rows`` begin at or below the lower one."""
    out = []
    for i, (c, q) in enumerate(wanted.items()):
        at, own, start = (F.col("n") - 1) * F.lit(float(q)), F.col("_k") == i, F.col(f"_under{i}") + F.col("_before")
        value = lambda place, own=own, start=start: F.min(F.when(own & (start + F.col("_n") > place), F.col("_v")))
        out += [value(F.floor(at)).alias(f"_low_{c}"), value(F.ceil(at)).alias(f"_high_{c}"), F.coalesce(F.min(F.when(own, start)) <= F.min(F.floor(at)), F.lit(False)).alias(f"_from_{c}")]
    return rows.groupBy(*keys).agg(*out)


def average_ranks(df: DataFrame, keys: Sequence[str], value: str, out: str = "rank") -> DataFrame:
    """``df`` (rows with a value) with average ranks within ``keys``: ties share the mean of their ranks."""
    keys = list(keys)
    df = once(df.filter(F.col(value).isNotNull()), "ranked")
    ranks = placed(counted(df, keys, value), keys, value)
    ranks = ranks.select(*keys, value, (F.col("_before") + (F.col("_n") + 1) / 2.0).alias(out))
    return df.join(ranks, [*keys, value])


def rank_pct(value: str, partition: Sequence[str] = ()) -> Column:
    """Average rank over number of rows for a small table of statistics; NULL where the value is."""
    w = Window.partitionBy(*partition, F.col(value).isNull())
    ties = Window.partitionBy(*partition, value)
    pct = (F.rank().over(w.orderBy(value)) + (F.count("*").over(ties) - 1) / 2.0) / F.count("*").over(w)
    return F.when(F.col(value).isNotNull(), pct)


def spearman(pairs: DataFrame, keys: Sequence[str], a: str = "a", b: str = "b") -> DataFrame:
    """(keys, rho): rank correlation of the rows of each key where both sides are present; NULL if undefined.

    The rows are counted by both values in one pass; all else reads those counts.  Ranks
    are taken from their mean, so a constant gives exact zeros.
    """
    keys = list(keys)
    both = pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    both = once(both.groupBy(*keys, F.col(a).alias("_a"), F.col(b).alias("_b")).agg(F.count("*").alias("_rows")), "pairs")

    def centred(side: str) -> DataFrame:
        ranks = placed(counted(both, keys, side, F.col("_rows")), keys, side)
        return ranks.select(*keys, side, (F.col("_before") + (F.col("_n") + 1) / 2.0 - (F.col("_all") + 1) / 2.0).alias(f"_r{side}"))

    rows = both.join(centred("_a"), [*keys, "_a"]).join(centred("_b"), [*keys, "_b"])
    x, y, n = F.col("_r_a"), F.col("_r_b"), F.col("_rows")
    sums = rows.groupBy(*keys).agg(F.sum(n * x * y).alias("_xy"), F.sum(n * x * x).alias("_xx"), F.sum(n * y * y).alias("_yy"))
    return sums.select(*keys, F.try_divide("_xy", F.sqrt("_xx") * F.sqrt("_yy")).alias("rho"))


def rank_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], at_once: int = 12, write: bool = True) -> DataFrame:
    """(a, b, rho): rank correlation of column pairs over the rows that have both; NULL if undefined.

    For columns without missing values, the ranks of one side join the rows, a column at a
    time; the other side needs no join: its rows are counted by value with the sums of those
    ranks, in one pass for all columns, and as equal values have equal ranks, that is enough.
    Other pairs are ranked pair by pair.  ``df`` is read several times; without ``write`` it
    comes from a written table already.
    """
    names = list(dict.fromkeys(c for pair in pairs for c in pair))
    plain = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    plain = once(plain, "wide") if write else plain
    number = {c: f"c{i}" for i, c in enumerate(names)}
    missing = plain.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in plain.columns]).first()
    easy = [p for p in pairs if not missing[number[p[0]]] and not missing[number[p[1]]]]
    turn = len({a for a, _ in easy}) < len({b for _, b in easy})  # join the side with fewer columns
    joined = list(dict.fromkeys(number[p[0] if turn else p[1]] for p in easy))
    products: dict[tuple[str, str], tuple[float, float, float]] = {}
    for lo in range(0, len(joined), at_once):
        some = joined[lo : lo + at_once]
        listed = list(dict.fromkeys(number[p[1] if turn else p[0]] for p in easy if number[p[0] if turn else p[1]] in some))
        ranks = once(_centred(placed(counted(melted(plain, some), ["column_name"], "v"), ["column_name"], "v")), "ranks")
        squares = {r["column_name"]: r["s"] for r in ranks.groupBy("column_name").agg(F.sum(F.col("_n") * F.col("r") * F.col("r")).alias("s")).collect()}
        rows = plain
        for c in some:
            rows = rows.join(ranks.filter(F.col("column_name") == c).select(F.col("v").alias(c), F.col("r").alias(f"r{c}")), c)
        counts = melted(rows, listed, [f"r{c}" for c in some]).groupBy("column_name", "v").agg(F.count("*").alias("_n"), *[F.sum(f"r{c}").alias(f"s{c}") for c in some])
        other = _centred(placed(counts, ["column_name"], "v", [f"s{c}" for c in some]))
        for r in other.groupBy("column_name").agg(F.sum(F.col("_n") * F.col("r") * F.col("r")).alias("s"), *[F.sum(F.col("r") * F.col(f"s{c}")).alias(f"p{c}") for c in some]).collect():  # a row per column
            products |= {(r["column_name"], c): (r[f"p{c}"], r["s"], squares[c]) for c in some}
    found = []
    for a, b in easy:
        xy, xx, yy = products.get((number[b], number[a]) if turn else (number[a], number[b]), (0.0, 0.0, 0.0))
        found.append((a, b, xy / (xx**0.5 * yy**0.5) if xx > 0 and yy > 0 else None))
    hard = [p for p in pairs if p not in set(easy)]
    out = df.sparkSession.createDataFrame(found, "a string, b string, rho double")
    if hard:
        items = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(number[a]).alias("x"), F.col(number[b]).alias("y")) for a, b in hard])
        listed_pairs = df.sparkSession.createDataFrame(hard, "a string, b string")
        out = out.unionByName(listed_pairs.join(spearman(plain.select(F.explode(items).alias("p")).select("p.*"), ["a", "b"], "x", "y"), ["a", "b"], "left"))
    return out


def _centred(rows: DataFrame) -> DataFrame:
    """``placed`` rows with ``r``, the average rank less its mean, so a constant gives exact zeros."""
    return rows.withColumn("r", F.col("_before") + (F.col("_n") + 1) / 2.0 - (F.col("_all") + 1) / 2.0)


def correlation_matrix(wide: DataFrame, names: list[str]) -> list[tuple[str, str, float]]:
    """(a, b, correlation) of all pairs in one pass over a complete wide table; pairs with a constant are left out.

    The driver gets a number per pair of candidates, whatever the number of rows.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    if len(names) < 2:
        return []
    plain = wide.select(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(names)])
    vectors = VectorAssembler(inputCols=plain.columns, outputCol="x").transform(plain).select("x")
    matrix = Correlation.corr(vectors, "x").first()[0].toArray()
    return [(names[i], names[j], float(matrix[i, j])) for i in range(len(names)) for j in range(i + 1, len(names)) if matrix[i, j] == matrix[i, j]]
