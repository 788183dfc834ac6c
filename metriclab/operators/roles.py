"""What columns can be used for: leakage, duplicates, cardinality, repetition, working lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import once
from ..functions.stats import correlation_matrix, guarded_corr, rank_correlations
from ..settings import Thresholds
from .cleaning import date_columns, numeric_columns


@dataclass
class WorkingLists:
    """Column lists that candidate generation works from."""

    dates: list[str] = field(default_factory=list)
    dims: list[str] = field(default_factory=list)
    denominators: list[str] = field(default_factory=list)
    numerators: list[str] = field(default_factory=list)
    targets: list[str] = field(default_factory=list)


def leakage(df: DataFrame, target: str, columns: Sequence[str] | None = None, limits: Thresholds = Thresholds(), write: bool = True) -> DataFrame:
    """(column_name, correlation, leaks): rank correlation of each numeric column with the target.

    The target leaks by definition; an undefined correlation gives NULL in both.
    """
    names = [c for c in columns or numeric_columns(df) if c != target]
    found = rank_correlations(df, [(c, target) for c in names], write=write)
    rows = found.select(F.col("a").alias("column_name"), F.col("rho").alias("correlation"), (F.abs("rho") >= limits.leak_correlation).alias("leaks"))
    return rows.unionByName(df.sparkSession.range(1).select(F.lit(target).alias("column_name"), F.lit(1.0).alias("correlation"), F.lit(True).alias("leaks")))


def duplicate_columns(df: DataFrame, columns: Sequence[str] | None = None, limits: Thresholds = Thresholds(), write: bool = True) -> DataFrame:
    """(a, b, correlation) of column pairs, a before b, that say the same.

    Columns without missing values are correlated in one matrix; a pair with a missing
    value counts the rows that have both.  A constant repeats nothing.
    """
    names = sorted(columns or numeric_columns(df))
    plain = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in names])
    return correlated(plain, names, write).filter(F.abs("correlation") >= limits.duplicate_correlation)


def correlated(plain: DataFrame, names: Sequence[str], write: bool = True) -> DataFrame:
    """(a, b, correlation) of all pairs of DOUBLE columns; undefined ones are left out.  The driver gets a number per pair.

    ``plain`` is read several times; without ``write`` it comes from a written table already.
    """
    names = list(names)
    plain = plain.select(*[F.col(f"`{c}`") for c in names])
    plain = once(plain, "wide") if write else plain
    missing = plain.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(names)]).first()
    whole = [c for i, c in enumerate(names) if not missing[f"m{i}"]]
    found = correlation_matrix(plain, whole)
    rest = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :] if a not in whole or b not in whole]
    for lo in range(0, len(rest), 20):  # wide aggregates fall out of code generation
        some = rest[lo : lo + 20]
        row = plain.agg(*[guarded_corr(f"`{a}`", f"`{b}`").alias(f"p{i}") for i, (a, b) in enumerate(some)]).first()
        found += [(a, b, row[f"p{i}"]) for i, (a, b) in enumerate(some) if row[f"p{i}"] is not None]
    return df_of(plain, found)


def df_of(like: DataFrame, pairs: list[tuple[str, str, float]]) -> DataFrame:
    return like.sparkSession.createDataFrame(pairs, "a string, b string, correlation double")


def duplicate_notes(pairs: DataFrame) -> DataFrame:
    """(column_name, note): for each column the ones it repeats, in order."""
    both = pairs.select(F.col("a").alias("column_name"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    return both.groupBy("column_name").agg(F.concat(F.lit("repeats "), F.array_join(F.array_sort(F.collect_list("other")), ", ")).alias("note"))


def cardinality(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """(column_name, distinct_ratio): distinct values over all rows."""
    names = list(columns or df.columns)
    count = F.approx_count_distinct if approximate else F.count_distinct
    if approximate:
        row = df.agg(F.count("*").alias("_n"), *[count(f"`{c}`").alias(c) for c in names])
        return row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), (F.col(f"`{c}`") / F.col("_n")).alias("distinct_ratio")) for c in names])).alias("p")).select("p.*")
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in names])).alias("p")).select("p.*")
    return long.groupBy("column_name").agg((count("v") / F.count("*")).alias("distinct_ratio"))


def repetition(df: DataFrame, columns: Sequence[str], limits: Thresholds = Thresholds()) -> DataFrame:
    """(column_name, repeat_share, repeats): rows in values that occur often, over rows with a value."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns])).alias("p")).select("p.*")
    counts = long.filter("v is not null").groupBy("column_name", "v").agg(F.count("*").alias("k"))
    often = F.sum(F.when(F.col("k") >= limits.repeat_min_rows, F.col("k")).otherwise(0))
    shares = counts.groupBy("column_name").agg((often / F.sum("k")).alias("repeat_share"))
    return shares.withColumn("repeats", F.col("repeat_share") >= limits.repeat_share)


def roles_table(df: DataFrame, target: str, rates: Sequence[str] = (), no_denominators: Sequence[str] = (), limits: Thresholds = Thresholds()) -> DataFrame:
    """(column_name, date, dim, denominator, numerator, mean_target): which lists each column belongs to.

    ``rates`` and ``no_denominators`` come from the classification of the columns.  A
    numeric column is usable if it doesn't leak, is no near-key, and is not of low cardinality.
    """
    numbers, dates = set(numeric_columns(df)), set(date_columns(df))
    texts = [c for c in df.columns if c not in numbers | dates]
    names = [c for c in df.columns if c != target]
    kinds = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(c in numbers).alias("number"), F.lit(c in dates).alias("date"), F.lit(c in rates).alias("rate"), F.lit(c in no_denominators).alias("whole")) for c in names])
    rows = df.sparkSession.range(1).select(F.explode(kinds).alias("p")).select("p.*")
    rows = rows.join(cardinality(df, names), "column_name", "left").join(leakage(df, target, limits=limits).select("column_name", "leaks"), "column_name", "left")
    if texts:
        rows = rows.join(repetition(df, texts, limits).select("column_name", "repeats"), "column_name", "left")
    else:
        rows = rows.withColumn("repeats", F.lit(False))
    ratio = F.col("distinct_ratio")
    usable = F.col("number") & ~F.coalesce("leaks", F.lit(False)) & (ratio < limits.near_key_ratio) & ~((ratio > 0) & (ratio < limits.low_cardinality))
    return rows.select(
        "column_name", "date", (~F.col("number") & ~F.col("date") & F.coalesce("repeats", F.lit(False))).alias("dim"),
        (usable & ~F.col("whole")).alias("denominator"), (usable & ~F.col("rate")).alias("numerator"), usable.alias("mean_target"),
    )


def working_lists(table: DataFrame) -> WorkingLists:
    """The lists from ``roles_table``, which has a row per column."""
    rows = table.orderBy("column_name").collect()
    pick = lambda flag: [r["column_name"] for r in rows if r[flag]]
    return WorkingLists(pick("date"), pick("dim"), pick("denominator"), pick("numerator"), pick("mean_target"))


def extended_dims(df: DataFrame, lists: WorkingLists, target: str, limits: Thresholds = Thresholds()) -> list[str]:
    """Dimensions, numeric columns of few repeated values other than the target, and parts of dates."""
    numbers = [c for c in numeric_columns(df) if c != target]
    few = []
    if numbers:
        # what ``cardinality`` and ``repetition`` tell, from values that are counted once
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in numbers])).alias("p")).select("p.*")
        counts = long.groupBy("column_name", "v").agg(F.count("*").alias("k"))
        ratio = (F.count("v") / F.sum("k")).alias("distinct_ratio")
        known = F.when(F.col("v").isNotNull(), F.col("k"))
        often = F.sum(F.when(known >= limits.repeat_min_rows, known).otherwise(0)) / F.sum(known)
        rows = counts.groupBy("column_name").agg(ratio, (often >= limits.repeat_share).alias("repeats")).filter((F.col("distinct_ratio") < limits.low_cardinality) & F.col("repeats"))
        few = [r["column_name"] for r in rows.orderBy("column_name").collect()]
    return [*lists.dims, *few, *[f"{d}__{part}" for d in lists.dates for part in ("year", "month")]]


def with_date_parts(df: DataFrame, dates: Sequence[str]) -> DataFrame:
    """``<date>__year`` and ``<date>__month`` (yyyy-MM); a missing date has neither."""
    return df.withColumns({**{f"{d}__year": F.year(d) for d in dates}, **{f"{d}__month": F.date_format(d, "yyyy-MM") for d in dates}}) if dates else df


def year_column(df: DataFrame, dates: Sequence[str], configured: str = "") -> str:
    """SQL of the year: the configured column, or the year of the first date."""
    if configured:
        if configured not in df.columns:
            raise ValueError(f"year column {configured} is not in the table")
        return f"cast(`{configured}` as int)"
    if not dates:
        raise ValueError("no year column is configured and the table has no date")
    return f"year(`{dates[0]}`)"


def ratio_pairs(df: DataFrame, numerators: Sequence[str], denominators: Sequence[str], limits: Thresholds = Thresholds()) -> DataFrame:
    """(num, den, correlation, kept): pairs whose ratio would say little are not kept."""
    pairs = [(n, d) for n in numerators for d in denominators if n != d]
    found = rank_correlations(df, pairs)
    return found.select(F.col("a").alias("num"), F.col("b").alias("den"), F.col("rho").alias("correlation"), (~(F.coalesce(F.abs("rho"), F.lit(0.0)) >= limits.tautology_correlation)).alias("kept"))


def merged_classification(classes: dict[str, dict], leaks: DataFrame, notes: DataFrame) -> dict[str, dict]:
    """Classes of columns with what the data say: leaks of numeric columns override, notes on repeats are added.

    Both tables have a row per column at most.
    """
    out = {k: dict(v) for k, v in classes.items()}
    for r in leaks.collect():
        if out.get(r["column_name"], {}).get("role") == "numeric":
            out[r["column_name"]] |= {"leaks": r["leaks"], "correlation": None if r["correlation"] is None else round(r["correlation"], 4)}
    for r in notes.collect():
        if r["column_name"] in out:
            out[r["column_name"]]["note"] = " ".join(filter(None, [out[r["column_name"]].get("note", ""), r["note"]]))
    return out


def lists_from_classes(df: DataFrame, classes: dict[str, dict], target: str, limits: Thresholds = Thresholds()) -> tuple[WorkingLists, list[str]]:
    """Working lists with the classes taken into account, and where the data disagree with them about dimensions."""
    rates = [c for c, v in classes.items() if v.get("is_rate")]
    whole = [c for c, v in classes.items() if v.get("role") == "numeric" and v.get("can_divide") is False]
    table = roles_table(df, target, rates, whole, limits)
    lists = working_lists(table)
    said = {c for c, v in classes.items() if v.get("is_dimension") and c != target}
    return lists, [f"{c}: {'classified as a dimension' if c in said else 'not classified as a dimension'}, the data say otherwise" for c in sorted(said ^ set(lists.dims)) if c in df.columns]
