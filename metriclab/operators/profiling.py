"""Profiles of columns and of the dictionary's cover of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import melted
from .cleaning import date_columns, numeric_columns


def coverage(entries: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(name, side): names only in the dictionary, and columns only in the data."""
    data = entries.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in columns])).alias("name"))
    only_dictionary = entries.select("name").distinct().join(data, "name", "left_anti").withColumn("side", F.lit("dictionary"))
    return only_dictionary.unionByName(data.join(entries, "name", "left_anti").withColumn("side", F.lit("data")))


def _counts(long: DataFrame, approximate: bool) -> list:
    distinct = F.approx_count_distinct("v") if approximate else F.count_distinct("v")
    return [
        (F.lit(100.0) * (F.count("*") - F.count("v")) / F.count("*")).alias("missing_pct"),
        distinct.alias("n_distinct"), (distinct / F.count("*")).alias("distinct_ratio"),
    ]


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Missing, distinct, bounds, mean and whether all values lie in [0, 1], a row per column."""
    long = melted(df, columns or numeric_columns(df))
    return long.groupBy("column_name").agg(
        *_counts(long, approximate), F.min("v").alias("min_value"), F.max("v").alias("max_value"), F.avg("v").alias("mean_value"),
        F.coalesce(F.bool_and(F.col("v").between(0, 1)), F.lit(False)).alias("unit_range"),
    )


def _long_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("v")) for c in columns])).alias("p")).select("p.*")


def profile_categorical(df: DataFrame, columns: Sequence[str] | None = None, samples: int = 5, approximate: bool = False) -> DataFrame:
    """Missing, distinct and the first ``samples`` values in order, a row per column.

    A full set of values isn't gathered: distinct values are ranked per column and the first few kept.
    """
    from pyspark.sql import Window

    long = _long_text(df, columns or [n for n, t in df.dtypes if t in ("string", "boolean")])
    counts = long.groupBy("column_name").agg(*_counts(long, approximate))
    first = long.filter("v is not null").distinct().withColumn("k", F.row_number().over(Window.partitionBy("column_name").orderBy("v"))).filter(F.col("k") <= samples)
    first = first.groupBy("column_name").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "v"))), lambda x: x["v"]), "|").alias("sample_values"))
    return counts.join(first, "column_name", "left")


def profile_dates(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Missing, distinct, first and last day, a row per column."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("timestamp_ntz").alias("v")) for c in columns or date_columns(df)])).alias("p")).select("p.*")
    return long.groupBy("column_name").agg(*_counts(long, approximate), F.date_format(F.min("v"), "yyyy-MM-dd").alias("min_date"), F.date_format(F.max("v"), "yyyy-MM-dd").alias("max_date"))


def type_class(df: DataFrame) -> DataFrame:
    """(column_name, type_class): date, numeric, text, or empty where no value is present."""
    kinds = {n: "numeric" for n in numeric_columns(df)} | {n: "date" for n in date_columns(df)}
    counts = df.agg(*[F.count(f"`{c}`").alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.when(F.col(f"`{c}`") == 0, "empty").otherwise(kinds.get(c, "text")).alias("type_class")) for c in df.columns])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def enrich(entries: DataFrame, profile: DataFrame) -> DataFrame:
    """The dictionary with each column's profile; ``error`` says where the column is absent."""
    joined = entries.join(profile.withColumn("_there", F.lit(True)), entries["name"] == profile["column_name"], "left")
    return joined.withColumn("error", F.when(F.col("_there").isNull(), "column absent from the data")).drop("column_name", "_there")
