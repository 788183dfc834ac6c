"""Cleaning: dates from text, white space, exact repeats; and reports of zeros and outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import once
from ..functions.stats import melted, quantiles
from ..settings import Thresholds

#: Texts that mean missing.
MISSING = ("", "nan", "None")
DATE_FORMAT = "dd/MM/yyyy"


def numeric_columns(df: DataFrame) -> list[str]:
    """Numbers without booleans, which are categories."""
    return [n for n, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")]


def text_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t == "string"]


def date_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t in ("date", "timestamp", "timestamp_ntz")]


def parsed_date(column: str | Column) -> Column:
    """Strict day/month/year; NULL if the trimmed text is anything else."""
    text = F.trim(F.col(column) if isinstance(column, str) else column)
    return F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(text, F.lit("d/M/yyyy"))).cast("date")


def date_candidates(df: DataFrame) -> list[str]:
    return [c for c in text_columns(df) if "DATE" in c.upper()]


def promote_dates(df: DataFrame, limits: Thresholds = Thresholds()) -> tuple[DataFrame, dict[str, int]]:
    """Text columns named after dates become dates if more than the given share parses; and the values that this nulls."""
    names = date_candidates(df)
    if not names:
        return df, {}
    counts = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(names)], *[F.count(parsed_date(c)).alias(f"d{i}") for i, c in enumerate(names)]).first()
    taken = {c: counts[f"n{i}"] - counts[f"d{i}"] for i, c in enumerate(names) if counts[f"n{i}"] and counts[f"d{i}"] / counts[f"n{i}"] > limits.date_parse_share}
    return df.withColumns({c: parsed_date(c) for c in taken}), taken


def normalised(column: str | Column) -> Column:
    """Trimmed, with every run of white space as one space; texts that mean missing become NULL."""
    c = F.col(column) if isinstance(column, str) else column
    text = F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    return F.when(~text.isin(*MISSING), text)


def clean_whitespace(df: DataFrame) -> DataFrame:
    return df.withColumns({c: normalised(c) for c in text_columns(df)}) if text_columns(df) else df


def whitespace_audit(df: DataFrame) -> DataFrame:
    """(column_name, modified): values whose text changes, those that become missing included."""
    names = text_columns(df)
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("v")) for c in names])).alias("p")).select("p.*")
    return rows.groupBy("column_name").agg(F.sum((F.col("v").isNotNull() & ~F.col("v").eqNullSafe(normalised("v"))).cast("long")).alias("modified"))


def dedup_rows(df: DataFrame) -> DataFrame:
    """One of each set of rows that are equal in all columns, nulls equal."""
    return df.dropDuplicates()


def cleaned(df: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """White space, then dates, then repeats."""
    return dedup_rows(promote_dates(clean_whitespace(df), limits)[0])


def zero_heavy(df: DataFrame, columns: Sequence[str] | None = None, limits: Thresholds = Thresholds()) -> DataFrame:
    """(column_name, zero_share) of numeric columns with many exact zeros among their values."""
    long = melted(df, columns or numeric_columns(df))
    shares = long.groupBy("column_name").agg(F.avg((F.col("v") == 0).cast("double")).alias("zero_share"))
    return shares.filter(F.col("zero_share") >= limits.zero_share)


def iqr_outliers(df: DataFrame, columns: Sequence[str] | None = None, limits: Thresholds = Thresholds(), exact: bool = True) -> DataFrame:
    """Counts and bounds of columns with values far outside their quartiles; a row per column that has any."""
    long = once(melted(df, columns or numeric_columns(df)).filter("v is not null"), "long")
    stats = quantiles(long, ["column_name"], "v", {"q1": 0.25, "q3": 0.75}, exact).withColumnsRenamed({"least": "min_value", "most": "max_value"})
    spread = F.col("q3") - F.col("q1")
    stats = stats.filter((F.col("n") >= limits.outlier_min_rows) & (spread != 0)).withColumns({"lower": F.col("q1") - limits.outlier_spread * spread, "upper": F.col("q3") + limits.outlier_spread * spread})
    rows = long.join(F.broadcast(stats), "column_name")  # a row per column of the table
    outside = F.sum(((F.col("v") < F.col("lower")) | (F.col("v") > F.col("upper"))).cast("long"))
    found = rows.groupBy("column_name", "n", "lower", "upper", "min_value", "max_value").agg(outside.alias("outliers"))
    return found.filter("outliers > 0").select("column_name", "outliers", (F.col("outliers") / F.col("n")).alias("outlier_share"), "lower", "upper", "min_value", "max_value")


def quality_report(df: DataFrame, limits: Thresholds = Thresholds(), exact: bool = True) -> DataFrame:
    """(column_name, issue, share) of both detectors."""
    zeros = zero_heavy(df, limits=limits).select("column_name", F.lit("zeros").alias("issue"), F.col("zero_share").alias("share"))
    outliers = iqr_outliers(df, limits=limits, exact=exact).select("column_name", F.lit("outliers").alias("issue"), F.col("outlier_share").alias("share"))
    return zeros.unionByName(outliers)
