"""Reading observation tables and data dictionaries."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

#: A dictionary line: a name, maybe a comma, maybe two dashes and a definition.
LINE = r"^\s*([A-Za-zÀ-ÿ_][\wÀ-ÿ]*)\s*,?\s*(?:--\s*(.*?))?\s*$"


class InputError(ValueError):
    """The input cannot be used; the message says why."""


def read_table(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """A flat table by its suffix: Parquet, ORC, CSV, JSON lines, or Excel where a reader for it is installed."""
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix in ("xlsx", "xls"):
        try:
            import pandas as pd

            return spark.createDataFrame(pd.read_excel(path, sheet_name=sheet))
        except ImportError as e:
            raise InputError(f"reading {path} needs an Excel reader: {e}") from e
    if suffix == "csv":
        return spark.read.csv(path, header=True, inferSchema=True)
    if suffix in ("json", "jsonl"):
        return spark.read.json(path)
    return spark.read.orc(path) if suffix == "orc" else spark.read.parquet(path)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is NULL only: NaN and infinities of floating columns become NULL."""
    return df.select(*[F.when(F.isnan(n) | (F.abs(F.col(n)) == float("inf")), None).otherwise(F.col(n)).alias(n) if t in ("double", "float") else F.col(n) for n, t in df.dtypes])


def folded(text: str) -> str:
    """Lower case without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def dictionary_columns(columns: list[str]) -> tuple[str, str]:
    """Name and definition column by their headers; by position where none fits."""
    if len(columns) < 2:
        raise InputError("a dictionary needs two columns")
    name = next((c for c in columns if any(w in folded(c) for w in ("nom", "champ", "colonne", "name", "field", "column"))), columns[0])
    rest = [c for c in columns if c != name]
    definition = next((c for c in rest if any(w in folded(c) for w in ("defini", "description"))), rest[0])
    return name, definition


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """(line, name, definition, recognised) of dictionary text; white space in definitions is collapsed."""
    found = F.regexp_extract(column, LINE, 1)
    text = F.trim(F.regexp_replace(F.regexp_extract(column, LINE, 2), r"(?U)\s+", " "))
    return lines.filter(F.trim(column) != "").select(F.col(column).alias("line"), found.alias("name"), text.alias("definition"), (found != "").alias("recognised"))


def cleaned_entries(entries: DataFrame, name: Column, definition: Column) -> DataFrame:
    """(name, definition): trimmed; blank and "nan" names go, a missing definition is empty."""
    rows = entries.select(F.trim(name).alias("name"), F.coalesce(F.trim(definition), F.lit("")).alias("definition"))
    return rows.filter(F.col("name").isNotNull() & ~F.lower("name").isin("", "nan"))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(name, definition) from a text, CSV or Excel dictionary."""
    if path.lower().endswith(".txt"):
        rows = parse_lines(spark.read.text(path)).filter("recognised")
        return cleaned_entries(rows, F.col("name"), F.col("definition"))
    table = read_table(spark, path)
    name, definition = dictionary_columns(table.columns)
    return cleaned_entries(table, F.col(name).cast("string"), F.col(definition).cast("string"))


def duplicate_names(entries: DataFrame) -> DataFrame:
    """(name, n) of names defined more than once."""
    return entries.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1")


def validated(spark: SparkSession, data_path: str, dictionary_path: str, target: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """Table, dictionary and warnings; what makes the input unusable raises ``InputError``."""
    try:
        df = read_table(spark, data_path)
    except AnalysisException as e:
        raise InputError(f"cannot read {data_path}: {e}") from e
    if df.isEmpty():
        raise InputError(f"{data_path} has no rows")
    if target not in df.columns:
        raise InputError(f"target column {target} is not in {data_path}")
    if not dictionary_path:
        raise InputError("no dictionary found")
    try:
        entries = read_dictionary(spark, dictionary_path)
        known = {r["name"] for r in entries.select("name").collect()}
    except AnalysisException as e:
        raise InputError(f"cannot read {dictionary_path}: {e}") from e
    return nan_to_null(df), entries, [f"column {c} has no definition" for c in df.columns if c not in known]
