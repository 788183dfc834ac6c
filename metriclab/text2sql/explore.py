"""Looking at a table: its size, columns, first rows, and a search."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def columns(df: DataFrame) -> list[tuple[str, str]]:
    return df.dtypes


def preview(df: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in an order that is total, so that it is the same each time."""
    return df.orderBy(*order).limit(n)


def search(df: DataFrame, column: str, text: str) -> DataFrame:
    """Rows whose column holds the text in any case; the text is taken literally."""
    return df.filter(F.contains(F.lower(F.col(column).cast("string")), F.lit(text.lower())))


def data_version(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes, files and last change of a table's folder or file, from the store that holds it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    size = files.getContentSummary(at)
    return size.getLength(), size.getFileCount(), files.getFileStatus(at).getModificationTime()


class Previews:
    """First rows of tables, kept until the data change: a repeated look reads only the folder's status."""

    def __init__(self, spark: SparkSession, most: int = 100):
        self.spark, self.most, self.reads = spark, most, 0
        self._kept: dict[tuple, tuple[tuple, list[Row]]] = {}

    def rows(self, path: str, order: list[str], n: int = 10) -> list[Row]:
        """The first ``n`` rows of the Parquet table at ``path``; the oldest of over ``most`` previews goes."""
        key, version = (path, tuple(order), n), data_version(self.spark, path)
        if self._kept.get(key, (None,))[0] != version:
            self.reads += 1
            self._kept.pop(key, None)
            self._kept[key] = version, preview(self.spark.read.parquet(path), order, n).collect()
            while len(self._kept) > self.most:
                self._kept.pop(next(iter(self._kept)))
        return self._kept[key][1]
