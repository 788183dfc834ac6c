"""JSON columns as typed values: every key of every row, a profile of the keys, and columns for the frequent ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import once


def leaves(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., path, value, kind): a row for every key of every row whose value is no object or list.

    ``path`` joins keys by dots and has ``[]`` for the items of a list; ``kind`` is the type of the
    value, VOID for a JSON null.  Text that is no JSON, and a null, give no rows; empty objects and
    lists have no leaves.  Levels are opened one by one, so nesting of any depth is read.
    """
    kept = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)]
    names = [f"_k{i}" for i in range(len(keep))]
    front = df.select(*kept, F.lit("").alias("path"), F.try_parse_json(column).alias("v")).filter("v IS NOT NULL")
    found = []
    while True:
        opened = front.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer()))
        step = F.when(F.col("key").isNull(), F.concat("path", F.lit("[]"))).when(F.col("path") == "", F.col("key")).otherwise(F.concat("path", F.lit("."), "key"))
        level = once(opened.select(*names, step.alias("path"), F.col("value").alias("v"), F.regexp_replace(F.schema_of_variant("value"), r"[(<].*", "").alias("kind")), "keys")
        found.append(level.filter("kind NOT IN ('OBJECT', 'ARRAY')"))
        front = level.filter("kind IN ('OBJECT', 'ARRAY')").drop("kind")
        if front.isEmpty():
            break
    rows = reduce(DataFrame.unionByName, found)
    return rows.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "path", F.col("v").alias("value"), "kind")


def key_profile(df: DataFrame, column: str) -> DataFrame:
    """(path, n, n_null, n_distinct, kinds, least, most): a row for each path; ``least`` and ``most`` are of its numbers."""
    rows = leaves(df, column)
    null, number = F.col("kind") == "VOID", F.when(F.col("kind").isin("BIGINT", "DECIMAL", "DOUBLE"), F.try_variant_get("value", "$", "double"))
    found = rows.groupBy("path").agg(
        F.count("*").alias("n"), F.count_if(null).alias("n_null"), F.count_distinct(F.when(~null, F.col("value").cast("string"))).alias("n_distinct"),
        F.array_join(F.array_sort(F.collect_set(F.when(~null, F.col("kind")))), ",").alias("kinds"), F.min(number).alias("least"), F.max(number).alias("most"),
    )
    return found


#: What a kind of value becomes as a column.
TYPES = {"BIGINT": "bigint", "DECIMAL": "double", "DOUBLE": "double", "BIGINT,DECIMAL": "double", "BOOLEAN": "boolean", "STRING": "string"}


def with_frequent_keys(df: DataFrame, column: str, share: float = 0.5, prefix: str = "") -> DataFrame:
    """``df`` with a typed column, named by the path, for every path outside lists that ``share`` of the rows have.

    Values of several kinds, or of a kind without a column type, become text; a value that doesn't
    fit is a null.  A name that ``df`` has already is replaced.
    """
    profile = key_profile(df, column).filter(~F.contains("path", F.lit("[]"))).collect()  # a row per path
    n = df.count()
    v = F.try_parse_json(column)
    wanted = {r["path"]: TYPES.get(r["kinds"], "string") for r in sorted(profile, key=lambda r: r["path"]) if n and r["n"] / n >= share}
    return df.withColumns({prefix + p: F.try_variant_get(v, "$" + "".join(f"['{k}']" for k in p.split(".")), kind) for p, kind in wanted.items()})
