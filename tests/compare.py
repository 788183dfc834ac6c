"""Run queries and their DuckDB counterparts side by side: python tests/compare.py SF_DIR [NAME...]"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

ROOT = str(Path(__file__).resolve().parent.parent)


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(os.listdir(sf_dir)):
        if file.endswith(".parquet"):
            path = f"{sf_dir}/{file}" + ("/*.parquet" if os.path.isdir(f"{sf_dir}/{file}") else "")
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    """Values of either engine in one form, doubles to 9 significant digits."""
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float) or type(value).__name__ == "Decimal":
        value = float(value)
        return "nan" if math.isnan(value) else float(f"{value:.9g}") + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if type(value).__name__ in ("datetime", "date", "Timestamp"):
        return str(value)[:10] if str(value)[10:] in ("", " 00:00:00") else str(value)
    return value


def rows_of(names, rows) -> list:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty if both give the same rows."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    want = rows_of(names, found.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows and {len(want)}"
    return next((f"{a} and {b}" for a, b in zip(got, want) if a != b), "")


if __name__ == "__main__":
    sys.path[:0] = [ROOT]
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry  # noqa: E402

    session = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    names, sqls = sys.argv[2:] or list(entry.queries()), entry.oracle_sql()
    for name in names:
        began = time.time()
        try:
            if name in sqls:
                said = difference(session, connection(sys.argv[1]), entry.queries()[name], sqls[name], sys.argv[1]) or "same"
            else:
                said = f"{entry.queries()[name](session, sys.argv[1]).count()} rows, no SQL"
        except Exception as e:  # a report of all queries shouldn't end at the first
            said = f"FAILED {type(e).__name__}: {str(e)[:600]}"
        print(f"{name}: {said[:900]} ({time.time() - began:.1f} s)", flush=True)
