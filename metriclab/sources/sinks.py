"""Writing results."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """A folder of CSV files with headers; one file where the result is small and ``single`` is asked for."""
    (df.coalesce(1) if single else df).write.mode("overwrite").csv(path, header=True)


def write_json(value: DataFrame | dict | list, path: str) -> None:
    """A table as JSON lines, or a small driver-side value as one document."""
    if isinstance(value, DataFrame):
        value.write.mode("overwrite").json(path)
    else:
        Path(path).write_text(json.dumps(value, ensure_ascii=False, indent=2, default=str), encoding="utf-8")


def write_table(df: DataFrame, name: str, path: str = "") -> None:
    """The cleaned table saved under a name for SQL; it replaces the last.  With ``path`` its files lie there."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def write_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """A table in folders by the columns ``by``; a rerun replaces the partitions that ``df`` has rows of, and no others.

    Rows are rebalanced by the columns first, so a partition gets few files and a large one is
    written by many tasks.  The files of a run appear when all its tasks are done; a run that
    is repeated leaves the same rows.  No rows change nothing.
    """
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_excel(rows: list[dict[str, Any]], path: str, sheet: str = "Ranking", styled: bool = True) -> None:
    """A small result with a bold header and wide columns, where a writer for Excel is installed."""
    import pandas as pd

    with pd.ExcelWriter(path) as writer:
        frame = pd.DataFrame(rows)
        frame.to_excel(writer, sheet_name=sheet, index=False)
        if styled and writer.engine == "openpyxl":
            from openpyxl.styles import Font
            from openpyxl.utils import get_column_letter

            page = writer.sheets[sheet]
            for i, name in enumerate(frame.columns, 1):
                page.cell(1, i).font = Font(bold=True)
                page.column_dimensions[get_column_letter(i)].width = min(60, max(12, len(str(name)) + 4))
            page.freeze_panes = "A2"


def write_script(text: str, path: str) -> None:
    Path(path).write_text(text, encoding="utf-8")
