"""Questions in words: SQL from a model, checked, run, repaired, and put back into words."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession

from ..language import LanguageModel
from ..settings import Thresholds
from .guard import RefusedQuery, checked, stripped

DIALECT = "Spark SQL: use div for whole division, try_divide where a divisor may be 0, ILIKE to ignore case, year() and date_format() on dates, backticks around names."


@dataclass
class Answer:
    question: str
    sql: str = ""
    columns: list[str] = field(default_factory=list)
    rows: list[Row] = field(default_factory=list)
    text: str = ""
    errors: list[str] = field(default_factory=list)


def schema_text(df: DataFrame, table: str, samples: int = 3) -> str:
    """Columns with types, and a few rows, for the prompt."""
    lines = [f"table {table}:", *(f"  {n} {t}" for n, t in df.dtypes)]
    return "\n".join([*lines, "rows:", *("  " + str(tuple(r)) for r in df.limit(samples).collect())])


def examples_text(examples: Sequence[tuple[str, str]]) -> str:
    return "".join(f"Question: {q}\nSQL: {s}\n" for q, s in examples)


def limited(spark: SparkSession, sql: str, tables: Sequence[str], limits: Thresholds = Thresholds(), strict_keywords: bool = False) -> DataFrame:
    """The checked statement's rows, at most as many as the settings allow; the limit is on the plan, not in the text."""
    return spark.sql(checked(spark, sql, tables, strict_keywords)).limit(limits.sql_rows)


def ask(spark: SparkSession, model: LanguageModel, question: str, table: str, examples: Sequence[tuple[str, str]] = (), limits: Thresholds = Thresholds(), strict_keywords: bool = False) -> Answer:
    """An answer with its SQL and rows.  A refused or failing statement goes back to the model with the error."""
    out = Answer(question)
    schema = schema_text(spark.table(table), table)
    prompt = f"{DIALECT}\n{schema}\n{examples_text(examples)}Write one SELECT for the question. Reply with SQL only.\nQuestion: {question}\nSQL:"
    for _ in range(1 + limits.sql_repairs):
        out.sql = stripped(model.complete(prompt, 0.0))
        try:
            df = limited(spark, out.sql, [table], limits, strict_keywords)
            out.columns, out.rows = df.columns, df.collect()
            break
        except (RefusedQuery, PySparkException) as e:
            out.errors.append(str(e)[:500])
            prompt = f"{DIALECT}\n{schema}\nThis SQL failed.\nSQL: {out.sql}\nError: {out.errors[-1]}\nWrite it anew for the question: {question}\nSQL:"
    else:
        out.text = "The question could not be answered: " + out.errors[-1]
        return out
    shown = "\n".join(str(tuple(r)) for r in out.rows[:20])
    out.text = model.complete(f"Answer in one sentence from the rows.\nQuestion: {question}\nColumns: {out.columns}\nRows:\n{shown}\nAnswer:", 0.0).strip()
    return out
