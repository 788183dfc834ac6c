"""A finished ranking for readers: formula, effect, definitions and one text for each indicator."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..language import LanguageModel, explained
from ..operators.candidates import long_form
from ..operators.effects import quartile_effects
from ..operators.roles import with_date_parts
from ..settings import Thresholds
from .discovery import Discovery
from .export import bi_script


def readable(discovery: Discovery, df: DataFrame, target: str, dates: list[str], entries: DataFrame | None = None, model: LanguageModel | None = None, limits: Thresholds = Thresholds(), exact: bool = False) -> list[dict[str, Any]]:
    """A record per ranked indicator; all effects come from one job over the long form."""
    rows = [r.asDict() for r in discovery.ranking.collect()]
    chosen = [discovery.candidates[r["cand"]] for r in rows]
    if not chosen:
        return []
    long = long_form(with_date_parts(df, dates), chosen, [F.col(target).cast("double").alias("y")], limits)
    effects = {r["cand"]: r.asDict() for r in quartile_effects(long, exact=exact).collect()}
    definitions = {r["name"]: r["definition"] for r in entries.collect()} if entries is not None else {}
    out = []
    for r, c in zip(rows, chosen):
        facts = {"name": c.label(), "formula": c.describe(), "definitions": {i: definitions.get(i, "") for i in c.inputs()}, "scores": r, "effect": effects.get(c.label())}
        out.append({**r, "formula": c.describe(), "effect": effects.get(c.label()), "explanation": explained(model, facts)})
    return out


def script(discovery: Discovery, records: list[dict[str, Any]], table: str) -> tuple[str, list[str]]:
    """The BI script of the ranked indicators."""
    return bi_script([discovery.candidates[r["cand"]] for r in records], [r["cand"] for r in records], table)
