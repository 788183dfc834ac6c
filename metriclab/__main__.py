"""python -m metriclab discover | profile | prompts | ask QUESTION; settings come from METRICLAB_* variables."""

from __future__ import annotations

import argparse
import json
from pathlib import Path

from pyspark.sql import SparkSession

from . import language
from .operators import cleaning, profiling, roles
from .plans import report
from .plans.discovery import Options, discover
from .settings import Settings
from .sources import readers, sinks
from .text2sql.runner import ask


def profiles(df) -> list[dict]:
    """A slim profile per column."""
    kinds = {r["column_name"]: r["type_class"] for r in profiling.type_class(df).collect()}
    numbers = [c for c, k in kinds.items() if k == "numeric"]
    units = {r["column_name"]: r["unit_range"] for r in profiling.profile_numeric(df, numbers, approximate=True).collect()} if numbers else {}
    return [{"name": c, "type_class": k, "unit_range": units.get(c)} for c, k in kinds.items()]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="metriclab", description=__doc__)
    parser.add_argument("command", choices=["discover", "profile", "prompts", "diagnose", "ask"])
    parser.add_argument("question", nargs="?", default="")
    parser.add_argument("--trees", type=int, default=200)
    args = parser.parse_args(argv)
    settings = Settings.from_env()
    spark = SparkSession.builder.appName("metriclab").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    model = language.CachedModel(language.HttpModel(settings.model_url, settings.model_name), f"{settings.output_dir}/answers") if settings.model_url else None
    raw, entries, warnings = readers.validated(spark, settings.data_path, settings.dictionary(), settings.target)
    for w in warnings:
        print("warning:", w)
    df = cleaning.cleaned(raw, settings.thresholds).persist()
    out = Path(settings.output_dir)
    out.mkdir(parents=True, exist_ok=True)
    slim = profiles(df)
    if args.command == "profile":
        sinks.write_json(slim, str(out / "profile.json"))
        sinks.write_csv(cleaning.quality_report(df, settings.thresholds, exact=False), str(out / "quality"), single=True)
    elif args.command == "prompts":  # what a model would be asked about the first columns, without asking
        shown = language.ScriptedModel(lambda prompt: print(prompt) or "{}")
        language.classify(shown, [p for p in slim if p["type_class"] != "date"][:3], tries=1)
    elif args.command == "diagnose":  # three columns asked one by one, before a long run
        if model is None:
            parser.error("diagnosing needs METRICLAB_MODEL_URL")
        for row in language.diagnostic(model, [p for p in slim if p["type_class"] != "date"]):
            print(json.dumps(row))
    elif args.command == "ask":
        if model is None:
            parser.error("asking needs METRICLAB_MODEL_URL")
        sinks.write_table(df, settings.table_name, str((out / "table").absolute()))
        answer = ask(spark, model, args.question, settings.table_name, limits=settings.thresholds)
        print(answer.text, answer.sql, *answer.rows[:20], sep="\n")
    else:
        classes = language.classify(model, slim)[0] if model else language.without_model(slim)
        classes = roles.merged_classification(classes, roles.leakage(df, settings.target, limits=settings.thresholds), roles.duplicate_notes(roles.duplicate_columns(df, limits=settings.thresholds)))
        sinks.write_json(classes, str(out / "classes.json"))
        lists, odd = roles.lists_from_classes(df, classes, settings.target, settings.thresholds)
        print(*odd, sep="\n")
        wanted = language.proposed(model, [r.asDict() for r in entries.collect()], settings.target) if model else []
        year = roles.year_column(df, lists.dates, settings.year_column) if settings.year_column or lists.dates else None
        found = discover(df, settings.target, lists, wanted, year, Options(limits=settings.thresholds, trees=args.trees))
        records = report.readable(found, df, settings.target, lists.dates, entries, model, settings.thresholds)
        sinks.write_csv(found.ranking, str(out / "ranking"), single=True)
        sinks.write_json(records, str(out / "explained.json"))
        text, failed = report.script(found, records, settings.bi_table_name)
        sinks.write_script(text, str(out / "columns.csx"))
        print(json.dumps({"indicators": len(records), "without_formula": failed, "rejected": found.rejected, "held_out": found.errors}, default=str))


if __name__ == "__main__":
    main()
