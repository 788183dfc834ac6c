"""The command line from a table to a ranking, without a model."""

from __future__ import annotations

import json
import random

from metriclab import __main__ as cli
from metriclab.operators import roles


def test_discover_and_profile(spark, tmp_path, monkeypatch, capsys):
    rnd = random.Random(9)
    rows = []
    for i in range(240):
        a, b, c = (rnd.randint(10, 150) / 10 for _ in range(3))
        rows.append((a, b, c, rnd.choice("uv"), f"{1 + i % 28:02d}/03/{2015 + i % 4}", 5 * a / b + rnd.gauss(0, 0.1)))
    spark.createDataFrame(rows, "a double, b double, c double, g string, DATE_D string, y double").withColumnRenamed("y", "result").write.parquet(str(tmp_path / "t.parquet"))
    (tmp_path / "d.txt").write_text("a -- first\nb -- second\nresult -- target\n", encoding="utf-8")
    for k, v in {"DATA_PATH": tmp_path / "t.parquet", "DICTIONARY_PATH": tmp_path / "d.txt", "TARGET": "result", "OUTPUT_DIR": tmp_path / "out"}.items():
        monkeypatch.setenv(f"METRICLAB_{k}", str(v))
    cli.main(["profile"])
    assert {p["name"]: p["type_class"] for p in json.loads((tmp_path / "out/profile.json").read_text())}["DATE_D"] == "date"
    cli.main(["prompts"])
    cli.main(["discover", "--trees", "3"])
    assert "indicators" in capsys.readouterr().out and "Model.Tables" in (tmp_path / "out/columns.csx").read_text()


def test_classes_take_what_the_data_say(spark):
    df = spark.createDataFrame([(float(i), float(i), "g") for i in range(30)], "y double, x double, t string")
    classes = {"x": {"role": "numeric", "note": "n"}, "t": {"role": "categorical", "is_dimension": False}}
    merged = roles.merged_classification(classes, roles.leakage(df, "y"), roles.duplicate_notes(roles.duplicate_columns(df)))
    assert merged["x"] == {"role": "numeric", "note": "n repeats y", "leaks": True, "correlation": 1.0}
    lists, odd = roles.lists_from_classes(df, merged, "y")
    assert lists.dims == ["t"] and odd == ["t: not classified as a dimension, the data say otherwise"]
