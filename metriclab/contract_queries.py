"""Queries over the parts that don't score: files, dictionaries, roles, proposals, names, contracts with a model, questions.

Where a part works on data, its SQL reads the tables; where it works on a few given
values, its SQL lists what must come out.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language
from .functions.scratch import once, shared_dir
from .operators import candidates as C
from .operators import cleaning, importance, profiling, roles
from .plans import export
from .queries import ORACLES, QUERIES, _NORM, DICTIONARY, DICTIONARY_SQL, DIRTY_SQL, FLAT_SQL, LEAKY_NAMES, LEAKY_SQL, PROPOSALS, SCORED, TARGET, CORR_SQL, _LEAK_PAIRS, dirty, entries, flat, guided, leaky, rank_sql, register, rounded, table
from .settings import Settings, Thresholds
from .sources import readers, sinks
from .text2sql import runner
from .text2sql.guard import RefusedQuery, checked, stripped


def values(rows: list[tuple], names: str) -> str:
    """A SELECT of literal rows."""
    literal = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(literal, r)) + ')' for r in rows)}) AS t({names})"


def rows_of(spark: SparkSession, rows: list[tuple[Any, ...]], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def fresh(spark: SparkSession, suffix: str) -> str:
    return f"{shared_dir(spark)}/files-{uuid.uuid4().hex}{suffix}"


# --- sources and sinks --------------------------------------------------------------------------------------------


@register("settings_from_env", values([("target", "y"), ("data_path", "/d/t.parquet"), ("output_dir", "output"), ("veto", "0.1")], "name, value"))
def _(spark, sf_dir):
    found = Settings.from_env({"METRICLAB_TARGET": "y", "METRICLAB_DATA_PATH": "/d/t.parquet", "OTHER": "z"})
    return rows_of(spark, [("target", found.target), ("data_path", found.data_path), ("output_dir", found.output_dir), ("veto", str(found.thresholds.veto))], "name string, value string")


@register("dictionary_path_found", values([("both", "dictionary.csv"), ("text only", "dictionary.txt"), ("none", ""), ("given", "/x/own.csv")], "folder, path"))
def _(spark, sf_dir):
    out = []
    for folder, files in (("both", ["dictionary.txt", "dictionary.csv"]), ("text only", ["dictionary.txt"]), ("none", [])):
        with tempfile.TemporaryDirectory() as at:  # the driver looks beside the data
            for f in files:
                Path(at, f).write_text("a, -- b")
            out.append((folder, Path(Settings(data_path=f"{at}/t.parquet").dictionary()).name if files else Settings(data_path=f"{at}/t.parquet").dictionary()))
    return rows_of(spark, [*out, ("given", Settings(dictionary_path="/x/own.csv").dictionary())], "folder string, path string")


@register("header_detection", values([("Nom du champ|Définition", "Nom du champ", "Définition"), ("#|Description|Colonne", "Colonne", "Description"), ("a|b", "a", "b"), ("x|Field|y", "Field", "x")], "header, name, definition"))
def _(spark, sf_dir):
    listed = ["Nom du champ|Définition", "#|Description|Colonne", "a|b", "x|Field|y"]
    return rows_of(spark, [(h, *readers.dictionary_columns(h.split("|"))) for h in listed], "header string, name string, definition string")


@register("dictionary_reader", f"WITH {DICTIONARY_SQL} SELECT 'text' AS form, name, definition FROM entries UNION ALL SELECT 'csv', name, definition FROM entries")
def _(spark, sf_dir):
    text, csv = fresh(spark, ".txt"), fresh(spark, ".csv")
    spark.createDataFrame([(x,) for x in DICTIONARY], "value string").coalesce(1).write.text(text)
    entries(spark).select(F.col("definition").alias("Définition"), F.col("name").alias("Nom")).write.csv(csv, header=True)
    read = lambda form, path: readers.read_dictionary(spark, path).select(F.lit(form).alias("form"), "name", "definition")
    return read("text", text).unionByName(read("csv", csv))


_ENTRY_NAMES = ["o_orderkey", "o_custkey"]


@register("input_validation", "SELECT 'column ' || column_name || ' has no definition' AS message FROM (DESCRIBE SELECT * FROM orders) WHERE column_name NOT IN ('o_orderkey', 'o_custkey') UNION ALL " + values([("target column nowhere is not in the table",), ("no dictionary found",)], "message"))
def _(spark, sf_dir):
    data, text = f"{sf_dir}/orders.parquet", fresh(spark, ".txt")
    spark.createDataFrame([(f"{n}, -- some text",) for n in _ENTRY_NAMES], "value string").write.text(text)
    messages = readers.validated(spark, data, text, "o_totalprice")[2]
    for path, target in ((text, "nowhere"), ("", "o_totalprice")):
        try:
            readers.validated(spark, data, path, target)
        except readers.InputError as e:
            messages.append(str(e).replace(data, "the table"))
    return rows_of(spark, [(m,) for m in messages], "message string")


def _back(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    if kind == "table":
        name = f"saved_{uuid.uuid4().hex}"
        sinks.write_table(rows, name, fresh(spark, ".table"))
        return spark.table(name)
    path = fresh(spark, f".{kind}")
    (sinks.write_csv if kind == "csv" else sinks.write_json)(rows, path)
    found = readers.read_table(spark, path)
    return found.select(*[F.col(c).cast(t).alias(c) for c, t in rows.dtypes])


for _kind in ("csv", "json", "table"):
    register(f"sink_{_kind}", "SELECT * FROM customer")(lambda spark, sf_dir, kind=_kind: _back(spark, sf_dir, kind))


# --- cleaning, roles ----------------------------------------------------------------------------------------------

_DAY_SQL = "strftime(try_strptime(trim(ORDERDATE_TEXT), '%d/%m/%Y'), '%Y-%m-%d')"


@register("clean_pipeline", f"WITH {DIRTY_SQL}, twice AS (SELECT * FROM dirty UNION ALL SELECT * FROM dirty WHERE l_orderkey % 50 = 0) SELECT DISTINCT l_orderkey, l_linenumber, {_NORM.format(c='segment')} AS segment, {_NORM.format(c='brand')} AS brand, quantity, {_DAY_SQL} AS day, tax_or_zero, price_tail FROM twice")
def _(spark, sf_dir):
    df = dirty(spark, sf_dir)
    out = cleaning.cleaned(df.unionByName(df.filter("l_orderkey % 50 = 0")))
    return out.withColumn("day", F.date_format("ORDERDATE_TEXT", "yyyy-MM-dd")).drop("ORDERDATE_TEXT")


@register("date_split", values([("o_orderkey", "numeric"), ("o_custkey", "numeric"), ("o_orderstatus", "text"), ("o_totalprice", "numeric"), ("o_orderdate", "date"), ("o_orderpriority", "text"), ("nothing", "empty")], "column_name, type_class"))
def _(spark, sf_dir):
    return profiling.type_class(table(spark, sf_dir, "orders").withColumn("nothing", F.lit(None).cast("string")))


_LEAK_SQL = f"p AS ({_LEAK_PAIRS}), r AS (SELECT column_name, {rank_sql('a', 'column_name')} AS ra, {rank_sql('b', 'column_name')} AS rb FROM p WHERE a IS NOT NULL AND b IS NOT NULL), leak AS (SELECT column_name, {CORR_SQL} AS rho FROM r GROUP BY column_name UNION ALL SELECT '{TARGET}', 1.0)"
_DUP_SQL = "dp AS (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, CAST({a} AS DOUBLE) AS ra, CAST({b} AS DOUBLE) AS rb FROM leaky" for i, a in enumerate(sorted(LEAKY_NAMES)) for b in sorted(LEAKY_NAMES)[i + 1 :]) + f"), dup AS (SELECT a, b FROM dp GROUP BY a, b HAVING abs({CORR_SQL}) >= 0.98), note AS (SELECT column_name, 'repeats ' || string_agg(other, ', ' ORDER BY other) AS note FROM (SELECT a AS column_name, b AS other FROM dup UNION ALL SELECT b, a FROM dup) GROUP BY column_name)"


@register("classification_merge", f"WITH {LEAKY_SQL}, {_LEAK_SQL}, {_DUP_SQL} SELECT column_name, abs(rho) >= 0.9 AS leaks, round(rho, 3) AS correlation, coalesce(note, '') AS note FROM leak LEFT JOIN note USING (column_name) UNION ALL SELECT 'some_text', NULL, NULL, ''")
def _(spark, sf_dir):
    df = once(leaky(spark, sf_dir), "leaky")  # joined once for both
    classes = {n: {"role": "numeric", "note": ""} for n in LEAKY_NAMES} | {"some_text": {"role": "categorical", "note": ""}}
    found = roles.merged_classification(classes, roles.leakage(df, TARGET, write=False), roles.duplicate_notes(roles.duplicate_columns(df, write=False)))
    rows = [(k, v.get("leaks"), v.get("correlation"), v["note"]) for k, v in found.items()]
    return rounded(rows_of(spark, rows, "column_name string, leaks boolean, correlation double, note string"), 3)


@register("year_resolution", "SELECT 'first date' AS rule, year(o_orderdate)::INTEGER AS year, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'configured', o_custkey::INTEGER, count(*) FROM orders GROUP BY ALL")
def _(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    by = lambda rule, configured: df.groupBy(F.lit(rule).alias("rule"), F.expr(roles.year_column(df, ["o_orderdate"], configured)).alias("year")).agg(F.count("*").alias("n"))
    return by("first date", "").unionByName(by("configured", "o_custkey"))


_FEW = [c for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "o_totalprice", "c_acctbal", "p_size", "p_retailprice")]


@register(
    "extended_dims",
    f"WITH {FLAT_SQL}, k AS (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS k FROM flat GROUP BY {c}" for c in _FEW) + "), s AS (SELECT column_name, count(*)::DOUBLE / sum(k) AS ratio, sum(CASE WHEN k >= 10 THEN k ELSE 0 END)::DOUBLE / sum(k) AS often FROM k GROUP BY column_name) "
    "SELECT column_name AS dim FROM s WHERE ratio < 0.3 AND often >= 0.8 UNION ALL " + values([("p_brand",), ("o_orderdate__year",), ("o_orderdate__month",)], "dim"),
)
def _(spark, sf_dir):
    lists = roles.WorkingLists(dates=["o_orderdate"], dims=["p_brand"])
    return rows_of(spark, [(d,) for d in roles.extended_dims(flat(spark, sf_dir).select(*_FEW, TARGET), lists, TARGET)], "dim string")


# --- candidates, proposals, names ---------------------------------------------------------------------------------

_N, _D, _DIMS, _T = ["a", "b", "c"], ["b", "d"], ["g", "h"], ["a", "d"]


@register(
    "exhaustive_union",
    "WITH n AS (SELECT unnest(['a', 'b', 'c']) AS n), d AS (SELECT unnest(['b', 'd']) AS d), g AS (SELECT unnest(['g', 'h']) AS g), t AS (SELECT unnest(['a', 'd']) AS t) "
    "SELECT 'ratio__' || n || '__over__' || d AS label FROM n, d WHERE n <> d AND NOT (n = 'c' AND d = 'd') UNION ALL SELECT 'mean__' || t || '__by__' || g FROM t, g UNION ALL SELECT 'count__by__' || g FROM g UNION ALL SELECT 'gap__x__minus__y'",
)
def _(spark, sf_dir):
    return rows_of(spark, [(c.label(),) for c in C.exhaustive(_N, _D, _DIMS, _T, ["x", "y"], [("c", "d")])], "label string")


@register("guided_plain", f"WITH {FLAT_SQL} SELECT l_orderkey, l_linenumber, l_tax AS domain__tax FROM flat")
def _(spark, sf_dir):
    return guided(spark, sf_dir, ["domain__tax"])


@register(
    "guided_proposals",
    values(
        [
            ("kept", "domain__price_per_unit_and_size", "ratio"), ("kept", "domain__tax", "plain"), ("kept", "domain__not_discounted", "complement"), ("kept", "domain__two_ratios", "sum"),
            ("rejected", "Not taxed", "values are neither shares nor percentages"), ("rejected", "Unknown", "unknown columns nowhere"), ("rejected", "Empty", "an empty side"),
        ], "verdict, name, detail",
    ),
)
def _(spark, sf_dir):
    df = flat(spark, sf_dir)
    good, bad = C.guided(df, PROPOSALS, df.columns, cleaning.numeric_columns(df), TARGET)
    return rows_of(spark, [("kept", c.label(), c.kind) for c in good] + [("rejected", n, why) for n, why in bad], "verdict string, name string, detail string")


_LISTED = [
    {"name": "One", "operation": "ratio", "numerator": ["a", "b"], "denominator": ["c"]}, {"name": "Same", "operation": "ratio", "numerator": ["b", "a"], "denominator": ["c"]}, {"name": "Turned", "operation": "ratio", "numerator": ["c"], "denominator": ["a", "b"]},
    {"name": "Odd", "operation": "power", "column": "a"}, {"name": "Aim", "operation": "plain", "column": "y"}, {"name": "Words", "operation": "plain", "column": "t"}, {"name": "Bare", "operation": "plain"},
    {"name": "Sum", "operation": "ratio_sum", "ratios": [{"numerator": ["a"], "denominator": ["b"]}, {"numerator": ["c"], "denominator": ["b"]}]}, {"name": "Sum turned", "operation": "ratio_sum", "ratios": [{"numerator": ["c"], "denominator": ["b"]}, {"numerator": ["a"], "denominator": ["b"]}]},
]


def _checked() -> tuple[list[dict], list[tuple[str, str]]]:
    return C.checked_proposals(_LISTED, ["a", "b", "c", "t", "y"], ["a", "b", "c", "y"], "y")


@register("proposal_validation", values([("Odd", "unknown operation power"), ("Aim", "uses the target"), ("Words", "not numeric: t"), ("Bare", "an empty side")], "name, reason"))
def _(spark, sf_dir):
    return rows_of(spark, [r for r in _checked()[1] if r[1] != "repeats another"], "name string, reason string")


@register("proposal_dedup", values([("One", True), ("Turned", True), ("Sum", True), ("Same", False), ("Sum turned", False)], "name, kept"))
def _(spark, sf_dir):
    good, bad = _checked()
    return rows_of(spark, [(p["name"], True) for p in good] + [(n, False) for n, why in bad if why == "repeats another"], "name string, kept boolean")


@register(
    "crossover_eligibility",
    "WITH r AS (SELECT * FROM (VALUES ('a', 'd'), ('b', 'd'), ('c', 'e')) AS t(n, d)) SELECT 'sum__ratio__' || x.n || '__over__' || x.d || '__and__ratio__' || y.n || '__over__' || y.d AS label FROM r x JOIN r y ON x.d = y.d AND x.n < y.n "
    "UNION ALL SELECT 'mean__ratio__' || n || '__over__' || d || '__by__' || g FROM r, (SELECT unnest(['g', 'e']) AS g) WHERE g <> n AND g <> d",
)
def _(spark, sf_dir):
    simple = [C.Candidate("ratio", ((n,), (d,))) for n, d in (("a", "d"), ("b", "d"), ("c", "e"))]
    other = [C.Candidate("count", ("g",)), C.Candidate("sum", (simple[0], simple[1]))]  # only simple ratios are crossed
    return rows_of(spark, [(c.label(),) for c in C.crossed([*simple, *other], ["g", "e"], 1)], "label string")


@register("significant_signal", "SELECT p_brand AS cand, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS importance, count(*)::DOUBLE / sum(count(*)) OVER () >= 0.02 AS significant FROM part WHERE p_size < 40 GROUP BY p_brand")
def _(spark, sf_dir):
    part = table(spark, sf_dir, "part").filter("p_size < 40")
    shares = part.groupBy(F.col("p_brand").alias("cand")).agg((F.count("*") / F.lit(part.count())).alias("importance"))
    return rounded(importance.significant(shares), 6)


_FORMS = [
    ("ratio__o_totalprice__over__l_quantity", "(o_totalprice) / (l_quantity)", "o_totalprice,l_quantity", "DIVIDE(Obs[o_totalprice], Obs[l_quantity])"),
    ("ratio__p_retailprice__over__l_quantity", "(p_retailprice) / (l_quantity)", "p_retailprice,l_quantity", "DIVIDE(Obs[p_retailprice], Obs[l_quantity])"),
    ("ratio__o_totalprice__over__l_tax", "(o_totalprice) / (l_tax)", "o_totalprice,l_tax", "DIVIDE(Obs[o_totalprice], Obs[l_tax])"),
    ("ratio__o_totalprice_p_retailprice__over__l_quantity", "(o_totalprice + p_retailprice) / (l_quantity)", "o_totalprice,p_retailprice,l_quantity", "DIVIDE(Obs[o_totalprice] + Obs[p_retailprice], Obs[l_quantity])"),
    ("mean__l_quantity__by__p_brand", "mean of l_quantity over rows with the same p_brand", "l_quantity,p_brand", "IF(ISBLANK(Obs[p_brand]) || COUNTROWS(FILTER(Obs, Obs[p_brand] = EARLIER(Obs[p_brand]))) < 10, BLANK(), AVERAGEX(FILTER(Obs, Obs[p_brand] = EARLIER(Obs[p_brand])), Obs[l_quantity]))"),
    ("mean__c_acctbal__by__o_orderpriority", "mean of c_acctbal over rows with the same o_orderpriority", "c_acctbal,o_orderpriority", "IF(ISBLANK(Obs[o_orderpriority]) || COUNTROWS(FILTER(Obs, Obs[o_orderpriority] = EARLIER(Obs[o_orderpriority]))) < 10, BLANK(), AVERAGEX(FILTER(Obs, Obs[o_orderpriority] = EARLIER(Obs[o_orderpriority])), Obs[c_acctbal]))"),
    ("count__by__p_type", "rows with the same p_type", "p_type", "IF(ISBLANK(Obs[p_type]), BLANK(), COUNTROWS(FILTER(Obs, Obs[p_type] = EARLIER(Obs[p_type]))))"),
    ("gap__l_shipdate__minus__o_orderdate", "days from o_orderdate to l_shipdate", "l_shipdate,o_orderdate", "INT(Obs[l_shipdate] - Obs[o_orderdate])"),
]


def _forms(spark: SparkSession, of, name: str) -> DataFrame:
    return rows_of(spark, [(i, of(c)) for i, (c, _) in enumerate(SCORED[:8])], f"id int, {name} string")


for _name, _place, _of in (("readable_names", 0, C.Candidate.label), ("formula_text", 1, C.Candidate.describe), ("source_columns", 2, lambda c: ",".join(c.inputs())), ("dax_formulas", 3, lambda c: c.to_dax("Obs"))):
    register(_name, values([(i, f[_place]) for i, f in enumerate(_FORMS)], "id, value"))(lambda spark, sf_dir, of=_of: _forms(spark, of, "value"))


@register("name_sanitising", values([(0, "Price per unit"), (1, "Price per unit (2)"), (2, "Indicator"), (3, "price per UNIT (3)")], "id, name"))
def _(spark, sf_dir):
    return rows_of(spark, list(enumerate(export.unique_names(["Price [per] unit", "Price\tper; unit", "[]", "price per UNIT"]))), "id int, name string")


@register("bi_script", values([(0, 'var table = Model.Tables["Obs"];'), (1, 'table.AddCalculatedColumn("One", @"DIVIDE(Obs[o_totalprice], Obs[l_quantity])");'), (2, 'table.AddCalculatedColumn("One (2)", @"DIVIDE(Obs[p_retailprice], Obs[l_quantity])");')], "id, line"))
def _(spark, sf_dir):
    text, failed = export.bi_script([SCORED[0][0], SCORED[1][0], C.Candidate("none", ())], ["One", "One", "Bad"], "Obs")
    assert failed == [C.Candidate("none", ()).label()]
    return rows_of(spark, list(enumerate(text.splitlines())), "id int, line string")


@register("definition_lookup", f"WITH {DICTIONARY_SQL}, i AS ({values([(f[0], c) for f in _FORMS for c in f[2].split(',')], 'label, name')}), e AS (SELECT name, max(definition) AS definition FROM entries GROUP BY name) SELECT label, name, coalesce(definition, '') AS definition FROM i LEFT JOIN e USING (name)")
def _(spark, sf_dir):
    used = rows_of(spark, [(c.label(), i) for c, _ in SCORED[:8] for i in c.inputs()], "label string, name string")
    known = entries(spark).groupBy("name").agg(F.max("definition").alias("definition"))
    return used.join(known, "name", "left").select("label", "name", F.coalesce("definition", F.lit("")).alias("definition"))


# --- contracts with a language model ------------------------------------------------------------------------------

_REPLIES = ['{"a": 1}', '```json\n{"a": [1, 2]}\n```', 'Sure! {"a": {"b": null}} Anything else?', "no object", "{broken"]


@register("tolerant_json", values([(0, '{"a": 1}'), (1, '{"a": [1, 2]}'), (2, '{"a": {"b": null}}'), (3, "refused"), (4, "refused")], "id, value"))
def _(spark, sf_dir):
    def read(text: str) -> str:
        try:
            return json.dumps(language.tolerant_json(text))
        except ValueError:
            return "refused"

    return rows_of(spark, [(i, read(t)) for i, t in enumerate(_REPLIES)], "id int, value string")


@register("field_repair", values([(0, "numeric", True, True, None, "n"), (1, "categorical", None, None, True, ""), (2, "date", None, None, None, ""), (3, "categorical", None, None, None, "")], "id, role, is_rate, can_divide, is_dimension, note"))
def _(spark, sf_dir):
    replies = [{"Role": "Numeric measure", "is rate": "yes", "CAN-DIVIDE": 1, "is_dimension": True, "note": "n"}, {"main_role": "catégor", "is_dimension": "true", "role": "Category label"}, {"role": "Date/time", "is_rate": True}, {}]
    rows = [(i, *(language.repaired_role(r)[k] for k in ("role", "is_rate", "can_divide", "is_dimension", "note"))) for i, r in enumerate(replies)]
    return rows_of(spark, rows, "id int, role string, is_rate boolean, can_divide boolean, is_dimension boolean, note string")


@register("batches_and_retries", values([("a", "1", 0), ("b", "2", 0), ("c", None, 1), ("d", "4", 0)], "name, value, failed"))
def _(spark, sf_dir):
    model = language.ScriptedModel(['{"A": 1, "b": 2}', "nothing", "[]", "nothing", '{"answer": {"D": 4}}'])
    found, failed = {}, []
    for lo, names in ((0, "ab"), (2, "c"), (3, "d")):
        more, lost = language.asked_in_batches(model, [{"name": n} for n in names], str, len(names), 2)
        found, failed = found | more, failed + lost
    return rows_of(spark, [(n, None if n not in found else str(found[n]), int(n in failed)) for n in "abcd"], "name string, value string, failed int")


@register("classification_contract", values([("day", "date", None, None), ("amount", "numeric", True, None), ("kind", "categorical", None, True)], "name, role, can_divide, is_dimension"))
def _(spark, sf_dir):
    model = language.ScriptedModel(['{"amount": {"role": "numeric", "can_divide": true}, "kind": {"role": "category", "is_dimension": "yes"}}'])
    found, _ = language.classify(model, [{"name": "day", "type_class": "date"}, {"name": "amount"}, {"name": "kind"}])
    return rows_of(spark, [(k, v["role"], v["can_divide"], v["is_dimension"]) for k, v in found.items()], "name string, role string, can_divide boolean, is_dimension boolean")


@register("proposal_contract", values([("One", "ratio"), ("Two", "plain")], "name, operation"))
def _(spark, sf_dir):
    model = language.ScriptedModel(["later", '{"indicators": [{"name": "One", "operation": "ratio"}, 3]}', '[{"name": "Two", "operation": "plain"}]'])
    found = language.proposed(model, [{"name": "a"}, {"name": "b"}], "y", size=1)
    return rows_of(spark, [(p["name"], p["operation"]) for p in found], "name string, operation string")


@register("explanation_contract", values([("model", "It says much."), ("template", "x is (a) / (b). Where it is high, the target's median is 3, where it is low 1.5.")], "form, text"))
def _(spark, sf_dir):
    facts = {"name": "x", "formula": "(a) / (b)", "effect": {"high_median": 3.0, "low_median": 1.5}}
    model = language.ScriptedModel(["none", '{"explanation": "It says much."}'])
    return rows_of(spark, [("model", language.explained(model, facts)), ("template", language.explained(None, facts))], "form string, text string")


# --- questions ----------------------------------------------------------------------------------------------------


@register("schema_introspection", "SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS kind FROM (DESCRIBE SELECT * FROM lineitem)")
def _(spark, sf_dir):
    lines = runner.schema_text(table(spark, sf_dir, "lineitem"), "lineitem").split("\nrows:")[0].splitlines()[1:]
    return rows_of(spark, [tuple(x.split()) for x in lines], "column_name string, kind string")


@register("few_shot_block", values([("Question: how many?\nSQL: SELECT count(*) FROM t\nQuestion: which?\nSQL: SELECT a FROM t\n",)], "text"))
def _(spark, sf_dir):
    return rows_of(spark, [(runner.examples_text([("how many?", "SELECT count(*) FROM t"), ("which?", "SELECT a FROM t")]),)], "text string")


@register("reply_cleaning", values([(0, "SELECT 1"), (1, "SELECT a FROM t"), (2, "SELECT 2"), (3, "SELECT 'x;y'")], "id, sql"))
def _(spark, sf_dir):
    replies = ["SELECT 1;", "Here it is:\n```sql\nSELECT a FROM t;\n```\nDone.", "```\nSELECT 2\n```", " SELECT 'x;y' ; "]
    return rows_of(spark, [(i, stripped(r)) for i, r in enumerate(replies)], "id int, sql string")


_STATEMENTS = [
    ("SELECT count(*) FROM part", True), ("WITH b AS (SELECT p_brand FROM part) SELECT p_brand FROM b GROUP BY 1", True), ("SELECT replace(p_name, 'a', 'b') FROM part -- drop", True), ("DROP TABLE part", False), ("DELETE FROM part", False),
    ("SELECT * FROM nation", False), ("SELECT * FROM parquet.`/tmp/x`", False), ("SELECT 1; SELECT 2", False), ("SELECT reflect('java.lang.System', 'exit', 0) FROM part", False), ("SELECT java_method('a', 'b') FROM part", False), ("SELECT input_file_name() FROM part", False),
]


@register("sql_validator", values(_STATEMENTS, "sql, allowed"))
def _(spark, sf_dir):
    def allowed(sql: str) -> bool:
        try:
            return bool(checked(spark, sql, ["part"]))
        except RefusedQuery:
            return False

    return rows_of(spark, [(s, allowed(s)) for s, _ in _STATEMENTS], "sql string, allowed boolean")


@register("auto_limit", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 200")
def _(spark, sf_dir):
    table(spark, sf_dir, "part").createOrReplaceTempView("part")
    return runner.limited(spark, "SELECT p_partkey, p_name FROM part ORDER BY p_partkey -- LIMIT 5", ["part"], Thresholds())


def _asked(spark: SparkSession, sf_dir: str) -> runner.Answer:
    table(spark, sf_dir, "part").createOrReplaceTempView("part")
    model = language.ScriptedModel(["DROP TABLE part", "SELECT nope FROM part", "```sql\nSELECT p_brand, count(*) AS n FROM part GROUP BY p_brand;\n```", " Brands are many. "])
    return runner.ask(spark, model, "How many parts has each brand?", "part")


@register("question_repair", "SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand")
def _(spark, sf_dir):
    found = _asked(spark, sf_dir)
    return rows_of(spark, [tuple(r) for r in found.rows], "p_brand string, n long")


@register("question_answer", values([("Brands are many.", 2, "p_brand,n")], "text, repairs, columns"))
def _(spark, sf_dir):
    found = _asked(spark, sf_dir)
    return rows_of(spark, [(found.text, len(found.errors), ",".join(found.columns))], "text string, repairs int, columns string")


@register("json_fields", "SELECT event_id, json_extract_string(props, '$.' || json_keys(props)[1]) AS first_value, len(json_keys(props)) AS n FROM events")
def _(spark, sf_dir):
    keys = F.json_object_keys("props")
    return table(spark, sf_dir, "events").select("event_id", F.element_at(F.map_values(F.from_json("props", "map<string,string>")), 1).alias("first_value"), F.size(keys).cast("long").alias("n"))




# --- without a table ----------------------------------------------------------------------------------------------

#: What works on a few given values: checked by the tests against its SQL, and no query of the engine.
FIXED_NAMES = [
    "settings_from_env", "dictionary_path_found", "header_detection", "dict_text_parse", "dict_duplicates", "dictionary_reader", "exhaustive_union", "proposal_validation", "proposal_dedup", "crossover_eligibility",
    "readable_names", "formula_text", "source_columns", "dax_formulas", "name_sanitising", "bi_script", "definition_lookup", "tolerant_json", "field_repair", "batches_and_retries", "classification_contract",
    "proposal_contract", "explanation_contract", "few_shot_block", "reply_cleaning", "sql_validator",
]
FIXED = {name: (QUERIES.pop(name), ORACLES.pop(name)) for name in FIXED_NAMES}
