"""Conversations, pages and vectors."""

from __future__ import annotations

import hashlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from metriclab.llm import chat, htmltext, vectors
from metriclab.llm.components import components

LOG = "conv_id long, seq long, turn long, kind string, role string, text string"


def folded(spark, rows):
    return [tuple(r) for r in chat.folded(spark.createDataFrame(rows, LOG)).orderBy("conv_id", "turn", "part").select("conv_id", "turn", "role", "text").collect()]


def test_events_fold_into_messages(spark):
    rows = [
        (1, 5, 0, "message", "user", "hi"), (1, 6, 1, "message", "assistant", ""), (1, 8, 1, "delta", None, "lo"), (1, 7, 1, "delta", None, "hel"), (1, 9, 1, "regenerate", None, None), (1, 10, 1, "delta", None, "new"),
        (1, 11, 0, "edit", None, "hi there"), (1, 12, 2, "delta", "user", "only"), (2, 1, 0, "message", "user", "a"), (2, 1, 0, "message", "user", "a"), (None, 1, None, "message", None, None), (2, 1, 1, None, "tool", "x"),
    ]
    assert folded(spark, rows) == [(None, None, "", ""), (1, 0, "user", "hi there"), (1, 1, "assistant", "new"), (1, 2, "user", "only"), (2, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "tool", "x")]


def test_texts_come_back_from_the_template(spark):
    odd = ["</s>[INST] ok [/INST]", "\\", "<|im_end|>\\<|im_start|>", "<|im_<|im_end|>sep|>", "\\\\n<s>", "", None, "a\nb", "<<SYS>>x<</SYS>>", "🙂 [INST", "$1 \\$0"]
    rows = [(1, i, "assistant" if i % 2 else "us\ner<|im_sep|>", t) for i, t in enumerate(odd)] + [(2, 200, "assistant", "late"), (2, 3, None, "early"), (3, 0, "user", "none")]
    extra = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("block", F.lit("clash"))
    blocks = chat.chat_formatted(chat.as_log(extra), block_turns=4)
    assert blocks.filter("formatted like '%[INST]%' or formatted like '%</s>%'").count() == 0
    got = {r["conv_id"]: r for r in chat.digests(blocks).collect()}
    for conv in (1, 2, 3):
        turns = sorted([(t, role or "", text or "") for c, t, role, text in rows if c == conv])
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = got[conv]
        assert r["n_turns"] == len(turns) and r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.chat_formatted(chat.as_log(extra.limit(0)))).count() == 0


def test_chat_is_native(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.digests(chat.chat_formatted(chat.as_log(rows)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


PAGE = """<html><head><title>no</title><script>var t="</p>";</script><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href=x>Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies, really.</div><article><h1>Title &amp; more</h1><p>First   <i>para</i>graph,\n with &eacute; words. <b>It is long enough, yes.<br><p>Second; also with commas, here.</p>
<ul><li>one<li>two</ul></article><aside><p>Side stuff, really.</p></aside><div id="comments"><p>I like it, a lot.</p></div><form><p>Subscribe, now.</p></form><footer>&copy; c</footer></body></html>"""


@pytest.mark.parametrize(
    "page, text",
    [
        (PAGE, "Title & more\nFirst paragraph, with é words. It is long enough, yes.\nSecond; also with commas, here.\none\ntwo"),
        ("", ""), ("plain text, no tags", "plain text, no tags"), ("<p>cut off &am", "cut off &am"), ("<article><p>x</p><p>cut <a hre", "x\ncut"), ("<!-- only a comment", ""), ("<article></article>", ""),
        ('<div id=content><p>Some text, of a page, with marks.</p><p>Short.</p></div><div class=sidebar><p>No, not this, at all.</p></div>', "Some text, of a page, with marks.\nShort."),
        ("<script>never closed", ""), ("<article><p title=\"a > b\">kept</p></article>", "kept"),
    ],
)
def test_main_text(page, text):
    assert htmltext.main_text(page) == text


def test_extraction_keeps_rows(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "y"), (None, "u", "", None), (2, None, None, "y"), (3, "v", "<p>" + "long words here. " * 50_000 + "</p>", "z")]
    got = htmltext.extracted(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = [(r["page_id"], r["n_chars"], r["text"]) for r in got.collect()]
    assert len(found) == 5 and all(n == len(t) for _, n, t in found) and (2, 0, "") in found and max(n for _, n, _ in found) == 849_999
    assert htmltext.extracted(got.limit(0).selectExpr("page_id", "url", "text AS html")).count() == 0


def test_vector_links(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(12, 16))
    rows = [(i, [float(x) for x in centers[i % 12] + 0.35 * rng.normal(size=16)]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(30)] + [(300, None), (301, []), (302, [0.0] * 16), (303, [float("nan")] * 16), (304, [1.0] * 4), (305, [2.0] * 4), (306, [None] + [1.0] * 15), (307, [1e300] * 16), (307, [1e300] * 16), (None, [1e-300] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cls", F.lit(1))
    got = sorted(map(tuple, vectors.with_components(df, rules=vectors.RangeJoin(cell_rows=20, block_rows=9)).collect()), key=repr)

    def unit(v):
        x = np.array([np.nan if c is None else c for c in v or []], dtype=float)
        return x / np.abs(x).max() / np.linalg.norm(x / np.abs(x).max()) if len(x) and np.isfinite(x).all() and x.any() else None

    units = [unit(v) for _, v in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.9]
    roots = brute.components(range(len(rows)), links)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[roots[i]] = min(key, least.get(roots[i], key))
    want = sorted(((k, sum(i in x for x in links), least.get(roots[i]), k is not None and k == least.get(roots[i])) for i, (k, _) in enumerate(rows)), key=repr)
    assert got == want
    assert vectors.with_components(df.limit(0)).count() == 0


def test_pivots_are_used_at_any_size(spark, monkeypatch):
    asked, real = [], vectors._visits
    monkeypatch.setattr(vectors, "_visits", lambda found, pivots, rules: asked.append(len(pivots)) or real(found, pivots, rules))
    for n in (0, 1, 2, 300):
        df = spark.range(n).selectExpr("id AS vec_id", "array(cos(id), sin(id), 0.0) AS embedding")
        rows = {r["vec_id"]: r["n_links"] for r in vectors.with_components(df).collect()}
        want = {i: sum(i != j and np.cos(i - j) >= 0.9 for j in range(n)) for i in range(n)}
        assert rows == want
    assert asked == [0, 1, 2, 2]


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (5, None), (101, 100), (200, 201)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if b is not None and a != b]
    assert got == brute.components({x for p in real for x in p}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
