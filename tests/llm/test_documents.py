"""Operators on documents against plain versions, round trips, and their edge cases."""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from metriclab.llm import bpe, chunks, jaccard, mixing, quality, registry, repeats, spans, units

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("byte_bpe_50k.json")


def plain(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


# --- encoding ---------------------------------------------------------------------------------------------------


def test_round_trip_is_the_library(docs):
    t = tokenizers.Tokenizer.from_file(PATH)
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip(docs, PATH).collect())
    want = Counter()
    for key, text in plain(docs):
        ids = t.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, dtype="<u4").tobytes()
        want[key, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += 1
    assert got == want


def test_words_of_any_kind():
    t, own = tokenizers.Tokenizer.from_file(PATH), bpe.ByteBPE(PATH)
    for text in ["", "a" * 5000, " " * 300 + "b", "it's we'LL", "  x\u0085y\x1c", "é" * 70, "0123456789 " * 9, "日本語テキスト", "a<|endoftext|>", "\r\n\t \n x"]:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
        assert own.decode(own.encode(text)) == text


def test_seams_agree_with_merging():
    own = bpe.ByteBPE(PATH)
    rng = np.random.default_rng(3)
    ids = np.array(list(own.id_of.values()))
    a, b = rng.choice(ids, 3000), rng.choice(ids, 3000)
    want = [own.merged(own.bytes_of[x] + own.bytes_of[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert own.apart(a, b).tolist() == want
    word = b"".join(own.bytes_of[i] for i in ids[500:540].tolist())
    base = [own.byte_ids[c] for c in word]
    assert own._merged_short(list(base)) == own._merged_long(list(base))


def test_encoded_keeps_columns_and_decodes(docs, no_docs):
    rows = bpe.decoded(bpe.encoded(docs, PATH), PATH)
    assert rows.columns == [*docs.columns, "token_ids", "decoded"]
    assert rows.filter(~F.coalesce("text", F.lit("")).eqNullSafe(F.col("decoded"))).count() == 0
    assert bpe.round_trip(no_docs, PATH).count() == 0 and bpe.encoded(no_docs, PATH).count() == 0


# --- quality ----------------------------------------------------------------------------------------------------


def test_quality_base_columns(docs, no_docs):
    found = quality.with_quality(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        text = r["text"] or ""
        w = brute.WORD.findall(text)
        lines = [x for x in text.split("\n") if brute.WORD.search(x)]
        n = brute.repeat_words(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), n)
        assert r["base_failed"] == (len(w) < 50 or 100 * n > 50 * len(w)) and not (r["kept"] and r["base_failed"])
        assert r["dup_gram_chars"] == expected_grams(w)
    assert quality.with_quality(no_docs).count() == 0
    assert quality.quality_filtered(docs).columns == docs.columns


def expected_grams(w: list[str]) -> int:
    """Characters in later occurrences of n-grams, for the length that is furthest over its limit."""
    worst, out = 1.0, 0
    for n, limit in quality.GRAM_LIMITS.items():
        seen, inside = set(), set()
        for i in range(len(w) - n + 1):
            gram = tuple(w[i : i + n])
            if gram in seen:
                inside |= set(range(i, i + n))
            seen.add(gram)
        chars = sum(len(w[i]) for i in inside)
        if chars / max(sum(map(len, w)), 1) / limit > worst:
            worst, out = chars / max(sum(map(len, w)), 1) / limit, chars
    return out


# --- repeated strings, lines and chunks -------------------------------------------------------------------------


@pytest.mark.parametrize("rules", [repeats.Repeats(), repeats.Repeats(crowd=1, shard=3000, held=100), repeats.Repeats(repeats.Anchors(60, 20), crowd=2), repeats.Repeats(crowd=1, shard=1), repeats.Repeats(repeats.Anchors(60, 20), crowd=0, shard=1)])
def test_suffix_removal(docs, rules):
    rows = [(k, (t or "").encode()) for k, t in plain(docs)]
    length = rules.anchors.length
    want = Counter()
    for (key, raw), marks in zip(rows, brute.covered([b for _, b in rows], length)):
        kept = bytes(x for x, m in zip(raw, marks) if not m)
        want[key, len(raw), sum(marks), sum(1 for i, m in enumerate(marks) if m and (not i or not marks[i - 1])), hashlib.sha256(kept).hexdigest()] += 1
    found = spans.cut_digests(docs, repeats.repeated_spans(docs, rules=rules)).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found) == want


def test_long_texts_are_cut_in_parts(docs, monkeypatch):
    from metriclab.llm import anchors

    monkeypatch.setattr(anchors, "PART", 700)
    parts = anchors.Anchors().parts(np.array([399, 400, 5000]))
    assert parts[0] == (1, 0, 400)
    starts = [i for row, a, b in parts if row == 2 for i in range(a, b - 399)]
    assert starts == list(range(5000 - 399))


def test_suffix_order_spills_and_sorts():
    from metriclab.llm.suffixes import repeated_starts, shard_text, suffix_order

    rng = np.random.default_rng(5)
    bodies = [bytes(rng.choice(list(b"ab"), rng.integers(1, 40)).tolist()) for _ in range(50)]
    text, _ = shard_text(bodies)
    order = suffix_order(text, len(text), held=16)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    same = repeated_starts([b"abcabc", b"abc"], np.array([1, 1]), np.array([0, 3]), 3)
    assert [s.tolist() for s in same] == [[0, 3], [0]]


def test_units_keep_the_first(docs, no_docs):
    rows = sorted({(k, t) for k, t in plain(docs)}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, want = set(), {}
    for key, text in rows:
        kept = []
        for unit in re.findall(r"[^\n]*\n|[^\n]+$", text or ""):
            words = tuple(brute.WORD.findall(brute.lower(unit)))
            if len(words) < 10 or words not in seen:
                kept.append(unit)
            seen.add(words)
        want[key] = None if text is None else "".join(kept)
    got = units.without_repeats(docs)
    assert got.columns == docs.columns and got.count() == docs.count()
    assert {r["doc_id"]: r["text"] for r in got.collect()} == want
    assert units.without_repeats(no_docs).count() == 0


def test_paragraph_units():
    text = b"a b\nc d\n\nA  B\nc d\n \n\nlast"
    digests, starts, ends = units.Units("paragraph", 1).listed(text)
    assert digests[0] == digests[1] and [text[a:b] for a, b in zip(starts, ends)] == [b"a b\nc d\n\n", b"A  B\nc d\n \n\n", b"last"]


def test_chunks_against_plain_removal(docs, no_docs):
    rules = chunks.Chunks()
    rows = sorted({(k, t) for k, t in plain(docs)}, key=lambda r: (r[0] is not None, r[0] or 0))
    first, want = {}, {}
    for key, text in rows:
        raw = (text or "").encode()
        kept, last = [], 0
        for _, a, b in zip(*rules.listed(raw)):
            body = raw[a:b].removesuffix(b"\n")
            if first.setdefault(body, (key, a)) != (key, a):
                kept.append(raw[last:a])
                last = b
        want[key] = None if text is None else b"".join([*kept, raw[last:]]).decode()
    got = chunks.without_repeats(docs)
    assert got.columns == docs.columns and {r["doc_id"]: r["text"] for r in got.collect()} == want
    assert any(want[k] != t for k, t in rows) and chunks.without_repeats(no_docs).count() == 0


def test_chunk_boundaries_resist_shifts():
    lines = [f"line {i} with quite a few words in it, number {i * 7}".encode() for i in range(200)]
    rules = chunks.Chunks()
    a, b = (rules.listed(b"\n".join(x)) for x in (lines, [b"new first line"] + lines))
    assert len(set(a[0]) & set(b[0])) >= len(a[0]) - 2


def test_equal_digests_with_other_bytes_stay(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d e f\ng h i j k l"), (2, "q b c d e f\ng h i j k l")], "doc_id long, text string")

    class Clash(chunks.Chunks):
        def listed(self, text):
            return [[b"same"], [0], [len(text)]]

    assert chunks.repeated_chunks(docs, chunks=Clash()).count() == 0


# --- similarity -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("rules", [jaccard.JaccardJoin(), jaccard.JaccardJoin(shingle=5, percent=80), jaccard.JaccardJoin(shingle=2, percent=50, cell=3, frequent=20, stretch=200)])
def test_jaccard_components(docs, rules):
    want = Counter(brute.jaccard_components(plain(docs), rules.shingle, rules.percent))
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.with_components(docs, rules=rules).collect())
    assert got == want


def test_jaccard_limit_and_order(spark):
    rows = [(9, "a b c d e f"), (4, "A b c D e f"), (7, "a b c"), (2, "a  b\tc"), (5, None), (5, "z"), (1, "")]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.with_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(9, 3, 4), (4, 3, 4), (7, 1, 2), (2, 1, 2), (5, 0, 5), (5, 1, 5), (1, 0, 1)}


def test_one_of_each_keeps_columns(docs, no_docs):
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() < docs.count()
    assert jaccard.with_components(no_docs).count() == 0 and jaccard.one_of_each(no_docs).count() == 0


# --- mixing -----------------------------------------------------------------------------------------------------


def test_targets_are_filled_by_weight(spark):
    sizes = spark.createDataFrame([("b", 10), ("a", 100), (None, 1000), ("c", 5), ("a", 100), ("d", 0)], "source string, size long")
    got = {r["source"]: (r["source_size"], r["target"]) for r in mixing.source_targets(sizes).collect()}
    size = {"a": 200, "b": 10, "c": 5, "d": 0, None: 1000}
    weight = {"a": 3, "b": 1, "c": 2, "d": 3, None: 1}
    free, left, target = set(size), 1.5 * sum(size.values()), {}
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= 2 * size[s]}
        if not over:
            break
        for s in over:
            target[s] = 2.0 * size[s]
        free -= over
        left = 1.5 * sum(size.values()) - sum(target.values())
    target |= {s: level * weight[s] for s in free}
    assert {s: t for s, (_, t) in got.items()} == pytest.approx(target) and {s: n for s, (n, _) in got.items()} == size


def test_mix_draws_near_targets(docs, no_docs):
    drawn = mixing.with_copies(docs, bucket_rows=7)
    rows = drawn.collect()
    assert len(rows) == docs.count() and sorted(map(str, drawn.repartition(3).collect())) == sorted(map(str, rows))
    by = {}
    for r in rows:
        assert r["size"] == len(brute.WORD.findall(r["text"] or "")) and 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        by.setdefault(r["source"], []).append(r)
    assert sum(x[0]["target"] for x in by.values()) == pytest.approx(1.5 * sum(r["size"] for r in rows))
    for source, some in by.items():
        assert abs(sum(r["taken"] for r in some) - some[0]["target"]) <= 2 * max(r["size"] for r in some), source
    mix = mixing.mixed(docs, bucket_rows=7)
    assert mix.columns == docs.columns and mix.count() == sum(r["copies"] for r in rows)
    assert mixing.with_copies(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0
    for n in (1, 4, 9):
        again = mixing.with_copies(docs.repartition(n), bucket_rows=7)
        assert sorted(map(str, again.collect())) == sorted(map(str, rows))


def test_mix_orders_ties_by_the_whole_row(spark):
    ties = spark.createDataFrame([(1, "a b c", "s", {"n": i}, i // 2) for i in range(9)], "doc_id long, text string, source string, m map<string,int>, extra int")
    drawn = {n: sorted((r["m"]["n"], r["copies"]) for r in mixing.with_copies(ties.repartition(n)).collect()) for n in (1, 4, 9)}
    assert drawn[1] == drawn[4] == drawn[9] and sum(c for _, c in drawn[1]) in (13, 14)


def test_mix_spreads_rows_of_one_key(spark):
    rows = spark.range(400).selectExpr("CASE WHEN id % 2 = 0 THEN 7 END AS doc_id", "concat('w ', id) AS text", "'s' AS source")
    plan = mixing.with_copies(rows, bucket_rows=20)
    got = plan.collect()
    assert abs(sum(r["taken"] for r in got) - got[0]["target"]) <= 2 and len(got) == 400
    again = mixing.with_copies(rows.repartition(9), bucket_rows=20)
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


def test_mix_many_sources(spark):
    rows = spark.range(600).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 17 AS int)) AS text", "CASE WHEN id % 3 > 0 THEN concat('h', id) END AS source")
    per = mixing.source_targets(rows.selectExpr("source", "1 + doc_id % 17 AS size"))
    assert per.count() == 401 and per.agg(F.sum("target")).first()[0] == pytest.approx(1.5 * per.agg(F.sum("source_size")).first()[0])
    assert per.filter("target > 2 * source_size").count() == 0


# --- the registered queries and the pipeline --------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_registered_query(spark, sf_dir, name):
    from compare import connection, difference

    if name in registry.ORACLES:
        assert difference(spark, connection(sf_dir), registry.QUERIES[name], registry.ORACLES[name], sf_dir) == ""
    else:
        table = {"op8_html_text": "pages"}.get(name, "documents")
        assert registry.QUERIES[name](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    raw = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = p.STAGES[0][1](spark, docs, sf_dir)
    assert kept.columns == docs.columns
    verdict = {r["doc_id"]: r["kept"] for r in quality.with_quality(docs).collect()}
    rows = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sorted(rows) == sorted((k, t) for k, t in raw if verdict[k])
    lines = p.STAGES[1][1](spark, kept, sf_dir)
    assert lines.columns == docs.columns and lines.filter("n_chars <> length(text)").count() == 0
    near = p.STAGES[2][1](spark, lines, sf_dir)
    rows = [(r["doc_id"], r["text"]) for r in lines.collect()]
    want = {k for k, _, c in brute.jaccard_components(rows, 5, 80) if k == c}
    assert {r["doc_id"] for r in near.collect()} == want
    mix = p.STAGES[3][1](spark, near, sf_dir)
    assert mix.columns == docs.columns and {r["doc_id"] for r in mix.collect()} <= want
    t = tokenizers.Tokenizer.from_file(PATH)
    text = {r["doc_id"]: r["text"] for r in near.collect()}
    final = p.run(spark, sf_dir).collect()
    assert Counter(r["doc_id"] for r in final) == Counter(r["doc_id"] for r in mix.collect())
    for r in final[:50]:
        ids = t.encode(text[r["doc_id"]], add_special_tokens=False).ids
        assert np.frombuffer(r["token_ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
    assert json.dumps([n for n, _ in p.STAGES])


def test_pipeline_stages_at_the_edges(spark, docs, no_docs):
    import corpus_pipeline as p

    full = docs.withColumn("lang", F.lit(None).cast("string"))
    raw = Counter((r["doc_id"], r["text"]) for r in full.collect())
    ids = {}
    for name, stage in p.STAGES[:-1]:
        got = stage(spark, full, "")
        assert got.schema.names == full.columns and got.schema["kept"].dataType == full.schema["kept"].dataType, name
        rows = [(r["doc_id"], r["text"]) for r in got.collect()]
        ids[name] = {k for k, _ in rows}
        if name != "line dedup":
            assert all(n <= 2 * raw[r] for r, n in Counter(rows).items()), name
        assert stage(spark, no_docs, "").collect() == [], name
    blank = {72, 73, 74}
    assert not blank & ids["quality rules"] and not blank & ids["line dedup"]
    assert {75, 76} & ids["quality rules"] == set() and {75, 76, None} <= ids["line dedup"]
    assert {70, 71} & ids["line dedup"] == set() and 3 in ids["line dedup"]
    assert blank | {3, 76, None} <= ids["near duplicates"] and not {70, 71} & ids["near duplicates"]
    assert ids["mixing"] <= {k for k, _ in raw}
    t = tokenizers.Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    found = Counter((r["doc_id"], r["n_tokens"], bytes(r["token_ids"])) for r in p.STAGES[-1][1](spark, full, "").collect())
    want = Counter()
    for (k, text), n in raw.items():
        tokens = t.encode(text or "", add_special_tokens=False).ids
        want[(k, len(tokens), np.array(tokens, dtype="<u4").tobytes())] += n
    assert found == want
    assert p.STAGES[-1][1](spark, no_docs, "").collect() == []
