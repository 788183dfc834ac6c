"""Repeated runs of lines and sentences against all equal runs, and tags with long values."""

from __future__ import annotations

import random
import re
from itertools import accumulate

import pytest

from metriclab.llm import chunks, htmltext, units


def texts(seed: int) -> list[str]:
    """Short texts over few lines, so that runs of all lengths meet foreign lines on both sides."""
    rnd = random.Random(seed)
    pool = [" ".join(rnd.choice("abcdefgh") * 2 for _ in range(n)) for n in (1, 2, 3, 3, 5, 9, 10, 12)] + ["", "", " "]
    own = iter(range(10_000))
    return ["\n".join(rnd.choice(pool) if rnd.random() < 0.8 else f"own {next(own)} line of some words" for _ in range(rnd.randint(1, 9))) + rnd.choice(["", "\n"]) for _ in range(60)]


def repeated_lines(rows: list[str], min_lines: int, min_words: int) -> list[set[int]]:
    """Numbers of the lines of each text inside a run that stood earlier; runs begin with words and end with them or one line behind."""
    seen, out = set(), []
    for text in rows:
        lines = text.removesuffix("\n").split("\n")
        gone, fresh = set(), []
        full = [bool(x.split()) for x in lines]
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = lines[a : b + 1]
                if full[a] and (full[b] or full[b - 1]) and len(run) >= min_lines and sum(len(x.split()) for x in run) >= min_words:
                    fresh.append((a, b))
        for a, b in sorted(fresh):
            if (run := "\n".join(lines[a : b + 1])) in seen:
                gone |= set(range(a, b + 1))
            seen.add(run)
        out.append(gone)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_chunks_cover_every_repeated_run_of_lines(spark, seed):
    rows = texts(seed)
    gone = repeated_lines(rows, 2, 10)
    want = {}
    for i, (text, some) in enumerate(zip(rows, gone)):
        lines = re.findall(r"[^\n]*\n|[^\n]+$", text)
        want[i] = "".join(x for n, x in enumerate(lines) if n not in some)
    assert any(0 < len(g) < 5 for g in gone)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["text"] for r in chunks.without_repeats(docs).collect()} == want


def test_chunks_stay_bounded_among_blank_lines():
    text = b"\n" * 5000 + b"a b c d e f g h i j k\n" + b"\n" * 5000 + b"l m n o p q r s t u v\n"
    listed = chunks.Chunks().listed(text)
    assert sum(b - a for a, b in zip(*listed[1:])) < 3 * len(text)


def test_runs_of_short_lines_and_sentences_go(spark):
    verse = "roses are red\nviolets are blue\nsugar is sweet\nand so are you"
    said = "It was a bright cold day in April, and clocks struck. Thirteen they said."
    rows = [(1, f"one\n{verse}\ntwo"), (2, f"three\n{verse.upper()}\nfour"), (3, f"First of all. {said} And more."), (4, f"Other words here.\n{said}\nEnd."), (5, "roses are red\nviolets too"), (6, None)]
    got = {r["doc_id"]: r["text"] for r in units.without_repeats(spark.createDataFrame(rows, "doc_id long, text string"), units=units.Runs(min_words=10)).collect()}
    assert got == dict(rows) | {2: "three\nfour", 4: "Other words here.\nEnd."}


@pytest.mark.parametrize("seed", [3, 4])
def test_runs_cover_every_repeated_run(spark, seed):
    rows = texts(seed)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    found = units.without_repeats(docs, units=units.Runs(min_words=10)).collect()
    seen: set[tuple[str, ...]] = set()
    for i, text in enumerate(rows):
        lines = re.findall(r"[^\n]*\n|[^\n]+$", text)
        words = [x.split() for x in lines]
        places, marks, fresh = [0, *accumulate(map(len, words))], set(), []
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                run = tuple(w for x in words[a : b + 1] for w in x)
                if words[a] and words[b] and len(run) >= 10:
                    fresh.append((a, b, run))
        for a, b, run in fresh:
            if run in seen:
                marks |= set(range(places[a], places[b + 1]))
            seen.add(run)
        flat = [w for x in words for w in x]
        got = next(r["text"] for r in found if r["doc_id"] == i)
        assert got.split() == [w for n, w in enumerate(flat) if n not in marks], i


def page(attributes: str) -> str:
    return f"<html><body><div {attributes}><p>The first of some words, and a comma.</p></div><p>The main text is here, with words and a comma.</p></body></html>"


def test_values_of_any_length_end_at_their_quote():
    value = "{'html': '<b>data, data.</b>'} " * 400
    assert "data" not in htmltext.main_text(page(f'data-x="{value}"'))
    assert "first" not in htmltext.main_text(page(f'data-x="{value}" class="sidebar"'))
    assert "first" in htmltext.main_text(page("""data-x='class="sidebar"'"""))
    assert "first" in htmltext.main_text(page("title=it's"))
    assert htmltext.main_text('<p>one, two.</p><img alt="never closed><p>three, four.</p>') == "one, two.\nthree, four."


def test_self_closed_svg_and_math_are_empty():
    for tag in ('<svg width="1"/>', "<math/>", "<SVG />"):
        assert htmltext.main_text(f"<p>One, two, three.</p>{tag}<p>Four, five, six.</p>") == "One, two, three.\nFour, five, six."
    assert htmltext.main_text("<p>One, two, three.</p><svg><text>no</text></svg><p>Four, five, six.</p>") == "One, two, three.\nFour, five, six."


def test_open_quotes_are_not_read_over_and_over():
    calls, find = [], htmltext._tag_end
    lost: set[int] = set()
    text = "<img b='>' " * 2000
    for m in re.finditer("<img", text):
        before = len(lost)
        find(text, m.end(), lost)
        calls.append(len(lost) - before)
    assert sum(calls) < 3 * 2000 * 2
