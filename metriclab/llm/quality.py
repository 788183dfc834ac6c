"""Quality rules from repetition coverage.

Rolling hashes of several n-gram lengths find, inside each text, the n-grams that
repeat an earlier one; those of three words are compared by their bytes.  A text is judged by the share of its characters that lie in
such n-grams and in repeated lines, and by its symbols per word.  Each text is judged on its own, so the job is
one pass over the table without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytesets import blocks, gram_hashes, mix, utf8, word_hashes, words

#: The published limits of the share of characters in duplicated n-grams, by n.
GRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: The published limits of duplicated lines, by number and by characters.
LINE_LIMIT, LINE_CHAR_LIMIT = 0.30, 0.20
#: Fixed value: the published limit of symbols per word.
SYMBOL_LIMIT = 0.1
#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
BASE = 3


@dataclass(frozen=True)
class RepetitionRules:
    """Limits of the verdict.  ``gram_limits`` maps n-gram length (3 or more) to the largest share."""

    gram_limits: tuple[tuple[int, float], ...] = tuple(GRAM_LIMITS.items())
    line_limit: float = LINE_LIMIT
    line_char_limit: float = LINE_CHAR_LIMIT
    max_symbols_per_word: float = SYMBOL_LIMIT
    min_words: int = 50
    max_repeat_percent: int = 50


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, dup_line_chars long, dup_gram_chars long, worst_gram int, base_failed boolean, kept boolean"


def _twice(keys: np.ndarray, later: bool = False) -> np.ndarray:
    """Which keys occur twice or more; ``later``: without the first of each."""
    order = np.argsort(keys, kind="stable" if later else None)
    same = np.zeros(len(keys) + 1, dtype=bool)
    ranked = keys[order]
    same[1:-1] = ranked[1:] == ranked[:-1]
    out = np.empty(len(keys), dtype=bool)
    out[order] = same[:-1] if later else same[:-1] | same[1:]
    return out


def _really_twice(raw: bytes, at: np.ndarray, n: int, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Those of the n-grams at ``at`` whose words stand twice in one text, told by their bytes."""
    owner = np.searchsorted(bounds, at, side="right").tolist()
    own = [[raw[a:b] for a, b in zip(starts[at + k].tolist(), ends[at + k].tolist())] for k in range(n)]
    keys = list(zip(owner, *own))
    count = Counter(keys)
    return at[np.fromiter((count[k] > 1 for k in keys), dtype=bool, count=len(keys))]


def _covered(at: np.ndarray, n: int, size: int) -> np.ndarray:
    step = np.zeros(size + 1, dtype=np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + n, -1)
    return np.cumsum(step[:-1]) > 0


def _per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _lines(text: bytes) -> tuple[int, int, int, int]:
    """Lines with a word, those equal to an earlier one, and the code points of both."""
    seen: set[bytes] = set()
    n = dup = chars = dup_chars = 0
    for line in text.split(b"\n"):
        if line and not line.isspace():
            size = len(line.decode("utf-8", "replace"))
            n, chars = n + 1, chars + size
            if line in seen:
                dup, dup_chars = dup + 1, dup_chars + size
            seen.add(line)
    return n, dup, chars, dup_chars


def measure(data: np.ndarray, offsets: np.ndarray, rules: RepetitionRules) -> dict[str, np.ndarray]:
    """The columns of ``COLUMNS`` for the texts of one block."""
    n_texts = len(offsets) - 1
    starts, ends, bounds = words(data, offsets)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
    size = chars[ends] - chars[starts]
    n_words, word_chars = np.diff(bounds), _per_text(size, bounds)
    hashes = word_hashes(data, starts, ends)
    owner = mix(np.repeat(np.arange(n_texts, dtype=np.uint64), n_words))
    grams, at = gram_hashes(hashes, bounds, BASE)
    raw = data.tobytes()
    at = _really_twice(raw, at[_twice(grams ^ owner[at])], BASE, starts, ends, bounds)
    repeat = _covered(at, BASE, len(starts))
    n_repeat = _per_text(repeat, bounds)

    worst = np.zeros(n_texts, dtype=np.int32)
    worst_chars = np.zeros(n_texts, dtype=np.int64)
    excess = np.ones(n_texts)
    begins = np.zeros(len(starts) + 1, dtype=bool)
    begins[at] = True
    for n, limit in rules.gram_limits:
        # an n-gram that occurs twice has repeated shorter grams at each of its words
        runs = at[begins[np.minimum(at + n - BASE, len(starts))]]
        if not len(runs):
            continue
        runs = runs[np.searchsorted(bounds, runs, side="right") == np.searchsorted(bounds, runs + n - 1, side="right")]
        value = np.zeros(len(runs), dtype=np.uint64)
        for k in range(n):
            value = mix(value + hashes[runs + k])
        found = runs[_twice(value ^ owner[runs], later=True)]
        inside = _per_text(np.where(_covered(found, n, len(starts)), size, 0), bounds)
        share = inside / np.maximum(word_chars, 1) / limit
        more = share > excess
        worst[more], worst_chars[more], excess[more] = n, inside[more], share[more]

    lines = np.array([_lines(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], dtype=np.int64).reshape(-1, 4)
    base_failed = (n_words < rules.min_words) | (100 * n_repeat > rules.max_repeat_percent * n_words)
    bad_lines = (lines[:, 1] > rules.line_limit * lines[:, 0]) | (lines[:, 3] > rules.line_char_limit * lines[:, 2])
    symbols = _per_text(_IS_SYMBOL[data], offsets)
    bad = bad_lines | (worst > 0) | (symbols > rules.max_symbols_per_word * n_words)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": lines[:, 1], "n_repeat_words": n_repeat,
        "dup_line_chars": lines[:, 3], "dup_gram_chars": worst_chars, "worst_gram": worst, "base_failed": base_failed, "kept": ~(base_failed | bad),
    }


def with_quality(docs: DataFrame, text: str = "text", rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """``docs`` with the columns of ``COLUMNS`` behind its own.

    A null or empty text has no words and fails.  Very long texts are measured
    whole.  Repeated rows are measured each.  Columns of ``docs`` that clash with
    a result column are replaced.
    """
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    docs = docs.drop(*names)
    own = docs.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(own.index(text)))
            for lo, hi, part, at in blocks(data, offsets):
                rows = batch.slice(lo, hi - lo)
                found = measure(part, at, rules)
                yield pa.RecordBatch.from_arrays([*rows.columns, *(pa.array(found[c]) for c in names)], names=[*own, *names])

    return docs.mapInArrow(run, schema)


def quality_filtered(docs: DataFrame, text: str = "text", rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the columns of ``docs``, whatever they are called."""
    own = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(own))
            for lo, hi, part, at in blocks(data, offsets):
                yield batch.slice(lo, hi - lo).filter(pa.array(measure(part, at, rules)["kept"]))

    return docs.mapInArrow(run, docs.schema)


#: DuckDB: the same measures and verdict.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
h AS (SELECT doc_id, i, length(word) AS size, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS t3, lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS t45,
        lead(word, 5) OVER o AS w6, lead(word, 6) OVER o AS w7, lead(word, 7) OVER o AS w8, lead(word, 8) OVER o AS w9, lead(word, 9) OVER o AS w10 FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g3 AS (SELECT doc_id, i, t3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, t3) > 1 AS twice FROM h),
c3 AS (SELECT doc_id, i, max(CASE WHEN twice THEN i END) OVER (PARTITION BY doc_id ORDER BY i) + 2 >= i AS inside FROM g3),
r3 AS (SELECT doc_id, count(*) FILTER (WHERE inside) AS n_repeat_words FROM c3 GROUP BY doc_id),
j AS (
  SELECT doc_id, i, size, 5 AS n, 0.15::DOUBLE AS most, t3 || ' ' || t45 AS gram FROM h
  UNION ALL SELECT doc_id, i, size, 6, 0.14, t3 || ' ' || t45 || ' ' || w6 FROM h
  UNION ALL SELECT doc_id, i, size, 7, 0.13, t3 || ' ' || t45 || ' ' || w6 || ' ' || w7 FROM h
  UNION ALL SELECT doc_id, i, size, 8, 0.12, t3 || ' ' || t45 || ' ' || w6 || ' ' || w7 || ' ' || w8 FROM h
  UNION ALL SELECT doc_id, i, size, 9, 0.11, t3 || ' ' || t45 || ' ' || w6 || ' ' || w7 || ' ' || w8 || ' ' || w9 FROM h
  UNION ALL SELECT doc_id, i, size, 10, 0.10, t3 || ' ' || t45 || ' ' || w6 || ' ' || w7 || ' ' || w8 || ' ' || w9 || ' ' || w10 FROM h),
gn AS (SELECT doc_id, n, most, i, size, gram IS NOT NULL AND row_number() OVER (PARTITION BY doc_id, gram ORDER BY i) > 1 AS again FROM j),
cn AS (SELECT *, max(CASE WHEN again THEN i END) OVER (PARTITION BY doc_id, n ORDER BY i) + n - 1 >= i AS inside FROM gn),
rn AS (SELECT doc_id, n, coalesce(sum(size) FILTER (WHERE inside), 0)::BIGINT AS chars, coalesce(sum(size) FILTER (WHERE inside), 0)::DOUBLE / sum(size) / any_value(most) AS share FROM cn GROUP BY doc_id, n),
wn AS (SELECT doc_id, n AS worst_gram, chars AS dup_gram_chars FROM rn WHERE share > 1 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY share DESC, n) = 1),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
m AS (SELECT doc_id, length(line) AS size, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
q AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE again) AS n_dup_lines, sum(size)::BIGINT AS line_chars, coalesce(sum(size) FILTER (WHERE again), 0)::BIGINT AS dup_line_chars FROM m GROUP BY doc_id),
f AS (
  SELECT d.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(line_chars, 0) AS line_chars,
    coalesce(dup_line_chars, 0) AS dup_line_chars, coalesce(dup_gram_chars, 0) AS dup_gram_chars, coalesce(worst_gram, 0) AS worst_gram
  FROM d LEFT JOIN r3 ON r3.doc_id = d.doc_id LEFT JOIN wn ON wn.doc_id = d.doc_id LEFT JOIN q ON q.doc_id = d.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, dup_line_chars, dup_gram_chars, CAST(worst_gram AS INTEGER) AS worst_gram, base_failed,
  NOT (base_failed OR worst_gram > 0 OR n_dup_lines > 0.3::DOUBLE * n_lines OR dup_line_chars > 0.2::DOUBLE * line_chars OR n_symbols > 0.1::DOUBLE * n_words) AS kept
FROM b
"""
