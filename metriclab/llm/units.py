"""Substring dedup by hashing lines, paragraphs, or runs of lines and sentences.

Units are normalised and digested; digests are grouped over all documents, the
earliest occurrence by document and offset stays, and the others are removed.
Their offsets in the original text are kept in the result.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .scratch import written
from .windows import smallest

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ENDS = {"line": re.compile(rb"\n|\Z"), "paragraph": re.compile(rb"\n(?:[ \t\r]*\n)+|\Z")}
_PIECE = re.compile(rb"[.!?][ \t\r]+|\n|\Z")


@dataclass(frozen=True)
class Units:
    """``kind`` is line or paragraph; a unit of fewer than ``min_words`` words always stays."""

    kind: str = "line"
    min_words: int = 10

    def listed(self, text: bytes) -> list[list]:
        """Digest, start and end of each unit that counts; a unit includes the break behind it."""
        digests, starts, ends, at = [], [], [], 0
        for m in _ENDS[self.kind].finditer(text):
            words = text[at : m.start()].translate(_LOWER).split()
            if len(words) >= self.min_words:
                digests.append(hashlib.blake2b(b" ".join(words), digest_size=12).digest())
                starts.append(at)
                ends.append(m.end())
            at = m.end()
        return [digests, starts, ends]


@dataclass(frozen=True)
class Runs(Units):
    """A unit is a smallest run of whole sentences or lines that together have ``min_words`` words.

    Units overlap, so that together they cover every repeated run of that size.  Only
    words count, not how they are set in lines.  A passage of over 50 words nearly always
    holds 25 in whole sentences; shared lines and phrases below that stay.
    """

    kind: str = "run"
    min_words: int = 25

    def listed(self, text: bytes) -> list[list]:
        pieces, places = [], [0]
        for m in _PIECE.finditer(text):
            pieces.append(text[places[-1] : m.end()].translate(_LOWER).split())
            places.append(m.end())
        found = smallest([len(p) for p in pieces], 1, self.min_words)
        digests = [hashlib.blake2b(b" ".join(w for p in pieces[a : b + 1] for w in p), digest_size=12).digest() for a, b in found]
        return [digests, [places[a] for a, _ in found], [places[b + 1] for _, b in found]]


def shared_units(docs: DataFrame, key: str = "doc_id", text: str = "text", units: Units = Units()) -> DataFrame:
    """(_key, _hash, start, end, first) of all units whose digest stands elsewhere; ``first`` marks the earliest.

    The digests are counted with a partial count in each task, so a unit that a third
    of the documents share costs a row per task.  Null keys stand first.
    """
    found = written(spans.scanned(docs, key, text, units.listed, "digest binary, start int, end int", [pa.binary(), pa.int32(), pa.int32()]), "units")
    place = F.struct("_key", "_hash", "start")
    first = found.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1").select("digest", F.col("first").alias("earliest"))
    first = written(first, "firsts")  # both sides of the join are then plain shuffles, whose hot partitions the engine splits
    return found.join(first, "digest").select(*spans.ROW, "start", "end", place.eqNullSafe(F.col("earliest")).alias("first"))


def repeated_units(docs: DataFrame, key: str = "doc_id", text: str = "text", units: Units = Units()) -> DataFrame:
    """(_key, _hash, start, end) of all units but the earliest of each digest."""
    return shared_units(docs, key, text, units).filter("not first").drop("first")


def unit_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", units: Units = Runs()) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, spans, n_shared) of every row of ``docs``.

    ``spans`` has the removed offsets in bytes of the original text, ``n_shared`` counts
    the bytes in units that stand elsewhere, whether they stay or go.
    """
    return spans.cut_digests(docs, shared_units(docs, key, text, units), key, text)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", units: Units = Units()) -> DataFrame:
    """``docs`` without repeated units.

    Null and empty texts stay as they are; a document that loses all its units stays
    with an empty text.  Rows equal in key and text are one document.  Texts are read
    whole, extra columns are carried along.
    """
    return spans.cut(docs, repeated_units(docs, key, text, units), key, text)


#: DuckDB: the same for runs of whole sentences and lines with 25 words; pieces end behind a sentence's space or a newline.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, string_split(regexp_replace(coalesce(text, ''), '([.!?][ \t\r]+|\n)', '\1' || chr(57344), 'g'), chr(57344)) AS ps FROM documents),
p AS (SELECT doc_id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS i FROM d),
w AS (SELECT *, regexp_extract_all(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM p),
c AS (SELECT *, len(ws) AS n, sum(len(ws)) OVER o AS upto, coalesce(sum(strlen(piece)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos,
    len(ws) > 0 OR coalesce(lag(len(ws)) OVER o, 0) > 0 AS may_end FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT a.doc_id, a.i AS a, min(b.i) AS b FROM c a JOIN c b ON a.doc_id = b.doc_id AND a.i <= b.i AND b.may_end AND b.upto - a.upto + a.n >= 25 AND b.upto - b.n - a.upto + a.n < 25 WHERE a.n > 0 GROUP BY ALL
  UNION SELECT a.doc_id, max(a.i), b.i FROM c a JOIN c b ON a.doc_id = b.doc_id AND a.i <= b.i AND b.may_end AND b.upto - a.upto + a.n >= 25 AND b.upto - a.upto < 25 WHERE a.n > 0 GROUP BY ALL),
u AS (SELECT f.doc_id, a, b, min(c.pos) AS start, array_to_string(flatten(list(c.ws ORDER BY c.i)), ' ') AS norm FROM f JOIN c ON c.doc_id = f.doc_id AND c.i BETWEEN a AND b GROUP BY ALL),
s AS (SELECT *, count(*) OVER (PARTITION BY norm) > 1 AS twice, row(doc_id, start) = min(row(doc_id, start)) OVER (PARTITION BY norm) AS is_first FROM u),
k AS (SELECT c.doc_id, c.i, c.piece, c.pos, strlen(c.piece) AS size, bool_or(s.a IS NOT NULL AND NOT is_first) AS gone, bool_or(s.a IS NOT NULL) AS shared
  FROM c LEFT JOIN s ON s.doc_id = c.doc_id AND twice AND c.i BETWEEN s.a AND s.b GROUP BY ALL),
g AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER o, false) AS opens, gone AND NOT coalesce(lead(gone) OVER o, false) AS shuts FROM k WINDOW o AS (PARTITION BY doc_id ORDER BY i))
SELECT doc_id, sum(size)::BIGINT AS n_bytes, coalesce(sum(size) FILTER (WHERE gone), 0)::BIGINT AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
  sha256(coalesce(string_agg(piece, '' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256,
  coalesce(array_to_string(list_transform(list_zip(list(pos ORDER BY i) FILTER (WHERE opens), list(pos + size ORDER BY i) FILTER (WHERE shuts)), lambda x: x[1]::BIGINT || '-' || x[2]::BIGINT), ','), '') AS spans,
  coalesce(sum(size) FILTER (WHERE shared), 0)::BIGINT AS n_shared
FROM g GROUP BY doc_id
"""
#: DuckDB: the same for lines of ten words or more.
LINE_ORACLE = r"""
WITH l AS (
  SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM documents),
w AS (SELECT *, regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words, max(place) OVER (PARTITION BY doc_id) AS lines FROM l),
u AS (SELECT *, line || CASE WHEN place < lines THEN chr(10) ELSE '' END AS unit, CASE WHEN len(words) >= 10 THEN array_to_string(words, ' ') END AS norm FROM w),
r AS (SELECT *, norm IS NOT NULL AND row_number() OVER (PARTITION BY norm ORDER BY doc_id, place) > 1 AS gone FROM u),
s AS (SELECT *, CASE WHEN gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY place), false) THEN 1 ELSE 0 END AS opens FROM r)
SELECT doc_id, sum(strlen(unit))::BIGINT AS n_bytes, coalesce(sum(strlen(unit)) FILTER (WHERE gone), 0)::BIGINT AS n_removed, sum(opens)::BIGINT AS n_spans,
  sha256(coalesce(string_agg(unit, '' ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM s GROUP BY doc_id
"""
