"""Line dedup by chunks of lines.

Every line may begin or end a chunk, so the same run of lines is found wherever it
stands; chunks overlap and what they cover together goes.  Chunks whose digest
repeats anywhere are fetched and compared byte by byte; all but the earliest of
equal chunks are removed.  The earliest place of a line always stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .bytesets import utf8
from .scratch import written
from .windows import smallest


@dataclass(frozen=True)
class Chunks:
    """A chunk is a smallest window of ``min_lines`` lines and ``min_words`` words, from any line on or back from any line."""

    min_lines: int = 2
    min_words: int = 10

    def listed(self, text: bytes) -> list[list]:
        """Digest, start and end of each chunk; a line includes its newline."""
        digests, starts, ends = [], [], []
        lines = text.removesuffix(b"\n").split(b"\n")
        places = [0]
        for line in lines:
            places.append(places[-1] + len(line) + 1)
        for first, last in smallest([len(line.split()) for line in lines], self.min_lines, self.min_words):
            begin, end = places[first], min(places[last + 1], len(text))
            # without the last newline, so that a chunk at the end of a text equals one inside
            digests.append(hashlib.blake2b(text[begin : places[last + 1] - 1], digest_size=16).digest())
            starts.append(begin)
            ends.append(end)
        return [digests, starts, ends]


def _fetched(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """``wanted`` (_key, _hash, digest, start, end, first) with the bytes of the chunks."""
    kind = wanted.schema["_key"].dataType.simpleString()
    lists = wanted.distinct().groupBy(*spans.ROW).agg(F.collect_list(F.struct("digest", "start", "end", "first")).alias("_chunks"))
    rows = spans.keyed(docs, key, text)
    rows = rows.join(lists, spans.same_row(rows, lists)).select(rows["_key"], rows["_hash"], "_text", "_chunks")
    names = [*spans.ROW, "digest", "start", "end", "first", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                some = batch.slice(lo, 200)
                data, offsets = utf8(some.column(2))
                raw, out, at = memoryview(data), [], []
                for row, listed in enumerate(some.column(3).to_pylist()):
                    whole = raw[offsets[row] : offsets[row + 1]]
                    for c in listed:
                        out.append((c["digest"], c["start"], c["end"], c["first"], bytes(whole[c["start"] : c["end"]]).removesuffix(b"\n")))
                        at.append(row)
                if out:
                    own = [some.column(c).take(pa.array(at)) for c in (0, 1)]
                    kinds = (pa.binary(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
                    yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, t) for c, t in zip(zip(*out), kinds))], names=names)

    return rows.mapInArrow(run, f"_key {kind}, _hash long, digest binary, start int, end int, first boolean, body binary")


def repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", chunks: Chunks = Chunks()) -> DataFrame:
    """(_key, _hash, start, end) of all chunks but the earliest of those with equal bytes.

    Digests only choose what to fetch: a chunk is removed if the earliest one with
    its digest has the same bytes.  Chunks of one digest with other bytes stay.
    """
    found = written(spans.scanned(docs, key, text, chunks.listed, "digest binary, start int, end int", [pa.binary(), pa.int32(), pa.int32()]), "chunks")
    place = F.struct("_key", "_hash", "start")
    earliest = found.groupBy("digest").agg(F.count("*").alias("n"), F.min(place).alias("earliest")).filter("n > 1").select("digest", "earliest")
    earliest = written(earliest, "firsts")  # both sides of the join are then plain shuffles, whose hot partitions the engine splits
    wanted = found.join(earliest, "digest").withColumn("first", place.eqNullSafe(F.col("earliest"))).drop("earliest")
    body = written(_fetched(docs, wanted, key, text), "chunk-bytes")
    heads = body.filter("first").groupBy("digest").agg(F.first("body").alias("head"))
    heads = written(heads, "heads")  # as above
    return body.filter("not first").join(heads, "digest").filter(F.col("body") == F.col("head")).select(*spans.ROW, "start", "end")


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", chunks: Chunks = Chunks()) -> DataFrame:
    """``docs`` without repeated chunks, with the columns of ``docs``.

    A null or empty text, and one of a single line, stays as it is; a document that
    loses everything stays with an empty text.  Rows equal in key and text are one
    document and are cut alike.  Texts are read whole; extra columns are carried.
    """
    return spans.cut(docs, repeated_chunks(docs, key, text, chunks), key, text)


#: DuckDB: the same windows of lines, told by their whole bytes.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, ends_with(coalesce(text, ''), chr(10)) AS closed FROM documents),
e AS (SELECT doc_id, closed, string_split(CASE WHEN closed THEN left(text, length(text) - 1) ELSE text END, chr(10)) AS ls FROM d),
p AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i, closed OR generate_subscripts(ls, 1) < len(ls) AS broken FROM e),
w AS (SELECT *, line || CASE WHEN broken THEN chr(10) ELSE '' END AS piece, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM p),
c AS (SELECT *, sum(n) OVER o AS upto, coalesce(sum(strlen(piece)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos,
    n > 0 OR coalesce(lag(n) OVER o, 0) > 0 AS may_end FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT a.doc_id, a.i AS a, min(b.i) AS b FROM c a JOIN c b ON a.doc_id = b.doc_id AND a.i < b.i AND b.may_end AND b.upto - a.upto + a.n >= 10 AND (b.upto - b.n - a.upto + a.n < 10 OR b.i = a.i + 1) WHERE a.n > 0 GROUP BY ALL
  UNION SELECT a.doc_id, max(a.i), b.i FROM c a JOIN c b ON a.doc_id = b.doc_id AND a.i < b.i AND b.may_end AND b.upto - a.upto + a.n >= 10 AND (b.upto - a.upto < 10 OR b.upto - b.n = a.upto) WHERE a.n > 0 GROUP BY ALL),
u AS (SELECT f.doc_id, a, b, min(c.pos) AS start, string_agg(c.line, chr(10) ORDER BY c.i) AS body FROM f JOIN c ON c.doc_id = f.doc_id AND c.i BETWEEN a AND b GROUP BY ALL),
s AS (SELECT doc_id, a, b, row(doc_id, start) = min(row(doc_id, start)) OVER (PARTITION BY body) AS is_first FROM u),
k AS (SELECT c.doc_id, c.i, c.piece, c.pos, strlen(c.piece) AS size, bool_or(s.a IS NOT NULL) AS gone FROM c LEFT JOIN s ON s.doc_id = c.doc_id AND NOT is_first AND c.i BETWEEN s.a AND s.b GROUP BY ALL),
g AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER o, false) AS opens, gone AND NOT coalesce(lead(gone) OVER o, false) AS shuts FROM k WINDOW o AS (PARTITION BY doc_id ORDER BY i))
SELECT doc_id, sum(size)::BIGINT AS n_bytes, coalesce(sum(size) FILTER (WHERE gone), 0)::BIGINT AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
  sha256(coalesce(string_agg(piece, '' ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256,
  coalesce(array_to_string(list_transform(list_zip(list(pos ORDER BY i) FILTER (WHERE opens), list(pos + size ORDER BY i) FILTER (WHERE shuts)), lambda x: x[1]::BIGINT || '-' || x[2]::BIGINT), ','), '') AS spans
FROM g GROUP BY doc_id
"""
