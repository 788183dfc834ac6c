"""Byte spans of texts: from a pass over the documents, and cut out of them again.

A document is known by its key and a hash of its text, so equal keys with different
texts stay apart.  Rows that are equal in both are one document that stands more
than once in the table: they count once and are all cut alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bytesets import utf8

#: The columns that name a document in the tables of spans.
ROW = ("_key", "_hash")


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(_key, _hash, _text) of each document, once."""
    return docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"), F.coalesce(text, F.lit("")).alias("_text"))


def scanned(docs: DataFrame, key: str, text: str, found: Callable[[bytes], list[list]], schema: str, types: list[pa.DataType]) -> DataFrame:
    """Rows of (_key, _hash, *schema): what ``found`` lists, column by column, for each text's bytes."""
    rows = keyed(docs, key, text)
    kind = rows.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            raw = memoryview(data)
            lo, held, size, counts = 0, [[] for _ in types], 0, []
            for row in range(batch.num_rows):
                columns = found(bytes(raw[offsets[row] : offsets[row + 1]]))
                for into, some in zip(held, columns):
                    into.extend(some)
                counts.append(len(columns[0]))
                size += counts[-1]
                if size > 50_000 or row == batch.num_rows - 1:
                    if size:
                        at = np.repeat(np.arange(lo, row + 1), counts)
                        own = [batch.column(c).take(pa.array(at)) for c in (0, 1)]
                        yield pa.RecordBatch.from_arrays([*own, *(pa.array(x, t) for x, t in zip(held, types))], names=[*ROW, *(c.split()[0] for c in schema.split(", "))])
                    lo, held, size, counts = row + 1, [[] for _ in types], 0, []

    return rows.mapInArrow(run, f"_key {kind}, _hash long, {schema}")


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["_key"].eqNullSafe(b["_key"]) & (a["_hash"] == b["_hash"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted spans with those that touch or overlap put together."""
    out: list[tuple[int, int]] = []
    for start, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def row_id(key: str, text: str) -> dict[str, Column]:
    """A document by one number, a hash of its key and text, beside the size of the text."""
    return {"_row": F.xxhash64(F.col(key), F.col(text)), "_size": F.coalesce(F.octet_length(text), F.lit(0))}


#: Name of the column of spans beside the packed columns of a table.
_SPANS = "__metriclab_spans"


def _with_spans(docs: DataFrame, spans: DataFrame, key: str, text: str) -> DataFrame:
    """``docs`` with their spans, which name a document by ``ROW`` or by ``row_id``.

    The columns of ``docs`` are packed, so none of their names can clash.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    if "_row" in spans.columns:
        names = ["_row", "_size"]
        marked = docs.select(whole, *[c.alias(n) for n, c in row_id(key, text).items()])
    else:
        names = list(ROW)
        marked = docs.select(whole, F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"))
    more = [F.col("first")] if "first" in spans.columns else []
    found = spans.distinct().groupBy(*names).agg(F.array_sort(F.collect_list(F.struct(*[F.col(c).cast("long").alias(c) for c in ("start", "end")], *more))).alias(_SPANS))
    first, second = names
    same = marked[first].eqNullSafe(found[first]) & (marked[second] == found[second])
    return marked.join(found, same, "left").select("_doc.*", _SPANS)


def cut(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the bytes of the spans; columns as before, null texts stay null.

    ``spans`` has rows of (_key, _hash, start, end) in bytes of the text.  A span ends
    and begins between characters, or what is left is read with replacement characters.
    """
    own = docs.columns
    at = own.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for row, spans in enumerate(batch.column(len(own)).to_pylist()):
                if spans and texts[row]:
                    raw, kept, last = texts[row].encode(), [], 0
                    for start, end in merged([(s["start"], s["end"]) for s in spans]):
                        kept.append(raw[last:start])
                        last = end
                    texts[row] = b"".join([*kept, raw[last:]]).decode("utf-8", "replace")
            columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[: len(own)])]
            yield pa.RecordBatch.from_arrays(columns, names=own)

    return _with_spans(docs, spans, key, text).mapInArrow(run, docs.schema)


def cut_digests(docs: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, spans): what cutting leaves of each row of ``docs``.

    Where ``spans`` have a column ``first``, those it marks stay, and a column n_shared
    counts the bytes of all of them.
    """
    more = "first" in spans.columns
    kind = docs.schema[key].dataType.simpleString()
    pairs = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            raw, out = memoryview(data), []
            for row, spans in enumerate(batch.column(2).to_pylist()):
                whole = raw[offsets[row] : offsets[row + 1]]
                runs = merged([(s["start"], s["end"]) for s in spans or () if not (more and s["first"])])
                shared = sum(e - s for s, e in merged([(s["start"], s["end"]) for s in spans or ()])) if more else 0
                kept, last = hashlib.sha256(), 0
                for start, end in runs:
                    kept.update(whole[last:start])
                    last = end
                kept.update(whole[last:])
                out.append((len(whole), sum(e - s for s, e in runs), len(runs), kept.hexdigest(), [{"start": s, "end": e} for s, e in runs], shared))
            if out:
                n, removed, count, digest, where, shared = zip(*out)
                arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in (n, removed, count)), pa.array(digest), pa.array(where, pairs), pa.array(shared, pa.int64())]
                names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "n_shared"]
                yield pa.RecordBatch.from_arrays(arrays[: 6 + more], names=names[: 6 + more])

    rows = _with_spans(docs.select(key, text), spans, key, text)
    return rows.mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>" + ", n_shared long" * more)
