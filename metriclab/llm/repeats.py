"""Removal of long repeated byte strings by suffix sorting.

Where a string of ``length`` bytes can repeat is told by its anchor (see ``anchors``).
Anchors of one hash are shards of the sort: their contexts hold every string that could
meet another there.  If all contexts of a hash are equal, all of them repeats; else the
different contexts are put together and their suffixes sorted (see ``suffixes``).

Every step groups by a hash and is linear in the texts.  Contexts that occur often are
counted, not gathered; a hash with very many different contexts is cut into finer shards
by the bytes that all strings of a slice of it share.  Where even such a slice is larger
than ``shard`` bytes, its single strings are grouped by a digest, so that no task holds more
whatever the texts share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import spans
from .anchors import Anchors
from .bytesets import blocks, mix, prefix_hash, span_hash, utf8
from .groups import by_key
from .scratch import dropped, written
from .suffixes import repeated_starts


@dataclass(frozen=True)
class Repeats:
    """``shard`` is about the bytes sorted together; a hash with over ``crowd`` contexts is cut in ``slices``, and a larger slice in strings."""

    anchors: Anchors = field(default_factory=Anchors)
    shard: int = 2_000_000
    held: int = 1 << 22
    crowd: int = 1000
    slices: int = 8


#: Rows that are handed over at once.
HANDED = 20_000


def anchor_table(docs: DataFrame, key: str, text: str, rules: Repeats) -> DataFrame:
    """(_row, _size, h, context, lo, shape, last, n): hash and context of anchors.

    ``lo`` and ``shape`` place the context and the anchor in it.  In a periodic text equal
    contexts follow one another; such a run is one row with ``n`` anchors that ends at ``last``.
    """
    rows = docs.select(*[c.alias(n) for n, c in spans.row_id(key, text).items()], F.coalesce(text, F.lit("")).alias("_text"))
    names = ["_row", "_size", "h", "context", "lo", "shape", "last", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for first, _, part, at in blocks(data, offsets):
                pieces = rules.anchors.parts(np.diff(at))
                # a long text comes alone, in pieces; short ones are looked at together
                group = 1 if len(at) == 2 else max(len(pieces), 1)
                for k in range(0, len(pieces), group):
                    some = pieces[k : k + group]
                    text = np.concatenate([part[at[r] + s : at[r] + e] for r, s, e in some])
                    ends = np.cumsum([e - s for _, s, e in some])
                    h, place, lo, hi, context = rules.anchors.found(text, ends)
                    which = np.searchsorted(ends, place, side="right")
                    base = np.array([s for _, s, _ in some]) - np.concatenate([[0], ends[:-1]])
                    if not len(place):
                        continue
                    opens = np.ones(len(place), dtype=bool)
                    opens[1:] = (h[1:] != h[:-1]) | (context[1:] != context[:-1]) | (which[1:] != which[:-1]) | (lo[1:] > hi[:-1])
                    at_first = np.flatnonzero(opens)
                    at_last = np.append(at_first[1:], len(place)) - 1
                    rows = pa.array(first + np.array([r for r, _, _ in some])[which[at_first]])
                    shift = base[which[at_first]]
                    numbers = (lo[at_first] + shift, (((place - lo) << 16) | (hi - lo))[at_first], hi[at_last] + shift, at_last - at_first + 1)
                    hashes = (pa.array(x[at_first].view(np.int64)) for x in (h, context))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *hashes, *(pa.array(x.astype(np.int32)) for x in numbers)], names=names)

    return rows.mapInArrow(run, "_row long, _size int, h long, context long, lo int, shape int, last int, n int")


def _bodies(docs: DataFrame, wanted: DataFrame, key: str, text: str, rules: Repeats) -> DataFrame:
    """(shard, _row, _size, offset, alone, body): bytes of the contexts in ``wanted``, crowded ones in slices."""
    lists = wanted.groupBy("_row", "_size").agg(F.collect_list(F.struct("h", "lo", "shape", "alone", "crowded")).alias("_list"))
    rows = docs.select(*[c.alias(n) for n, c in spans.row_id(key, text).items()], F.col(text).alias("_text"))
    rows = rows.join(lists.hint("merge"), ["_row", "_size"]).select("_row", "_size", "_text", "_list")
    length, gram = rules.anchors.length, rules.anchors.gram
    span = length - gram + 1
    width = -(-span // rules.slices)
    names = ["_row", "_size", "shard", "offset", "alone", "body"]
    kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.binary())

    def cut(whole: bytes, c: dict) -> Iterator[tuple[int, int, bytes]]:
        lo, left, size = c["lo"], c["shape"] >> 16, c["shape"] & 0xFFFF
        if not c["crowded"]:
            yield c["h"], lo, whole[lo : lo + size]
            return
        body = np.frombuffer(whole[lo : lo + size], dtype=np.uint8)
        prefix = prefix_hash(body)
        for s in range(0, span, width):
            last = min(span - 1, s + width - 1)  # strings that begin s to last bytes before the anchor
            a, b = max(0, left - last), min(left - s, size - length)
            if a <= b:
                core = span_hash(prefix, np.array([left - s]), np.array([left - last + length]))
                shard = mix(core ^ np.uint64((c["h"] + s) & (2**64 - 1)))
                yield int(shard.view(np.int64)[0]), lo + a, body[a : b + length].tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 100):
                some = batch.slice(lo, 100)
                data, offsets = utf8(some.column(2))
                out, at = [], []

                def handed() -> pa.RecordBatch:
                    rows = pa.array(at)
                    columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
                    found = pa.RecordBatch.from_arrays([some.column(0).take(rows), some.column(1).take(rows), *columns], names=names)
                    out.clear()
                    at.clear()
                    return found

                for row, listed in enumerate(some.column(3)):
                    whole = data[offsets[row] : offsets[row + 1]].tobytes()
                    for c in listed.as_py():
                        for shard, offset, body in cut(whole, c):
                            out.append((shard, offset, c["alone"], body))
                            at.append(row)
                        if len(out) >= HANDED:
                            yield handed()
                if out:
                    yield handed()

    return rows.mapInArrow(run, "_row long, _size int, shard long, offset int, alone boolean, body binary")


def _string_spans(bodies: DataFrame, rules: Repeats) -> DataFrame:
    """(_row, _size, start, end) of the single strings in ``bodies`` that occur elsewhere, told by 128 bits of a digest."""
    length = rules.anchors.length
    names = ["_row", "_size", "start", "alone", "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                some = batch.slice(lo, 500)
                rows, starts, digests = [], [], []
                for row, (offset, body) in enumerate(zip(some.column(2).to_pylist(), some.column(4).to_pylist())):
                    for at in range(len(body) - length + 1):
                        rows.append(row)
                        starts.append(offset + at)
                        digests.append(hashlib.blake2b(body[at : at + length], digest_size=16).digest())
                own = [some.column(c).take(pa.array(rows, pa.int64())) for c in (0, 1, 3)]
                yield pa.RecordBatch.from_arrays([own[0], own[1], pa.array(starts, pa.int64()), own[2], pa.array(digests, pa.binary())], names=names)

    strings = bodies.select("_row", "_size", "offset", "alone", "body").mapInArrow(run, "_row long, _size int, start long, alone boolean, digest binary")
    strings = written(strings, "strings")
    place = F.struct("_row", "_size", "start")
    # bodies of one text may overlap, so a string counts as repeated only if it has two places
    twice = strings.groupBy("digest").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a <> b").select("digest")
    found = strings.filter("alone").join(written(twice, "repeated").hint("merge"), "digest")
    return found.select("_row", "_size", "start", (F.col("start") + length).alias("end"))


def _sorted_spans(bodies: DataFrame, rules: Repeats) -> DataFrame:
    """(_row, _size, start, end) found by sorting the suffixes of each shard."""
    length = rules.anchors.length
    names = ["_row", "_size", "start", "end"]

    def spans_of(table: pa.Table) -> pa.RecordBatch | None:
        rows, sizes, offsets = (table.column(c).to_numpy() for c in ("_row", "_size", "offset"))
        alone, bodies = table.column("alone").to_pylist(), table.column("body").to_pylist()
        out = []
        for k, starts in enumerate(repeated_starts(bodies, rows, offsets.astype(np.int64), length, rules.held)):
            if alone[k] and len(starts):
                breaks = np.flatnonzero(np.diff(starts) > length) + 1
                for a, b in zip([0, *breaks.tolist()], [*breaks.tolist(), len(starts)]):
                    out.append((rows[k], sizes[k], offsets[k] + starts[a], offsets[k] + starts[b - 1] + length))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=names) if out else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for table, bounds in by_key(batches, ["shard"]):
            bytes_of = np.concatenate([[0], np.cumsum(pc.binary_length(table.column("body")).to_numpy())])
            begin = 0
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if size and size + bytes_of[hi] - bytes_of[begin] > rules.shard:
                    held.append(table.slice(begin, lo - begin))
                    if (found := spans_of(pa.concat_tables(held).combine_chunks())) is not None:
                        yield found
                    held, size, begin = [], 0, lo
                size += int(bytes_of[hi] - bytes_of[lo])
            held.append(table.slice(begin))
        if size and (found := spans_of(pa.concat_tables(held).combine_chunks())) is not None:
            yield found

    return bodies.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "_row long, _size int, start long, end long")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Repeats = Repeats()) -> DataFrame:
    """(_row, _size, start, end): bytes covered by a string of ``length`` bytes that occurs elsewhere.

    All occurrences are listed, the first as well; those inside one text count like
    others.  Spans may overlap.  Null texts and those shorter than ``length`` have none.
    Rows repeated with equal key and text repeat each other.
    """
    table = written(anchor_table(docs, key, text, rules), "anchors")
    groups = table.groupBy("h").agg(F.sum("n").alias("n"), F.min("context").alias("a"), F.max("context").alias("b")).filter("n > 1").select("h", (F.col("a") == F.col("b")).alias("equal"))
    groups = written(groups, "hashes")  # both sides of the join are then plain shuffles, whose hot partitions the engine splits
    shared = written(table.join(groups.hint("merge"), "h"), "shared")
    dropped(docs.sparkSession, table, groups)
    place = ["_row", "_size", F.col("lo").cast("long").alias("start"), F.col("last").cast("long").alias("end")]
    differ = shared.filter("not equal")
    contexts = differ.groupBy("h", "context").agg(F.sum("n").alias("n"), F.min(F.struct("_row", "_size", "lo", "shape")).alias("one"))
    contexts = written(contexts, "contexts")
    crowds = written(contexts.groupBy("h").agg(F.count("*").alias("m")).filter(F.col("m") > rules.crowd), "crowds")
    wanted = contexts.join(crowds.hint("merge"), "h", "left").select("h", "one.*", (F.col("n") == 1).alias("alone"), F.col("m").isNotNull().alias("crowded"))
    several = contexts.filter("n > 1").select("h", "context")
    whole = shared.filter("equal").select(*place).union(differ.join(several, ["h", "context"]).select(*place))
    bodies = written(_bodies(docs, wanted, key, text, rules), "bodies")
    large = written(bodies.groupBy("shard").agg(F.sum(F.length("body")).alias("n")).filter(F.col("n") > rules.shard).select("shard"), "large")
    if large.isEmpty():
        return whole.union(_sorted_spans(bodies, rules))
    return whole.union(_sorted_spans(bodies.join(large, "shard", "left_anti"), rules)).union(_string_spans(bodies.join(large, "shard"), rules))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Repeats = Repeats()) -> DataFrame:
    """``docs`` without those bytes, with the columns of ``docs``.

    A cut inside a character leaves replacement characters.  Extra columns are carried;
    a text that is all repeated is empty.
    """
    return spans.cut(docs, repeated_spans(docs, key, text, rules), key, text)
