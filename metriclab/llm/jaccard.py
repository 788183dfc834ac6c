"""Exact n-gram Jaccard join by grouped prefixes.

Documents are sets of hashed word shingles.  Shingles stand in one global order:
the rare ones by hash, then the frequent ones by count.  Two sets that are similar
enough share a shingle among the first of each, so candidates come from lists of
those prefixes only.  Sets with the same prefix and size form one group; lists hold
groups, and members are filled in where groups meet.

Inside a list, pairs pass a size bound and a parity bitmap bound, both exact: the
number of differing bits is never above the number of differing shingles.  Pairs
that pass are verified on the shingles of the texts themselves.

Links are only needed up to components, so verification goes in two rounds.  First
every set is verified against its two best partners; then, with the components that
gives, all remaining pairs across components are verified.  A pair inside one
component can't change the result, every other pair is decided exactly.  Lists longer
than ``cell`` are dealt out in cells, so no task holds a whole hot list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytesets import blocks, gram_hashes, mix, utf8, word_hashes, words
from .components import components
from .groups import by_key
from .scratch import dropped, written

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER_BYTES = _LOWER.tobytes()
#: Bytes of a place in the global order as it is stored, and the bit that sets frequent shingles behind all rare ones.
_PLACE_BYTES = 5
_TOP = np.uint64(1 << (8 * _PLACE_BYTES - 1))


@dataclass(frozen=True)
class JaccardJoin:
    """Sets link when ``100 * intersection >= percent * union``.

    At most ``frequent`` shingles are ordered by count, those that occur ``often`` times
    or more in some stretch of ``stretch`` shingles; this bounds what is broadcast and has
    no effect on the result.
    """

    shingle: int = 4
    percent: int = 85
    frequent: int = 1 << 17
    often: int = 2
    stretch: int = 2_000_000
    cell: int = 2048

    def prefix(self, n: int) -> int:
        """Shingles of a set of ``n`` that a similar set must meet."""
        return n - -(-self.percent * n // 100) + 1 if n else 0

    def similar(self, both: int, a: int, b: int) -> bool:
        return 100 * both >= self.percent * (a + b - both)

    def most_apart(self, total):
        """Largest symmetric difference of similar sets whose sizes sum to ``total``."""
        return (100 - self.percent) * total // (100 + self.percent)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block; A-Z lower-cased.

    A text with fewer words than ``size`` has its whole sequence as one shingle, one
    without words has none.
    """
    data = _LOWER[data]
    starts, ends, bounds = words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    grams, at = gram_hashes(hashes, bounds, size)
    cut = np.searchsorted(at, bounds)
    out = [np.unique(grams[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    for row in np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < size)):
        value = np.zeros(1, dtype=np.uint64)
        for h in hashes[bounds[row] : bounds[row + 1]]:
            value = mix(value + h)
        out[row] = value
    return out


def exact_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """As ``shingle_sets``, with numbers that agree between the texts exactly where the words do.

    Words are numbered by their bytes; sequences are numbered word by word.
    """
    numbers: dict[bytes, int] = {}
    listed = [[numbers.setdefault(w, len(numbers)) for w in t.translate(_LOWER_BYTES).split()] for t in texts]
    counts = np.array([len(x) for x in listed], dtype=np.int64)
    ids = np.fromiter((i for x in listed for i in x), dtype=np.int64, count=int(counts.sum()))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    value = ids.copy()
    for k in range(1, size):
        value = value[: max(0, len(ids) - k)] * (len(numbers) + 1) + ids[k:]
        value = np.unique(value, return_inverse=True)[1].astype(np.int64)  # below 2**31, so the next product is exact
    whole: dict[tuple[int, ...], int] = {}
    out = []
    for a, b, n, own in zip(bounds[:-1], bounds[1:], counts, listed):
        if n >= size:
            out.append(np.unique(value[a : b - size + 1]))
        else:  # such sequences count from -1 down, apart from those of ``size`` words
            out.append(np.array([-1 - whole.setdefault(tuple(own), len(whole))] if n else [], dtype=np.int64))
    return out


def frequent_shingles(docs: DataFrame, text: str, rules: JaccardJoin) -> np.ndarray:
    """The most frequent shingles, rarest first.  Each stretch of a task counts its own; at most ``frequent`` are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def counted() -> pa.RecordBatch:
            values = np.concatenate(held)
            held.clear()
            values.sort()
            first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
            counts = np.diff(first, append=len(values))
            often = counts >= rules.often
            return pa.RecordBatch.from_arrays([pa.array(values[first[often]].view(np.int64)), pa.array(counts[often])], names=["shingle", "n"])

        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for _, _, part, at in blocks(data, offsets):
                sets = shingle_sets(part, at, rules.shingle)
                held.extend(sets)
                size += sum(map(len, sets))
                if size >= rules.stretch:
                    yield counted()
                    size = 0
        if size:
            yield counted()

    counts = written(docs.select(text).mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")), "counts")
    # a histogram in steps of an eighth of a doubling tells from which count on at most ``frequent`` are left
    step = F.floor(F.log2("n") * 8).cast("int")
    least, total = None, 0
    for r in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        if (total := total + r["count"]) > rules.frequent:
            break
        least = r["step"]
    top = counts.filter(step >= least).toPandas().sort_values(["n", "shingle"]) if least is not None else None
    dropped(docs.sparkSession, counts)
    return top["shingle"].to_numpy(dtype=np.int64).view(np.uint64).copy() if top is not None else np.zeros(0, np.uint64)


def _ordered(tokens: np.ndarray, known: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Places of shingles in the global order, rare ones by the first bits of their hash.

    Shingles that agree in those bits share a place and so a list, which only adds candidates.
    """
    out = tokens >> np.uint64(65 - 8 * _PLACE_BYTES)
    if len(known):
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        hit = known[at] == tokens
        out[hit] = _TOP | place[at[hit]]
    return out


def _packed(places: np.ndarray) -> bytes:
    return places.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_PLACE_BYTES].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // _PLACE_BYTES, 8), dtype=np.uint8)
    out[:, :_PLACE_BYTES] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, _PLACE_BYTES)
    return out.view("<i8").ravel()


def bitmap(tokens: np.ndarray) -> bytes:
    """Parities of the shingles in a power of two of bits, twice their number or more."""
    bits = 512
    while bits < 2 * len(tokens):
        bits *= 2
    count = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8), bitorder="little").tobytes()


def sets_table(docs: DataFrame, key: str, text: str, rules: JaccardJoin) -> DataFrame:
    """(_key, n, set, gid, prefix, bits) of every document; ``set`` and ``gid`` are digests, null for an empty set."""
    ranked = frequent_shingles(docs, text, rules)
    order = np.argsort(ranked)
    spread = docs.sparkSession.sparkContext.broadcast((ranked[order], order.astype(np.uint64)))
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(text, F.lit("")).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place = spread.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for lo, hi, part, at in blocks(data, offsets):
                out = []
                for tokens in shingle_sets(part, at, rules.shingle):
                    n = len(tokens)
                    if not n:
                        out.append((0, None, None, None, None))
                        continue
                    prefix = _packed(np.sort(_ordered(tokens, known, place))[: rules.prefix(n)])
                    gid = int.from_bytes(hashlib.blake2b(prefix + n.to_bytes(8, "little"), digest_size=8).digest(), "little", signed=True)
                    out.append((n, hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(), gid, prefix, bitmap(tokens)))
                n, *rest = zip(*out)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), *(pa.array(c, t) for c, t in zip(rest, (pa.binary(), pa.int64(), pa.binary(), pa.binary())))], names=["_key", "n", "set", "gid", "prefix", "bits"])

    return rows.mapInArrow(run, f"_key {kind}, n long, set binary, gid long, prefix binary, bits binary")


def _cells(sets: DataFrame, nodes: DataFrame, rules: JaccardJoin) -> DataFrame:
    """(list, cell, cells, set): prefix lists with two sets or more, long ones in several cells.

    Lists that hold the same two groups come once.
    """
    members = nodes.groupBy("gid").agg(F.count("*").alias("members"))
    groups = sets.filter("n > 0").select("gid", "prefix").distinct().join(members, "gid")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                some = batch.slice(lo, 1000)
                raw = some.column(2).to_pylist()
                raw = [_packed(np.unique(_unpacked(p))) for p in raw]  # a place that two shingles share is listed once
                at = pa.array(np.repeat(np.arange(some.num_rows), [len(p) // _PLACE_BYTES for p in raw]))
                yield pa.RecordBatch.from_arrays([pa.array(_unpacked(b"".join(raw))), *(some.column(c).take(at) for c in range(2))], names=["list", "gid", "members"])

    postings = groups.select("gid", "members", "prefix").mapInArrow(listed, "list long, gid long, members long")
    counts = postings.groupBy("list").agg(F.sum("members").alias("sets"), F.count("*").alias("n_groups")).filter("sets >= 2")
    shared = written(postings.select("list", "gid").join(counts, "list"), "lists")
    couples = shared.filter("n_groups <= 2").groupBy("list").agg(F.min("gid").alias("a"), F.max("gid").alias("b")).select("a", "b").distinct()
    couples = couples.select(F.xxhash64("a", "b").alias("list"), F.explode(F.array_distinct(F.array("a", "b"))).alias("gid"))
    couples = couples.join(members, "gid")
    of_two = couples.groupBy("list").agg(F.ceil(F.sum("members") / rules.cell).cast("int").alias("cells"))
    couples = couples.join(of_two, "list").select("list", "cells", "gid")
    longer = shared.filter("n_groups > 2").select("list", F.ceil(F.col("sets") / rules.cell).cast("int").alias("cells"), "gid")
    cells = longer.unionByName(couples).join(nodes.select("gid", "set"), "gid")
    return cells.select("list", F.pmod(F.xxhash64("set"), F.col("cells")).cast("int").alias("cell"), "cells", "set")


def _near(bits: list[bytes], sizes: np.ndarray, rules: JaccardJoin, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs (i, j, differing bits) with i in ``rows`` that pass the size and the bitmap bound, part by part."""
    width = np.array([len(b) for b in bits])
    packed = {w: np.frombuffer(b"".join(bits[i] for i in np.flatnonzero(width == w)), dtype=np.uint64).reshape(-1, w // 8) for w in np.unique(width)}
    where = {w: np.flatnonzero(width == w) for w in packed}
    for w, left in packed.items():
        own = np.flatnonzero(np.isin(where[w], rows))
        for v, right in packed.items():
            if not (v == w or v == 2 * w or w == 2 * v) or not len(own):
                continue
            to = min(v, w) // 8
            fold = lambda m: m if m.shape[1] == to else m[:, :to] ^ m[:, to:]
            a, b = fold(left[own]), fold(right)
            step = max(1, (1 << 21) // max(1, b.size))
            for lo in range(0, len(a), step):
                apart = np.bitwise_count(a[lo : lo + step, None, :] ^ b[None, :, :]).sum(axis=2, dtype=np.int64)
                na, nb = sizes[where[w][own[lo : lo + step]]], sizes[where[v]]
                fits = (apart <= rules.most_apart(na[:, None] + nb[None, :])) & (100 * nb[None, :] >= rules.percent * na[:, None]) & (100 * na[:, None] >= rules.percent * nb[None, :])
                i, j = np.nonzero(fits)
                gi, gj = where[w][own[lo + i]], where[v][j]
                real = gi != gj
                yield gi[real], gj[real], apart[i, j][real]


def _dealt(cells: DataFrame, nodes: DataFrame) -> DataFrame:
    """Cells with sizes and bitmaps, each whole in one task."""
    return cells.join(nodes.select("set", "n", "bits"), "set").repartition("list", "cell").sortWithinPartitions("list", "cell", "set")


def _best_partners(cells: DataFrame, nodes: DataFrame, rules: JaccardJoin) -> DataFrame:
    """(a, b): each set with the partner that has most partners itself, and with the closest one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in by_key(batches, ["list", "cell"]):
            sets, sizes, bits = table.column("set").to_pylist(), table.column("n").to_numpy(), table.column("bits").to_pylist()
            out = []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if hi - lo < 2:
                    continue
                m = int(hi - lo)
                degree = np.zeros(m, dtype=np.int64)
                found = list(_near(bits[lo:hi], sizes[lo:hi], rules, np.arange(m)))
                for i, _, _ in found:
                    degree += np.bincount(i, minlength=m)
                if not degree.any():
                    continue
                i, j, d = (np.concatenate(c) for c in zip(*found))
                for order in (np.lexsort((j, -degree[j], i)), np.lexsort((j, d, i))):
                    first = order[np.flatnonzero(np.diff(i[order], prepend=-1))]
                    out.extend((sets[lo + x], sets[lo + y], int(degree[y]), int(z)) for x, y, z in zip(i[first], j[first], d[first]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.binary(), pa.int64(), pa.int64()))], names=["a", "b", "degree", "apart"])

    found = _dealt(cells, nodes).mapInArrow(run, "a binary, b binary, degree long, apart long")
    best = found.groupBy("a").agg(F.max(F.struct("degree", "b"))["b"].alias("hub"), F.min(F.struct("apart", "b"))["b"].alias("close"))
    both = best.select("a", F.explode(F.array_distinct(F.array("hub", "close"))).alias("b"))
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _across(cells: DataFrame, nodes: DataFrame, seen: DataFrame, labels: DataFrame, rules: JaccardJoin) -> DataFrame:
    """(a, b): all pairs that pass the bounds and lie in different components.

    ``seen`` lists the pairs of best partners.  In a list of one cell every pair that passes
    was found before, so both its sets are in ``seen``.  In a list of several cells the
    sets outside its largest component visit every cell; those inside need not meet.
    """
    ends = seen.select(F.col("a").alias("set")).union(seen.select(F.col("b").alias("set"))).distinct()
    cells = cells.filter("cells = 1").join(ends, "set", "left_semi").unionByName(cells.filter("cells > 1"))
    named = cells.join(labels, cells["set"] == labels["node"], "left").withColumn("label", F.coalesce("component", "set")).drop("node", "component")
    mixed = named.groupBy("list").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("list")
    named = named.join(mixed, "list")
    parts = named.filter("cells > 1").groupBy("list", "label").agg(F.count("*").alias("k"))
    main = parts.groupBy("list").agg(F.max(F.struct("k", "label"))["label"].alias("main"))
    split = named.filter("cells > 1").join(main, "list").withColumn("visits", F.col("label") != F.col("main")).drop("main")
    guests = split.filter("visits").withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    rows = named.filter("cells = 1").withColumn("visits", F.lit(True)).unionByName(split.filter("not visits")).unionByName(guests)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in by_key(batches, ["list", "cell"]):
            sets, labels, visits = (table.column(c).to_pylist() for c in ("set", "label", "visits"))
            sizes, bits = table.column("n").to_numpy(), table.column("bits").to_pylist()
            out = set()
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                if hi - lo > 1:
                    number: dict[bytes, int] = {}
                    own = np.array([number.setdefault(x, len(number)) for x in labels[lo:hi]])
                    for i, j, _ in _near(bits[lo:hi], sizes[lo:hi], rules, np.flatnonzero(visits[lo:hi])):
                        apart = own[i] != own[j]
                        out.update((min(sets[lo + x], sets[lo + y]), max(sets[lo + x], sets[lo + y])) for x, y in zip(i[apart], j[apart]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], names=["a", "b"])

    return _dealt(rows, nodes).mapInArrow(run, "a binary, b binary").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, first: DataFrame, text: str, key: str, rules: JaccardJoin) -> DataFrame:
    """The pairs whose sets are similar, on the words of the texts.  ``first`` names a document for each set."""
    ends = pairs.select(F.col("a").alias("set")).union(pairs.select(F.col("b").alias("set"))).distinct()
    wanted = first.join(ends, "set").select("set", "_key", "_hash").hint("merge")  # as many rows as sets that have a partner
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"))
    texts = rows.join(wanted, rows["_key"].eqNullSafe(wanted["_key"]) & (rows["_hash"] == wanted["_hash"])).select("set", "_text")
    texts = written(texts.dropDuplicates(["set"]), "texts")
    joined = pairs.join(texts.select(F.col("set").alias("a"), F.col("_text").alias("left")), "a").join(texts.select(F.col("set").alias("b"), F.col("_text").alias("right")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 50):
                some = batch.slice(lo, 50)
                texts = [t.encode() for c in (2, 3) for t in some.column(c).to_pylist()]
                sets = exact_sets(texts, rules.shingle)
                left, right = sets[: some.num_rows], sets[some.num_rows :]
                keep = [rules.similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)) for x, y in zip(left, right)]
                yield pa.RecordBatch.from_arrays([some.column(c).filter(pa.array(keep)) for c in (0, 1)], names=["a", "b"])

    return written(joined.select("a", "b", "left", "right").mapInArrow(run, "a binary, b binary"), "similar")


def with_components(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: JaccardJoin = JaccardJoin()) -> DataFrame:
    """(key, n_shingles, component_id) of every row of ``docs``.

    ``component_id`` is the smallest key reachable by links.  Null and empty texts and
    those without words have no shingles and are linked with nothing: their component
    is their own key.  Repeated rows share a set and so a component.  Null keys count
    only where a component has no other.
    """
    found = written(_tagged(docs, key, text, rules), "sets")
    nodes = found.filter("n > 0").groupBy("set").agg(F.first("n").alias("n"), F.first("gid").alias("gid"), F.first("bits").alias("bits"), F.min(F.struct("_key", "_hash")).alias("first"))
    nodes = written(nodes, "nodes")
    first = nodes.select("set", "first._key", "first._hash")
    cells = written(_cells(found, nodes, rules), "cells")
    best = written(_best_partners(cells, nodes, rules), "pairs")
    links = _verified(best, docs, first, text, key, rules)
    labels = components(links)
    across = written(_across(cells, nodes, best, labels, rules), "pairs")
    dropped(docs.sparkSession, cells)
    if not across.isEmpty():
        labels = components(links.union(_verified(across, docs, first, text, key, rules)))
    rows = found.select("_key", "n", "set").join(labels, F.col("set") == F.col("node"), "left").withColumn("label", F.coalesce("component", "set"))
    least = rows.filter("label is not null").groupBy("label").agg(F.min("_key").alias("least"))
    least = written(least, "least")  # both sides of the join are then plain shuffles, whose hot partitions the engine splits
    rows = rows.join(least, "label", "left")
    own = F.when(F.col("label").isNull(), F.col("_key")).otherwise(F.col("least"))
    return rows.select(F.col("_key").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"))


def _tagged(docs: DataFrame, key: str, text: str, rules: JaccardJoin) -> DataFrame:
    """``sets_table`` with a hash of the text, which with the key finds the text again."""
    paired = docs.select(F.struct(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash")).alias("row"), F.col(text).alias("text"))
    return sets_table(paired, "row", "text", rules).select("_key._key", "_key._hash", "n", "set", "gid", "prefix", "bits")


#: DuckDB, for tables of test size: all pairs that share a shingle, and a walk over the links.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
u AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 2)) AS i FROM d WHERE len(ws) >= 4),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + 3], ' ') AS g FROM u UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.a = d.doc_id GROUP BY d.doc_id
"""


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: JaccardJoin = JaccardJoin()) -> DataFrame:
    """The rows of ``docs`` that stand for their component, with the columns of ``docs``: those of the smallest key.

    A row without shingles always stays.  Rows of one key with different texts are judged
    by the key; of rows repeated with equal key and text all stay.
    """
    kept = with_components(docs, key, text, rules).filter(F.col(key).eqNullSafe(F.col("component_id"))).select(F.col(key).alias("_kept")).distinct()
    return docs.join(kept, docs[key].eqNullSafe(kept["_kept"]), "left_semi")
