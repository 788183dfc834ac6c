"""Exact near-dedup of embeddings: a metric range join over pivot cells.

Vectors are put on the unit sphere, where the angle is a metric.  Each belongs to the
cell of its nearest pivot.  If x lies in cell c and y in cell d at an angle of at most
r from x, the triangle inequality gives angle(y, c) <= angle(y, d) + 2 r; only such
cells does y visit, and of a pair's two cells only the one with the lower number.  As
the sphere lies in a flat space, y must also be no farther than the chord of r from
the plane halfway between c and d.

Equal vectors are one class with a count, so thousands of copies cost one row.  The
vectors of a cell lie in blocks, each written once with the cells that its vectors
visit.  Blocks that must meet are paired where they are read, so a vector that visits
many cells isn't copied to them, and the disk holds what the vectors take.  Pairs of
vectors are never emitted: a task gives counts of links and a spanning set of links.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .components import components
from .groups import by_key
from .scratch import dropped, written

#: Bytes of vectors in a file of blocks, so many that a task can hold two.
FILE_BYTES = 4 << 20


@dataclass(frozen=True)
class RangeJoin:
    """Vectors link at a cosine of ``least`` or more.  At most ``pivots`` vectors are drawn as pivots and broadcast.

    ``numbers`` is how components are kept; it is taken from the column."""

    least: float = 0.9
    pivots: int = 256
    cell_rows: int = 4000
    block_rows: int = 2000
    numbers: str = "<f8"


def _units(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # keeps the squares of tiny and of huge numbers in range
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _matrix(vectors: list[bytes] | bytes, kind: str, dim: int) -> np.ndarray:
    return _units(np.frombuffer(vectors if isinstance(vectors, bytes) else b"".join(vectors), dtype=kind).reshape(-1, dim))


def number_kind(rows: DataFrame, vector: str) -> str:
    """The numbers of ``classes``: those of the column where it holds floats, else doubles."""
    return "<f4" if isinstance(rows.schema[vector].dataType.elementType, FloatType) else "<f8"


def classes(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(_key, cls, vec, dim): a digest of each vector, and its components as they stand.

    A vector that is null, empty, zero, or holds a null or a number that is not finite has no class.
    """
    kind = number_kind(rows, vector)
    rows = rows.select(F.col(key).alias("_key"), F.col(vector).cast("array<float>" if kind == "<f4" else "array<double>").alias("v"))
    named = rows.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, vec = [None] * batch.num_rows, [None] * batch.num_rows
            lists = batch.column(1)
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths[lengths > 0]):
                at = np.flatnonzero(lengths == dim)
                raw = lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, dim)  # a null is NaN
                good = np.isfinite(raw).all(axis=1) & raw.any(axis=1)
                for i, one, plain in zip(at[good].tolist(), raw[good], raw[good].astype(np.float64) + 0.0):
                    cls[i], vec[i] = hashlib.blake2b(plain.tobytes(), digest_size=16).digest(), one.tobytes()
            if batch.num_rows:
                dims = pa.array(np.where([c is None for c in cls], -1, lengths), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cls, pa.binary()), pa.array(vec, pa.binary()), dims], names=["_key", "cls", "vec", "dim"])

    return rows.mapInArrow(run, f"_key {named}, cls binary, vec binary, dim int")


def _visits(found: DataFrame, pivots: list, rules: RangeJoin) -> DataFrame:
    """(cls, vec, dim, copies, cell, visits): of (cls, vec, dim), the own cell of a vector and a bit for each cell that it visits.

    A class is given once for each batch that holds it, with its copies there.
    """
    kind = rules.numbers
    by_dim: dict[int, np.ndarray] = {}
    for dim in sorted({p["dim"] for p in pivots}):
        by_dim[dim] = _matrix([bytes(p["vec"]) for p in pivots if p["dim"] == dim], kind, dim)
    spread = found.sparkSession.sparkContext.broadcast(by_dim)
    reach, chord, slack = 2 * np.arccos(rules.least), np.sqrt(2 - 2 * rules.least), 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            _, first, copies = np.unique(batch.column(0).dictionary_encode().indices.to_numpy(), return_index=True, return_counts=True)
            batch = batch.take(pa.array(first))
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                for lo in range(0, len(rows), 1000):
                    some = batch.take(pa.array(rows[lo : lo + 1000]))
                    if (centers := spread.value.get(int(dim))) is None:
                        own, go = np.zeros(some.num_rows, np.int32), np.zeros((some.num_rows, 1), bool)
                    else:
                        cosines = _matrix(some.column(1).to_pylist(), kind, int(dim)) @ centers.T
                        angles = np.arccos(np.clip(cosines, -1, 1))
                        own = angles.argmin(axis=1)
                        line = np.arange(some.num_rows)
                        apart = np.sqrt(np.maximum(2 - 2 * centers @ centers.T, 0))[own]
                        beyond = cosines[line, own][:, None] - cosines > (chord + slack) * np.maximum(apart, 1e-12)
                        go = (angles <= angles[line, own][:, None] + reach + slack) & ~beyond & (np.arange(len(centers))[None, :] < own[:, None])
                    bits = [r.tobytes() for r in np.packbits(go, axis=1)]
                    yield pa.RecordBatch.from_arrays([*some.columns, pa.array(copies[rows[lo : lo + 1000]]), pa.array(own.astype(np.int32)), pa.array(bits, pa.binary())], names=["cls", "vec", "dim", "copies", "cell", "visits"])

    return found.mapInArrow(run, "cls binary, vec binary, dim int, copies long, cell int, visits binary")


_BLOCK = pa.schema([("id", pa.int64()), ("dim", pa.int32()), ("cell", pa.int32()), *((c, pa.binary()) for c in ("cls", "vec", "copies", "visits")), ("reach", pa.list_(pa.int32()))])
_BLOCK_SQL = "id long, dim int, cell int, cls binary, vec binary, copies binary, visits binary, reach array<int>"


def _blocks(visits: DataFrame, files: int, rules: RangeJoin) -> DataFrame:
    """A row per block: at most ``block_rows`` vectors of a cell one behind the other, and in ``reach`` the cells that any of them visits.

    Vectors are dealt to files in ranges of cell and class, so a cell of any size is spread and equal classes meet.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for table, bounds in by_key(batches, ["dim", "cell"]):
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                cell = table.slice(lo, hi - lo)
                same = cell.column("cls").combine_chunks().dictionary_encode().indices.to_numpy()
                _, first, of = np.unique(same, return_index=True, return_inverse=True)
                copies = np.bincount(of, cell.column("copies").to_numpy()).astype(np.int64)
                for at in range(0, len(first), rules.block_rows):
                    part = cell.take(pa.array(first[at : at + rules.block_rows]))
                    visits = np.frombuffer(b"".join(part.column("visits").to_pylist()), np.uint8).reshape(part.num_rows, -1)
                    row = {c: part.column(c)[0].as_py() for c in ("dim", "cell")} | {c: b"".join(part.column(c).to_pylist()) for c in ("cls", "vec")}
                    row |= {"id": number, "copies": copies[at : at + rules.block_rows].tobytes(), "visits": visits.tobytes()}
                    row["reach"] = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(visits, axis=0))).tolist()
                    yield pa.RecordBatch.from_pylist([row], schema=_BLOCK)
                    number += 1

    dealt = visits.repartitionByRange(files, "dim", "cell", "cls").sortWithinPartitions("dim", "cell", "cls")
    return dealt.mapInArrow(run, _BLOCK_SQL)


def _joined(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Link ``i`` with ``j``; ``parent`` holds the smallest of each part, before and after."""
    while (apart := parent[i] != parent[j]).any():
        i, j = i[apart], j[apart]
        a, b = parent[i], parent[j]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while (parent != (up := parent[parent])).any():
            parent[:] = up


def _linked(blocks: DataFrame, rules: RangeJoin) -> DataFrame:
    """(cls, n, other): n links of cls, counted in copies; a link to ``other`` where it is not null.

    The pairs of blocks are those of a product of the files, with no shuffle: of a pair's two
    orders one is taken, each as often, and the others of a task are added up before they are given.
    """
    kind, least = rules.numbers, rules.least
    a, b = (blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "ab")
    visit = (F.col("a_cell") == F.col("b_cell")) | F.array_contains("a_reach", F.col("b_cell")) | F.array_contains("b_reach", F.col("a_cell"))
    order = F.when((F.col("a_id") + F.col("b_id")) % 2 == 0, F.col("a_id") <= F.col("b_id")).otherwise(F.col("a_id") > F.col("b_id"))
    pairs = a.join(b.hint("shuffle_replicate_nl"), (F.col("a_dim") == F.col("b_dim")) & visit & order)
    sides = [f"{side}_{c}" for side in "ab" for c in ("id", "dim", "cell", "cls", "vec", "copies", "visits")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[bytes] = []
        start: dict[int, int] = {}
        parent, links = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: dict[str, tuple] = {}

        def block(row: dict, side: str) -> tuple:
            nonlocal parent, links
            number = row[f"{side}_id"]
            if side in held and held[side][0] == number:
                return held[side]
            units = _matrix(row[f"{side}_vec"], kind, row[f"{side}_dim"])
            if number not in start:
                start[number] = len(parent)
                names.extend(row[f"{side}_cls"][16 * k : 16 * k + 16] for k in range(len(units)))
                parent, links = np.append(parent, np.arange(len(parent), len(names))), np.append(links, np.zeros(len(units), np.int64))
            visits = np.frombuffer(row[f"{side}_visits"], np.uint8).reshape(len(units), -1)
            held[side] = number, row[f"{side}_cell"], start[number], units, units.astype(np.float32), np.frombuffer(row[f"{side}_copies"], np.int64), visits
            return held[side]

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                home, other = block(row, "a"), block(row, "b")
                if other[1] < home[1]:
                    home, other = other, home
                (one, cell, base, units, light, weight, _), (two, far, base2, units2, light2, weight2, visits) = home, other
                some = np.arange(len(units2)) if cell == far else np.flatnonzero(visits[:, cell >> 3] >> (7 - (cell & 7)) & 1)
                for lo in range(0, len(some), 1000):
                    mine = some[lo : lo + 1000]
                    i, j = np.nonzero(light @ light2[mine].T >= least - 1e-4)
                    j = mine[j]
                    if one == two:
                        i, j = i[i < j], j[i < j]
                    sure = np.einsum("ij,ij->i", units[i], units2[j]) >= least
                    i, j = i[sure], j[sure]
                    np.add.at(links, base + i, weight2[j])
                    np.add.at(links, base2 + j, weight[i])
                    _joined(parent, base + i, base2 + j)
        for lo in range(0, len(names), 10_000):
            at = lo + np.flatnonzero(links[lo : lo + 10_000])
            if len(at):
                roots = [names[r] if r != i else None for i, r in zip(at.tolist(), parent[at].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in at.tolist()], pa.binary()), pa.array(links[at]), pa.array(roots, pa.binary())], names=["cls", "n", "other"])

    return pairs.select(*sides).mapInArrow(run, "cls binary, n long, other binary")


def with_components(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", rules: RangeJoin = RangeJoin()) -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Only vectors of equal length are compared.  Vectors without a class (see
    ``classes``) link with nothing and are kept.  Repeated rows are vectors of their
    own that link with each other.  Null keys count as a component's smallest only
    where it has no other.
    """
    spark = rows.sparkSession
    rules = replace(rules, numbers=number_kind(rows, vector))
    vectors = classes(rows, key, vector)  # read again where vectors are needed; they are written in blocks only
    found = written(vectors.select("_key", "cls", "dim"), "keys")
    distinct = written(found.filter("cls is not null").groupBy("cls").agg(F.first("dim").alias("dim"), F.count("*").alias("copies"), F.min("_key").alias("least")), "classes")
    whole = distinct.agg(F.count("*").alias("n"), F.coalesce(F.sum("dim"), F.lit(0)).alias("numbers")).first()
    n = min(rules.pivots, max(2, -(-whole["n"] // rules.cell_rows)))
    drawn = distinct.orderBy(F.xxhash64("cls"), "cls").limit(n).select("cls").collect()
    known = vectors.filter("cls is not null").select("cls", "vec", "dim")
    pivots = known.filter(F.col("cls").isin([bytes(r["cls"]) for r in drawn])).dropDuplicates(["cls"]).orderBy(F.xxhash64("cls"), "cls").collect() if drawn else []
    size = whole["numbers"] * np.dtype(rules.numbers).itemsize
    files = max(math.isqrt(4 * spark.sparkContext.defaultParallelism), -(-size // FILE_BYTES))
    blocks = written(_blocks(_visits(known, pivots, rules), files, rules), "blocks")
    linked = written(_linked(blocks, rules), "vector-links")
    dropped(spark, blocks)
    labels = components(linked.filter("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b")))
    counts = linked.groupBy("cls").agg(F.sum("n").alias("n"))
    per_class = distinct.join(counts, "cls", "left").join(labels, F.col("cls") == F.col("node"), "left")
    per_class = per_class.select("cls", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "cls").alias("label"), "least")
    per_class = written(per_class, "labels")
    least = written(per_class.groupBy("label").agg(F.min("least").alias("component_id")), "least")  # the joins below are then plain shuffles, whose hot partitions the engine splits
    per_class = per_class.drop("least").join(least, "label")
    out = found.join(per_class, "cls", "left").withColumn("component_id", F.when(F.col("cls").isNull(), F.col("_key")).otherwise(F.col("component_id")))
    return out.select(F.col("_key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("_key").eqNullSafe(F.col("component_id")).alias("kept"))
