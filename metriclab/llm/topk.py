"""Exact search for the nearest by inner product: tiles of queries against shards of vectors.

Vectors are packed into shards of bounded size where they are read, queries into tiles.
Tiles go to every lane of shards, where a matrix product scores a tile against a shard and a
partial selection keeps the best of each query.  Lists of the lanes are merged in a tree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import written

#: Stands for no score; real scores are larger.
NONE = -(2**63)
#: Integers below this are exact as doubles, and so are their products and sums below it.
EXACT = 2.0**53


@dataclass(frozen=True)
class Search:
    """Sizes of the search: vectors of a shard, queries of a tile, shards of a lane, tiles of a lane, lists merged at once."""

    k: int = 5
    scale: int = 256
    shard_rows: int = 4096
    tile_rows: int = 2048
    lane_shards: int = 64
    lane_tiles: int = 128
    fan_in: int = 32


SHARD = "shard bigint, dim int, form string, n int, n_asked int, ids binary, asked binary, data binary"
QUERY = "dim int, form string, shard bigint, place int, query_id bigint, data binary"
TILE = "dim int, form string, tile bigint, n int, shards binary, places binary, ids binary, data binary"
PART = "shard bigint, place int, query_id bigint, lane bigint, score bigint, vec_id bigint"
#: How components are stored: small integers, integers that a double holds, or the vector's own numbers.
FORMS = {"small": np.int16, "middle": np.float64, "large": np.float64}


def packed(vectors: DataFrame, rules: Search) -> DataFrame:
    """Shards of (key, asked, vector): ids in order, components times ``scale`` rounded down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            keys, asked, column = batch.column(0), batch.column(1), batch.column(2)
            good = np.asarray(keys.is_valid()) & np.asarray(column.is_valid())
            at = np.flatnonzero(good)
            if not len(at):
                continue
            column = column.take(pa.array(at))
            ids = keys.take(pa.array(at)).to_numpy(zero_copy_only=False).astype(np.int64)
            wanted = asked.take(pa.array(at)).fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
            offsets = column.offsets.to_numpy().astype(np.int64)
            values = column.values.cast(pa.float64())
            values = (values.fill_null(np.nan) if values.null_count else values).to_numpy(zero_copy_only=False)
            sizes = np.diff(offsets)
            for dim in np.unique(sizes):
                of = np.flatnonzero(sizes == dim)
                matrix = values[offsets[of][:, None] + np.arange(dim)]
                finite = np.isfinite(matrix).all(axis=1)
                of, matrix = of[finite], matrix[finite]
                with np.errstate(over="ignore"):
                    scaled = np.floor(rules.scale * matrix)
                largest = np.abs(scaled).max(axis=1, initial=0.0)
                forms = np.where(largest < 2**15, "small", np.where(largest < EXACT, "middle", "large"))
                for form in np.unique(forms):
                    rows = np.flatnonzero(forms == form)
                    rows = rows[np.argsort(ids[of[rows]], kind="stable")]
                    data = (matrix if form == "large" else scaled).astype(FORMS[form])
                    for lo in range(0, len(rows), rules.shard_rows):
                        some = rows[lo : lo + rules.shard_rows]
                        mask = wanted[of[some]]
                        yield pa.RecordBatch.from_pylist([{
                            "shard": number, "dim": int(dim), "form": str(form), "n": len(some), "n_asked": int(mask.sum()),
                            "ids": ids[of[some]].tobytes(), "asked": mask.tobytes(), "data": data[some].tobytes(),
                        }], schema=_SHARD)
                        number += 1

    return vectors.mapInArrow(run, SHARD)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


_SHARD, _QUERY, _TILE, _PART = map(_arrow, (SHARD, QUERY, TILE, PART))


def tiled(shards: DataFrame, rules: Search, tiles: int) -> DataFrame:
    """Tiles of the shards' queries; a hash of a query's place deals them, so tiles are of about one size."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at = np.flatnonzero(np.frombuffer(r["asked"], dtype=bool))
                width = len(r["data"]) // r["n"]
                ids = np.frombuffer(r["ids"], dtype=np.int64)[at]
                rows = [r["data"][i * width : (i + 1) * width] for i in at]
                n = len(at)
                yield pa.RecordBatch.from_arrays([pa.array([r["dim"]] * n, pa.int32()), pa.array([r["form"]] * n), pa.array([r["shard"]] * n, pa.int64()), pa.array(at.astype(np.int32)), pa.array(ids), pa.array(rows, pa.binary())], schema=_QUERY)

    def pack(table: pa.Table) -> pa.Table:
        first = table.slice(0, 1).to_pylist()[0]
        as_bytes = lambda c, kind: table.column(c).to_numpy().astype(kind).tobytes()
        return pa.Table.from_pylist([{
            "dim": first["dim"], "form": first["form"], "tile": first["tile"], "n": table.num_rows, "shards": as_bytes("shard", np.int64), "places": as_bytes("place", np.int32),
            "ids": as_bytes("query_id", np.int64), "data": b"".join(table.column("data").to_pylist()),
        }], schema=_TILE)

    asked = shards.filter("n_asked > 0").mapInArrow(pick, QUERY)
    dealt = asked.withColumn("tile", F.pmod(F.xxhash64("shard", "place"), F.lit(tiles)))
    return dealt.groupBy("dim", "form", "tile").applyInArrow(pack, TILE)


def whole_numbers(data: np.ndarray, scale: int) -> np.ndarray:
    """Numbers times ``scale``, rounded down, as integers of any size."""
    far = 2.0**900
    return np.array([[math.floor(x * scale) if abs(x) < far else int(x) * scale for x in row] for row in data.tolist()], dtype=object).reshape(data.shape)


def best_of(a: np.ndarray, b: np.ndarray, forms: tuple[str, str], own: np.ndarray, rules: Search) -> tuple[np.ndarray, np.ndarray]:
    """(scores, columns) of the ``k`` best columns of a.b for each row; of equal scores the smallest column.

    ``own`` has the column that a row must not find, or -1.  The product is taken in doubles where
    all its sums are exact in them, in 64-bit integers where they fit, else in integers of any
    size; what 64 bits can't hold becomes the nearest that they hold.
    """
    k, n = min(rules.k, len(b)), len(b)
    plain = "large" not in forms
    bound = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * max(a.shape[1], 1) if plain else math.inf
    rows = np.arange(len(a))[:, None]
    if (bound + 1) * n < 2.0**62:
        kind = np.float64 if (bound + 1) * n < EXACT else np.int64
        # one number for score and column: the larger, the better
        score = (a.astype(kind) @ b.astype(kind).T) * n + (n - 1 - np.arange(n))
        hidden = np.flatnonzero(own >= 0)
        score[hidden, own[hidden]] = -(2.0**53) if kind is np.float64 else NONE
        found = np.argpartition(score, n - k, axis=1)[:, n - k :] if k < n else np.broadcast_to(np.arange(n), score.shape)
        top = score[rows, found].astype(np.int64)
        top = np.where(found == own[:, None], NONE, top // n)
        return top, found
    exact = lambda x, form: whole_numbers(x, rules.scale) if form == "large" else whole_numbers(x.astype(np.float64), 1)
    product = exact(a, forms[0]).dot(exact(b, forms[1]).T)
    top, found = np.full((len(a), k), NONE, dtype=np.int64), np.zeros((len(a), k), dtype=np.int64)
    for i, line in enumerate(product):
        held = [max(-(2**63) + 1, min(2**63 - 1, int(s))) for s in line]
        order = sorted((j for j in range(n) if j != own[i]), key=lambda j: (-held[j], j))[:k]
        top[i, : len(order)], found[i, : len(order)] = [held[j] for j in order], order
    return top, found


def top_k(vectors: DataFrame, asked: Column, key: str = "vec_id", vector: str = "embedding", rules: Search = Search()) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of the largest integer inner product for each row that ``asked`` picks.

    A component x counts as floor(scale * x).  A row doesn't find itself, but finds another row of
    its key; ties go to the smaller key.  Vectors that are null or hold null or non-finite
    components, and rows without a key, take no part; vectors meet those of their own length only.
    Repeated query rows are answered each.  Scores beyond 64 bits count as the largest or smallest
    of 64 bits.  An empty table gives no rows.

    Work grows with queries times rows, as the result is exact; what a task holds doesn't grow:
    at most ``lane_shards`` shards and ``lane_tiles`` tiles, on average.
    """
    shards = written(packed(vectors.select(F.col(key).cast("long"), asked, F.col(vector)), rules), "shards")
    sizes = shards.agg(F.count("*").alias("shards"), F.coalesce(F.sum("n_asked"), F.lit(0)).alias("asked")).first()
    tiles = max(1, math.ceil(sizes["asked"] / rules.tile_rows))
    # lanes: enough for all cores, and so many that none holds more than its bound
    spread = 2 * vectors.sparkSession.sparkContext.defaultParallelism
    lanes = max(1, math.ceil(sizes["shards"] / rules.lane_shards), min(sizes["shards"], spread))
    rows = math.ceil(tiles / rules.lane_tiles)
    asking = written(tiled(shards, rules, tiles), "tiles").withColumn("row", F.pmod(F.xxhash64("tile"), F.lit(rows)))
    asking = asking.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)).cast("array<bigint>")))
    held = shards.withColumn("lane", F.pmod(F.xxhash64("shard"), F.lit(lanes))).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1)).cast("array<bigint>")))

    def search(queries: pa.Table, data: pa.Table) -> pa.Table:
        out = []
        lane = queries.column("lane")[0].as_py() if queries.num_rows else 0
        blocks = data.to_pylist() if queries.num_rows else []
        for t in queries.to_pylist() if blocks else []:
            a = np.frombuffer(t["data"], dtype=FORMS[t["form"]]).reshape(t["n"], t["dim"])
            home, place = np.frombuffer(t["shards"], dtype=np.int64), np.frombuffer(t["places"], dtype=np.int32)
            scores = np.full((t["n"], rules.k), NONE, dtype=np.int64)
            names = np.zeros((t["n"], rules.k), dtype=np.int64)
            for r in blocks:
                b = np.frombuffer(r["data"], dtype=FORMS[r["form"]]).reshape(r["n"], r["dim"])
                top, at = best_of(a, b, (t["form"], r["form"]), np.where(home == r["shard"], place, -1), rules)
                scores = np.concatenate([scores, top], axis=1)
                names = np.concatenate([names, np.frombuffer(r["ids"], dtype=np.int64)[at]], axis=1)
                order = np.lexsort((names, ~scores), axis=1)[:, : rules.k]
                scores, names = np.take_along_axis(scores, order, 1), np.take_along_axis(names, order, 1)
            i, j = np.nonzero(scores != NONE)
            columns = [home[i], place[i], np.frombuffer(t["ids"], dtype=np.int64)[i], np.full(len(i), lane, dtype=np.int64), scores[i, j], names[i, j]]
            out.append(pa.Table.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], schema=_PART))
        return pa.concat_tables(out) if out else _PART.empty_table()

    keys = ("dim", "row", "lane")
    parts = asking.groupBy(*keys).cogroup(held.select("dim", "row", "lane", "shard", "form", "n", "ids", "data").groupBy(*keys)).applyInArrow(search, PART)
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))), 1, rules.k)
    lists = parts.withColumn("lane", F.floor(F.col("lane") / rules.fan_in)).groupBy("shard", "place", "query_id", "lane").agg(best.alias("top"))
    while (lanes := math.ceil(lanes / rules.fan_in)) > 1:
        merged = F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, rules.k)
        lists = lists.withColumn("lane", F.floor(F.col("lane") / rules.fan_in)).groupBy("shard", "place", "query_id", "lane").agg(merged.alias("top"))
    found = lists.select("query_id", F.posexplode("top").alias("rank", "one"))
    return found.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("vec_id"), (-F.col("one.less")).alias("score"))


#: DuckDB: every query against every other row.
ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
