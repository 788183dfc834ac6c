"""Predictive score: importances of random forests over folds, with the error on held-out rows.

Features are turned into byte codes by one quantile sketch for all columns; a row's codes are
packed and shuffled once, into shards of bounded size by a hash of the row.  Every tree is grown
in a task from a bootstrap of one shard; a table of one shard gives the usual forest, one of
many gives every shard its part of the trees, and one tree at least, so all rows take part, work
grows in proportion to them, and no histograms are shuffled.  With shards enough for all cores a
task grows all trees of a shard where its rows arrive; only fewer shards are written and copied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import once

#: Codes of a column at most.
BINS = 64
#: Rows and bytes of codes of a shard at most, on average.
SHARD_ROWS, SHARD_BYTES = 250_000, 32 << 20


def cut_points(bins: int = BINS) -> list[float]:
    """The shares of the rows at which a column is cut."""
    return [i / (bins - 1) for i in range(1, bins)]


def coded(df: DataFrame, cuts: Mapping[str, Sequence[float]], names: Mapping[str, str]) -> DataFrame:
    """``df`` with a column of codes, named by ``names``, for each column of ``cuts``: how many cut points a value has reached."""
    columns = list(cuts)
    inf = float("inf")
    splits = [[-inf, *sorted(set(cuts[c])), inf] for c in columns]
    found = Bucketizer(splitsArray=splits, inputCols=columns, outputCols=[f"__code_{i}" for i in range(len(columns))], handleInvalid="keep").transform(df) if columns else df
    return found.select(*[F.col(f"`{c}`") for c in df.columns], *[F.col(f"__code_{i}").cast("tinyint").alias(names[c]) for i, c in enumerate(columns)])


class Tree:
    """A regression tree over byte codes, grown level by level with weights of a bootstrap.

    A level's histograms are counted for the smaller child of each split node only; the other's
    are what the parent's leave.
    """

    def __init__(self, codes: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int, bins: int):
        rows = np.flatnonzero(weight)
        codes, w = np.ascontiguousarray(codes[:, rows]), weight[rows].astype(np.float64)
        wy = w * y[rows]
        self.gains = np.zeros(len(codes))
        self.feature, self.cut, self.left = [np.full(1, -1)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        self.value = [np.array([wy.sum() / max(w.sum(), 1.0)])]
        node, base = np.zeros(len(rows), dtype=np.int64), 0  # node: the place among the nodes of this level
        held = _histograms(codes, node, w, wy, 1, bins) if depth and len(rows) else None
        for level in range(depth):
            if held is None or not held.shape[2]:
                break
            gain, feature, cut, left_count, left_total = _best(held)
            count, total = held[0, 0].sum(axis=1), held[1, 0].sum(axis=1)
            split = gain > 1e-9 * (1.0 + np.abs(total))
            np.add.at(self.gains, feature[split], gain[split])
            # children of the split nodes stand behind all nodes made so far, left before right
            k, first = int(split.sum()), base + len(self.value[-1])
            child = first + 2 * (np.cumsum(split) - 1)
            self.feature[-1][:], self.cut[-1][:], self.left[-1][:] = np.where(split, feature, -1), np.where(split, cut, 0), child
            counts = np.stack([left_count[split], (count - left_count)[split]], axis=1)
            sums = np.stack([left_total[split], (total - left_total)[split]], axis=1)
            base = first
            self.value.append((sums / np.maximum(counts, 1.0)).ravel())
            self.feature.append(np.full(2 * k, -1))
            self.cut.append(np.zeros(2 * k, np.int64))
            self.left.append(np.zeros(2 * k, np.int64))
            if level == depth - 1 or not k:
                break
            keep = split[node]
            codes, w, wy, node = codes[:, keep], w[keep], wy[keep], node[keep]
            right = codes[feature[node], np.arange(len(node))] > cut[node]
            place = (np.cumsum(split) - 1)[node]
            smaller = counts[:, 1] < counts[:, 0]  # whether the right child is
            some = np.flatnonzero(right == smaller[place])
            part = _histograms(codes[:, some], place[some], w[some], wy[some], k, bins)
            rest = held[:, :, split] - part
            held = np.empty((2, len(codes), 2 * k, bins))
            held[:, :, 0::2] = np.where(smaller[:, None], rest, part)
            held[:, :, 1::2] = np.where(smaller[:, None], part, rest)
            node = 2 * place + right

    def predict(self, codes: np.ndarray) -> np.ndarray:
        feature, cut, left, value = (np.concatenate(x) for x in (self.feature, self.cut, self.left, self.value))
        at = np.zeros(codes.shape[1], dtype=np.int64)
        for _ in range(len(self.value) - 1):
            inner = np.flatnonzero(feature[at] >= 0)
            here = at[inner]
            at[inner] = left[here] + (codes[feature[here], inner] > cut[here])
        return value[at]


def _histograms(codes: np.ndarray, node: np.ndarray, w: np.ndarray, wy: np.ndarray, nodes: int, bins: int) -> np.ndarray:
    """(weight and sum, feature, node, code)."""
    out = np.empty((2, len(codes), nodes, bins))
    at = node * bins
    for f, column in enumerate(codes):
        key = at + column
        out[0, f] = np.bincount(key, w, nodes * bins).reshape(nodes, bins)
        out[1, f] = np.bincount(key, wy, nodes * bins).reshape(nodes, bins)
    return out


def _best(held: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each node the largest gain, its feature and code, and weight and sum of the left side."""
    _, features, nodes, bins = held.shape
    count, sums = held.cumsum(axis=3)
    whole, total = count[0, :, -1], sums[0, :, -1]
    count, sums = count[:, :, :-1], sums[:, :, :-1]
    rest, other = whole[:, None] - count, total[:, None] - sums
    gain = np.where((count > 0.5) & (rest > 0.5), sums**2 / np.maximum(count, 1.0) + other**2 / np.maximum(rest, 1.0), -np.inf)
    flat = gain.transpose(1, 0, 2).reshape(nodes, -1)
    top, rows = flat.argmax(axis=1), np.arange(nodes)
    feature, cut = np.divmod(top, bins - 1)
    return flat[rows, top] - total**2 / np.maximum(whole, 1.0), feature, cut, count[feature, rows, cut], sums[feature, rows, cut]


_SHARD = pa.schema([("shard", pa.int64()), ("n", pa.int64()), ("codes", pa.binary()), ("y", pa.binary()), ("fold", pa.binary())])
#: ``held`` and ``y`` are the guesses of a part of a fold's trees; where all were grown together, the sums of the errors stand in their place.
_GROWN = pa.schema([("shard", pa.int64()), ("fold", pa.int32()), ("trees", pa.int64()), ("shares", pa.list_(pa.float64())), ("held", pa.binary()), ("y", pa.binary()), ("n", pa.int64()), ("error", pa.float64()), ("sum", pa.float64()), ("squares", pa.float64())])
_GROWN_SQL = "shard bigint, fold int, trees bigint, shares array<double>, held binary, y binary, n bigint, error double, sum double, squares double"


def fixed_bytes(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix of bytes, each as one value."""
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(matrix.shape[1]), len(matrix), [None, pa.py_buffer(matrix.tobytes())]).cast(pa.binary())


def _joined_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The codes of a row as one value, so that a shuffled code takes a byte."""
    for batch in batches:
        matrix = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.uint8) for c in batch.columns[3:]])
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], fixed_bytes(matrix)], names=["shard", "y", "fold", "codes"])


def _arrays(table: pa.Table) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """A shard's number, codes column by column, targets and folds."""
    codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), dtype=np.uint8).reshape(table.num_rows, -1)
    return table.column("shard")[0].as_py(), np.ascontiguousarray(codes.T), table.column("y").to_numpy().astype(np.float64), table.column("fold").to_numpy().astype(np.uint8)


def _packed(table: pa.Table) -> pa.Table:
    """A shard as one row."""
    shard, codes, y, fold = _arrays(table)
    return pa.Table.from_pylist([{"shard": shard, "n": len(y), "codes": codes.tobytes(), "y": y.tobytes(), "fold": fold.tobytes()}], schema=_SHARD)


def _errors(guess: np.ndarray, y: np.ndarray) -> dict[str, float]:
    return {"n": len(y), "error": float(((guess - y) ** 2).sum()), "sum": float(y.sum()), "squares": float((y**2).sum())}


def forest_importance(
    wide: DataFrame, features: Sequence[str], target: str, key: str = "row_id", folds: int = 5, trees: int = 200, depth: int = 8, seed: int = 42, bins: int = BINS, codes: Sequence[str] = (), shard_rows: int = SHARD_ROWS,
    packed: Callable[[DataFrame, Sequence[str]], DataFrame] | None = None,
) -> tuple[DataFrame, list[dict[str, float]]]:
    """(cand, importance, predictive) and the held-out error of every fold.

    ``codes`` names the columns that hold the features' codes already, in the features' order;
    with ``packed`` they needn't exist: it gives columns of the rows and all codes of a row as one value.
    Folds and shards come from hashes of the row's key, so they don't depend on partitions.
    Rows without a target are left out; where all rows are of one fold, it trains on them.
    ``importance`` is the mean share over folds, ``predictive`` is relative to the largest.
    A feature without a value anywhere has no share.
    """
    names, spark = list(features), wide.sparkSession
    rows = wide.filter(F.col(target).isNotNull()).withColumns({"_y": F.col(target).cast("double"), "_fold": F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(folds)).cast("tinyint"), "_deal": F.xxhash64(F.lit(seed + 1), F.col(key))})
    if packed:
        pass
    elif not codes:
        values = rows.select("_deal", "_y", "_fold", *[F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(names)])
        sketch = values.agg(*[F.percentile_approx(f"_f{i}", F.array(*map(F.lit, cut_points(bins))), F.lit(10_000)).alias(f"_f{i}") for i in range(len(names))]).first() if names else {}
        cuts = {f"_f{i}": sketch[f"_f{i}"] or [0.0] for i in range(len(names))}
        rows = coded(values, cuts, {c: f"_c{c[2:]}" for c in cuts})
    else:
        rows = rows.select("_deal", "_y", "_fold", *[F.col(c).alias(f"_c{i}") for i, c in enumerate(codes)])
    sizes = {r["_fold"]: (r["n"], r["mean"]) for r in rows.groupBy("_fold").agg(F.count("*").alias("n"), F.avg("_y").alias("mean")).collect()} if names else {}
    total = sum(n for n, _ in sizes.values())
    if not total:
        return spark.createDataFrame([(c, 0.0, 0.0) for c in names], "cand string, importance double, predictive double"), []
    middle = sum(n * m for n, m in sizes.values()) / total
    shards = -(-total // max(1, min(shard_rows, SHARD_BYTES // len(names))))
    own = -(-trees // shards)
    shard = F.pmod("_deal", F.lit(shards)).alias("shard")
    if packed:
        dealt = packed(rows.withColumn("shard", shard), ["shard", "_y", "_fold"]).withColumnRenamed("_y", "y").withColumnRenamed("_fold", "fold")
    else:
        dealt = rows.select(shard, "_y", "_fold", *[F.coalesce(f"_c{i}", F.lit(0).cast("tinyint")).alias(f"_c{i}") for i in range(len(names))])
        dealt = dealt.mapInArrow(_joined_codes, "shard bigint, y double, fold tinyint, codes binary")
    present, size = sorted(sizes), len(names)
    # enough tasks for all cores: a job has every ``copies``-th tree of a shard's folds
    copies = max(1, min(own * len(present), -(-2 * spark.sparkContext.defaultParallelism // shards)))

    def grown_of(shard: int, matrix: np.ndarray, y: np.ndarray, of: np.ndarray, job: int) -> Iterator[dict]:
        y = y - middle
        for k, fold in enumerate(present):
            mine = [t for t in range(own) if (k * own + t) % copies == job]
            if not mine:
                continue
            out = of == fold
            train = np.flatnonzero(~out) if len(present) > 1 else np.arange(len(y))
            held = np.flatnonzero(out)
            codes_, target_, test = np.ascontiguousarray(matrix[:, train]), y[train], np.ascontiguousarray(matrix[:, held])
            shares, guess = np.zeros(size), np.zeros(len(held))
            for t in mine:
                rng = np.random.default_rng([seed, fold, shard, t])
                tree = Tree(codes_, target_, rng.poisson(1.0, len(train)), depth, bins + 1)
                guess += tree.predict(test)
                if tree.gains.sum() > 0:
                    shares += tree.gains / tree.gains.sum()
            row = {"shard": shard, "fold": fold, "trees": len(mine), "shares": shares.tolist()}
            yield row | (_errors(guess / own, y[held]) if len(mine) == own else {"held": guess.tobytes(), "y": y[held].tobytes()})

    def grow_here(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(list(grown_of(*_arrays(table), 0)), schema=_GROWN)

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                parts = np.frombuffer(r["codes"], dtype=np.uint8).reshape(size, r["n"]), np.frombuffer(r["y"]), np.frombuffer(r["fold"], dtype=np.uint8)
                yield pa.RecordBatch.from_pylist(list(grown_of(r["shard"], *parts, r["job"])), schema=_GROWN)

    if copies == 1:
        grown = dealt.repartition(shards, "shard").groupBy("shard").applyInArrow(grow_here, _GROWN_SQL)
    else:
        table = once(dealt.groupBy("shard").applyInArrow(_packed, "shard bigint, n bigint, codes binary, y binary, fold binary"), "codes")
        jobs = table.withColumn("job", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
        grown = jobs.repartition(shards * copies, "shard", "job").mapInArrow(grow, _GROWN_SQL)
    grown = once(grown, "trees")

    def missed(parts: pa.Table) -> pa.Table:
        guess = sum(np.frombuffer(b) for b in parts.column("held").to_pylist()) / max(sum(parts.column("trees").to_pylist()), 1)
        found = _errors(guess, np.frombuffer(parts.column("y")[0].as_py()))
        return pa.table({"fold": pa.array([parts.column("fold")[0].as_py()], pa.int32()), **{c: [v] for c, v in found.items()}})

    shares = np.zeros((len(present), size))
    for r in grown.select("fold", F.posexplode("shares").alias("i", "share")).groupBy("fold", "i").agg(F.sum("share").alias("share")).collect():  # a number per fold and feature
        shares[present.index(r["fold"]), r["i"]] = r["share"]
    shares /= np.maximum(shares.sum(axis=1, keepdims=True), 1e-300)
    mean = shares.mean(axis=0).tolist()
    errors = []
    parts = grown.filter("held IS NOT NULL").groupBy("shard", "fold").applyInArrow(missed, "fold int, n bigint, error double, sum double, squares double")
    tests = parts.unionByName(grown.filter("held IS NULL").select("fold", "n", "error", "sum", "squares"))
    for r in sorted(tests.groupBy("fold").agg(*[F.sum(c).alias(c) for c in ("n", "error", "sum", "squares")]).collect(), key=lambda r: r["fold"]):
        spread = r["squares"] - r["sum"] ** 2 / r["n"]
        errors.append({"rmse": (r["error"] / r["n"]) ** 0.5, "r2": 1 - r["error"] / spread if spread > 0 else 0.0})
    top = max(mean, default=0.0) or 1.0
    return spark.createDataFrame([(c, m, m / top) for c, m in zip(names, mean)], "cand string, importance double, predictive double"), errors


def significant(importance: DataFrame, share: float = 0.02) -> DataFrame:
    return importance.withColumn("significant", F.col("importance") >= share)
