"""Scored candidates of all rounds: what is known of each, and one table with their values.

A round adds candidates.  Only new ones are sketched and measured, and the products of new with
all columns extend those known.  No values are written: they are computed from the observations
and from the groups' statistics wherever they are read, so the disk holds what the observations
take, however many candidates there are.  A round reads them three times: for the quantiles, for
moments and products together, and for the forest's codes.  Values pass as columns of Arrow batches
and are added up there, so no row is made for a value.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import once
from ..functions.sketches import Sketch, weighted_values
from ..operators import candidates as C
from ..operators import scoring
from ..operators.importance import coded, cut_points, fixed_bytes, forest_importance, significant
from ..settings import Thresholds


@dataclass(frozen=True)
class Facts:
    """What one pass tells of a candidate: bounds, median and cut points, then moments of the clipped values, whole and by year."""

    place: int
    low: float
    median: float
    high: float
    cuts: tuple[float, ...]
    n: int
    present: int
    least: float | None
    most: float | None
    mean: float | None
    spread: float | None
    yearly: tuple[tuple[int, float | None], ...]

    def filled_mean(self) -> float:
        """Mean of the clipped values with the median for each that is missing."""
        return (self.present * (self.mean or 0.0) + (self.n - self.present) * self.median) / max(self.n, 1)


def value(i: int) -> str:
    return f"__x{i}"


def code(i: int) -> str:
    return f"__b{i}"


#: Bytes of a dimension's statistics that are broadcast at most; those of finer dimensions join the observations once.
COARSE_BYTES = 8 << 20
#: What a row of the measuring pass holds.
PRODUCT, ENDS, ROWS, PRESENT, SUM, SQUARES = range(6)


class Ledger:
    """Candidates by signature.  ``table`` has a row per observation: the columns that candidates read,
    ``__row``, ``__year``, ``__y``, and for each candidate its clipped and filled value and its byte code."""

    def __init__(self, df: DataFrame, target: str, year: str, columns: Sequence[str], limits: Thresholds = Thresholds()):
        self.limits = limits
        self.base = list(dict.fromkeys(c for c in columns if c in df.columns))
        kept = [F.col(f"`{c}`") for c in self.base]
        self.rows = df.select(*kept, F.col("row_id").alias("__row"), F.expr(year).alias("__year"), F.col(target).cast("double").alias("__y"))
        self.fixed = self.rows.columns
        self.facts: dict[tuple, Facts] = {}
        self.found: dict[tuple, C.Candidate] = {}
        self.products = np.zeros((0, 0))
        self._sums: dict[int, float] = {}  # of the deviations from the median
        self._groups: dict[tuple, str] = {}  # the column of each group value
        self._coarse: list[tuple[str, DataFrame]] = []  # dimension, and its statistics behind its key
        self._held: dict[str, Broadcast] = {}  # by the name of the key

    def prepare(self, candidates: Sequence[C.Candidate]) -> None:
        """Aggregate the groups of candidates that are or may be added: of all dimensions in one scan.

        Statistics of dimensions with many groups join the observations, which are written
        with them once; those of others are broadcast to whatever reads them.
        """
        new = [c for c in C.unique(candidates) if c.kind in ("mean", "count") and c.signature() not in self._groups]
        rows, fine = self.rows, False
        for dim, (stats, means) in C.statistics_by_dim(self.rows, list(dict.fromkeys(c.args[-1] for c in new)), new, self.limits, write=True).items():
            of_dim = [c for c in new if c.args[-1] == dim]
            names = {c.signature(): f"__g{len(self._groups) + i}" for i, c in enumerate(of_dim)}
            key = f"__k{len(self._groups)}"
            source = {c.signature(): stats.columns[1] if c.kind == "count" else stats.columns[2 + means.index(c.args[0])] for c in of_dim}
            stats = stats.select(F.col(f"`{stats.columns[0]}`").alias(key), *[F.col(source[s]).alias(n) for s, n in names.items()])
            self._groups |= names
            if 8 * len(stats.columns) * stats.count() > COARSE_BYTES:
                fine, rows = True, rows.join(stats, F.col(f"`{dim}`") == F.col(key), "left").drop(key)
            else:
                self._coarse.append((dim, stats))
        if fine:
            self.rows = once(rows, "fine")

    def add(self, candidates: Sequence[C.Candidate]) -> list[C.Candidate]:
        """Measure those that are new; those with too few values or no spread are known, but not kept.  Returns the kept ones."""
        new = [c for c in C.unique(candidates) if c.signature() not in self.facts]
        if not new:
            return []
        self.prepare(new)
        places = range(len(self.facts), len(self.facts) + len(new))
        facts, products = self._measured(dict(zip(places, new)))
        for c, f in zip(new, facts):
            self.facts[c.signature()] = f
        kept = [k for k, f in enumerate(facts) if self._kept(f)]
        self.found |= {new[k].signature(): new[k] for k in kept}
        self._extend(products, kept)
        return [new[k] for k in kept]

    def _raw(self, candidates: dict[int, C.Candidate], keep: Sequence[str], rows: DataFrame | None = None) -> DataFrame:
        """``keep`` and a column ``__r<place>`` for each candidate."""
        out = self.rows if rows is None else rows
        wanted = {self._groups[c.signature()] for c in candidates.values() if c.signature() in self._groups}
        for dim, stats in self._coarse:
            if used := [n for n in stats.columns[1:] if n in wanted]:
                out = out.join(F.broadcast(stats.select(stats.columns[0], *used)), F.col(f"`{dim}`") == F.col(stats.columns[0]), "left")
        values = {i: F.col(self._groups[c.signature()]) if c.signature() in self._groups else c.row_column() for i, c in candidates.items()}
        return out.select(*[F.col(f"`{c}`") for c in keep], *[v.alias(f"__r{i}") for i, v in values.items()])

    def _batches(self, candidates: dict[int, C.Candidate], keep: Sequence[str], rows: DataFrame | None = None) -> tuple[DataFrame, Callable[[pa.RecordBatch], list[np.ndarray]]]:
        """Rows with ``keep`` and what the candidates are made of, and a function that gives the candidates' values in a batch of them.

        Values from the row alone and those of fine groups are columns; groups that are coarse are
        looked up in the batch.  As joins they would make generated code too long to be compiled.
        """
        out = self.rows if rows is None else rows
        wanted = {self._groups[c.signature()]: i for i, c in candidates.items() if c.signature() in self._groups}
        dims, spread = [], []
        for dim, stats in self._coarse:
            if used := [n for n in stats.columns[1:] if n in wanted]:
                if (name := stats.columns[0]) not in self._held:
                    self._held[name] = out.sparkSession.sparkContext.broadcast(_lookup(stats))
                dims.append(dim)
                spread.append((self._held[name], [(stats.columns.index(n) - 1, wanted[n]) for n in used]))
        looked = {i for _, some in spread for _, i in some}
        plain = {i: F.col(self._groups[c.signature()]) if c.signature() in self._groups else c.row_column() for i, c in candidates.items() if i not in looked}
        out = out.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"`{d}`").alias(f"__d{k}") for k, d in enumerate(dims)], *[v.alias(f"__r{i}") for i, v in plain.items()])
        places: dict[int, Callable] = {}
        first, skip, alone, order = len(keep), len(keep) + len(dims), list(plain), list(candidates)

        def values(batch: pa.RecordBatch) -> list[np.ndarray]:
            found = {i: _finite(batch.column(skip + k)) for k, i in enumerate(alone)}
            for k, (held, some) in enumerate(spread):
                keys, columns = held.value
                if k not in places:  # once in a task
                    places[k] = _places(keys)
                at = places[k](batch.column(first + k))
                found |= {i: columns[c][at] for c, i in some}
            return [found[i] for i in order]

        return out, values

    def _filled(self, keep: Sequence[str]) -> DataFrame:
        """``keep`` and the clipped and filled value of each kept candidate."""
        raw = self._raw({self.facts[s].place: c for s, c in self.found.items()}, keep)
        return raw.select(*[F.col(f"`{c}`") for c in keep], *[F.coalesce(_clipped(f), F.lit(f.median)).alias(value(f.place)) for f in (self.facts[s] for s in self.found)])

    @property
    def table(self) -> DataFrame:
        facts = [self.facts[s] for s in self.found]
        return coded(self._filled(self.fixed), {value(f.place): f.cuts for f in facts}, {value(f.place): code(f.place) for f in facts})

    def codes(self, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` of ``rows``, which has all columns of the observations, and ``codes``: a byte for each kept candidate."""
        facts = [self.facts[s] for s in self.found]
        cuts = [np.array(f.cuts) for f in facts]
        raw, values = self._batches({f.place: c for f, c in zip(facts, self.found.values())}, keep, rows)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                matrix = np.empty((len(facts), batch.num_rows), np.uint8)
                for k, (f, v) in enumerate(zip(facts, values(batch))):
                    v = np.clip(v, f.low, f.high)
                    matrix[k] = np.searchsorted(cuts[k], np.where(np.isnan(v), f.median, v), side="right")
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], fixed_bytes(matrix.T)], names=[*keep, "codes"])

        return raw.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in raw.select(*keep).schema) + ", codes binary")

    def importance(self, **forest) -> tuple[DataFrame, list[dict[str, float]]]:
        """The forest's shares of the kept candidates, and its errors."""
        names = [c.label() for c in self.found.values()]
        return forest_importance(self.rows, names, "__y", key="__row", codes=[code(self.facts[s].place) for s in self.found], packed=self.codes, **forest)

    def _sketched(self, new: dict[int, C.Candidate], shares: Sequence[float]) -> dict[int, list[float]]:
        """The values at ``shares`` of each candidate that has any."""
        places = list(new)
        rows, values = self._batches(new, [])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sketches = [Sketch() for _ in places]
            for batch in batches:
                for sketch, v in zip(sketches, values(batch)):
                    sketch.add(v)
            for i, sketch in zip(places, sketches):
                for points, weight in sketch.parts():
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([weight]), pa.array([points.tobytes()], pa.binary())], names=["i", "weight", "points"])

        def read(parts: pa.Table) -> pa.Table:
            found = weighted_values([(np.frombuffer(p), w) for p, w in zip(parts.column("points").to_pylist(), parts.column("weight").to_pylist())], shares)
            return pa.table({"i": pa.array([parts.column("i")[0].as_py()], pa.int32()), "q": [found.tolist()]})

        parts = rows.mapInArrow(run, "i int, weight double, points binary")
        return {r["i"]: r["q"] for r in parts.groupBy("i").applyInArrow(read, "i int, q array<double>").collect()}

    def _measured(self, new: dict[int, C.Candidate]) -> tuple[list[Facts], np.ndarray]:
        """What is known of the new candidates, and the products of the deviations of all kept ones and these with these."""
        limits, cuts = self.limits, cut_points()
        sketch = self._sketched(new, [limits.clip_low, 0.5, limits.clip_high, *cuts[:-1]])
        ends = {i: (sketch.get(i) or [0.0] * 3)[:3] for i in new}
        known = {self.facts[s].place: c for s, c in self.found.items()}
        order = [(f.low, f.median, f.high) for f in (self.facts[s] for s in self.found)] + [tuple(ends[i]) for i in new]
        low, median, high = np.array(order).T[:, :, None]
        size, old = len(order), len(known)
        year = self.rows.schema["__year"].dataType.simpleString()
        schema = pa.schema([("what", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("year", pa.int32()), ("s", pa.float64()), ("least", pa.float64()), ("most", pa.float64())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            products, years = np.zeros((size, size - old)), {}
            least, most = np.full(size - old, np.inf), np.full(size - old, -np.inf)
            for batch in batches:
                if not batch.num_rows:
                    continue
                clipped = np.clip(matrix := np.stack(values(batch)), low, high, out=matrix)  # a line per candidate
                there = ~np.isnan(clipped[old:])
                least, most = np.fmin(least, np.fmin.reduce(clipped[old:], axis=1, initial=np.inf)), np.fmax(most, np.fmax.reduce(clipped[old:], axis=1, initial=-np.inf))
                apart = np.subtract(clipped, median, out=clipped)  # from the median, which stands for what is missing
                apart[np.isnan(apart)] = 0.0
                products += apart @ apart[old:].T
                coded = batch.column(0).dictionary_encode()
                names, which = [*coded.dictionary.to_pylist(), None], coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)
                of = (which[None, :] == np.arange(len(names))[:, None]).astype(np.float64)
                sums = np.stack([of @ there.T, of @ apart[old:].T, of @ (apart[old:] ** 2).T])
                for k, name in enumerate(names):
                    if rows := of[k].sum():
                        n, s = years.get(name, (0, 0.0))
                        years[name] = n + rows, s + sums[:, k]
            out = [(PRODUCT, i, j, None, products[i, j], None, None) for i in range(size) for j in range(size - old)]
            out += [(ENDS, i, None, None, None, least[i], most[i]) for i in range(size - old) if least[i] <= most[i]]
            for name, (n, sums) in years.items():
                out.append((ROWS, None, None, name, n, None, None))
                out += [(what, i, None, name, sums[k, i], None, None) for k, what in enumerate((PRESENT, SUM, SQUARES)) for i in range(size - old)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type if f.name != "year" else kind) for k, f in enumerate(schema)], names=schema.names)

        rows, values = self._batches(known | new, ["__year"])
        kind = rows.limit(0).toArrow().schema.field("__year").type
        parts = rows.mapInArrow(run, f"what int, i int, j int, year {year}, s double, least double, most double")
        found = parts.groupBy("what", "i", "j", "year").agg(F.sum("s").alias("s"), F.min("least").alias("least"), F.max("most").alias("most")).collect()  # some numbers per pair of candidates and per candidate and year
        products, per_year, per_end, n_of = np.zeros((size, size - old)), {}, {}, {}
        for r in found:
            if r["what"] == PRODUCT:
                products[r["i"], r["j"]] = r["s"]
            elif r["what"] == ENDS:
                per_end[r["i"]] = r["least"], r["most"]
            elif r["what"] == ROWS:
                n_of[r["year"]] = int(r["s"])
            else:
                per_year[r["what"], r["i"], r["year"]] = r["s"]
        n, names = sum(n_of.values()), sorted(n_of, key=lambda y: (y is None, y))
        out, sums = [], [self._sums[self.facts[s].place] for s in self.found]
        for k, i in enumerate(new):
            lo, mid, hi = ends[i]
            present, total, squares = (math.fsum(per_year[what, k, y] for y in names) for what in (PRESENT, SUM, SQUARES))
            mean = mid + total / present if present else None
            spread = math.sqrt(max(squares - total**2 / present, 0.0) / (present - 1)) if present > 1 else None
            by_year = tuple((y, mid + per_year[SUM, k, y] / p if (p := per_year[PRESENT, k, y]) else None) for y in names if y is not None)
            at = sorted({c for q in (sketch.get(i) or [])[3:] for c in [min(max(q, lo), hi)] if c > lo} | ({hi} if hi > lo else set())) or [hi]
            out.append(Facts(i, lo, mid, hi, tuple(at), n, int(present), *per_end.get(k, (None, None)), mean, spread, by_year))
            self._sums[i] = total
            sums.append(total)
        return out, products - np.outer(sums, sums[old:]) / max(n, 1)

    def _kept(self, f: Facts) -> bool:
        if not f.present or f.present / f.n <= self.limits.min_completeness:
            return False
        wide = f.most - f.least
        return wide > 0 and wide / max(abs(f.mean), abs(f.most), 1.0) > self.limits.min_spread

    def _extend(self, products: np.ndarray, kept: Sequence[int]) -> None:
        """Products of the new columns' deviations with those of all columns; ``kept`` are the new ones that stay."""
        old, size = len(self.products), len(self.products) + len(kept)
        grown = np.zeros((size, size))
        grown[:old, :old] = self.products
        fresh = products[:, list(kept)]
        grown[:, old:] = fresh[[*range(old), *(old + k for k in kept)]]
        grown[old:, :old] = grown[:old, old:].T
        self.products = grown

    def correlations(self) -> list[tuple[str, str, float]]:
        """(a, b, correlation) of all kept pairs; pairs with a constant are left out."""
        names = [c.label() for c in self.found.values()]
        size = np.sqrt(np.diag(self.products))
        return [(names[i], names[j], float(self.products[i, j] / (size[i] * size[j]))) for i in range(len(names)) for j in range(i + 1, len(names)) if size[i] > 0 and size[j] > 0]

    def statistics(self) -> tuple[DataFrame, DataFrame]:
        """(cand, n, present, lo, hi, mean, spread) of the kept candidates, and (cand, year, m)."""
        spark = self.rows.sparkSession
        facts = [(c.label(), self.facts[s]) for s, c in self.found.items()]
        stats = _local([(n, f.n, f.present, f.least, f.most, f.mean, f.spread) for n, f in facts], [("cand", pa.string()), ("n", pa.int64()), ("present", pa.int64()), *((x, pa.float64()) for x in ("lo", "hi", "mean", "spread"))])
        yearly = _local([(n, int(y), m) for n, f in facts for y, m in f.yearly], [("cand", pa.string()), ("year", pa.int64()), ("m", pa.float64())])
        return spark.createDataFrame(stats), spark.createDataFrame(yearly)

    def scores(self, use_forest: bool = True, **forest) -> tuple[DataFrame, list[dict[str, float]]]:
        """(cand, origin, predictive, information, stability, completeness, importance, significant, score) of the kept candidates, and the forest's errors."""
        stats, yearly = self.statistics()
        table = scoring.completeness(stats).join(scoring.information(stats).drop("variation"), "cand").join(scoring.drifted(yearly).drop("drift"), "cand", "left")
        names = [c.label() for c in self.found.values()]
        errors: list[dict[str, float]] = []
        if use_forest and names:
            importance, errors = self.importance(**forest)
            table = table.join(significant(importance, self.limits.signal_share), "cand")
        else:
            table = table.withColumns({"importance": F.lit(0.0), "predictive": F.lit(0.0), "significant": F.lit(False)})
        origin = self.rows.sparkSession.createDataFrame(_local([(c.label(), c.origin) for c in self.found.values()], [("cand", pa.string()), ("origin", pa.string())]))
        return scoring.composite(table.join(origin, "cand"), self.limits, neutral=0.5), errors


def _clipped(f: Facts) -> Column:
    v = F.col(f"__r{f.place}")
    return F.when(~F.isnan(v) & (F.abs(v) != math.inf), F.greatest(F.lit(f.low), F.least(F.lit(f.high), v)))


def _places(keys: pa.Array) -> Callable[[pa.Array], np.ndarray]:
    """Gives the places of a column's values among ``keys``, and the number of keys for a missing or unknown one."""
    n = len(keys)
    if pa.types.is_integer(keys.type) or pa.types.is_floating(keys.type):
        index = pd.Index(keys.to_numpy(zero_copy_only=False))

        def numbers(column: pa.Array) -> np.ndarray:
            at = index.get_indexer(column.fill_null(0).to_numpy(zero_copy_only=False))
            at[(at < 0) | column.is_null().to_numpy(zero_copy_only=False)] = n
            return at

        return numbers
    known = {key: i for i, key in enumerate(keys.to_pylist())}

    def others(column: pa.Array) -> np.ndarray:
        coded = column.dictionary_encode()
        at = np.array([*(known.get(v, n) for v in coded.dictionary.to_pylist()), n])
        return at[coded.indices.fill_null(len(coded.dictionary)).to_numpy(zero_copy_only=False)]

    return others


def _lookup(stats: DataFrame) -> tuple[pa.Array, list[np.ndarray]]:
    """Keys of a dimension, and for each statistic its values with a missing one behind them; at most ``COARSE_BYTES``."""
    table = stats.toArrow().combine_chunks()
    columns = [np.append(_finite(c), np.nan) for c in table.columns[1:]]
    keys = table.column(0)
    return keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else keys, columns


def _finite(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The numbers of a column; what is missing, NaN or infinite is NaN."""
    v = (column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)).astype(np.float64, copy=False)
    good = np.isfinite(v)
    return v if good.all() else np.where(good, v, np.nan)


def _local(rows: list[tuple], columns: list[tuple[str, pa.DataType]]) -> pa.Table:
    return pa.Table.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(columns)], names=[n for n, _ in columns])
