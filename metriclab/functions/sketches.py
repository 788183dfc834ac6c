"""Sketches of fixed size: stored by day, for distinct counts and quantiles of any span of days, and in tasks, for columns of Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Of the sketch for distinct values: 2 to this power registers.
REGISTERS = 12
#: Relative standard error of a distinct count with these registers; three of them are the stated bound.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (REGISTERS / 2)
#: Size of the quantile sketch, and the stated bound of the error of a rank as a share of all.
QUANTILE_SIZE, RANK_ERROR = 400, 0.015


def by_day(df: DataFrame, time: str, distinct: Sequence[str], numbers: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """(day, keys..., n, d_*, q_*, lo_*, hi_*): a row a day and key, whatever the number of rows.

    Rows without a time are of the day null.  Missing values are in no sketch.
    """
    made: list[Column] = [F.count("*").alias("n")]
    made += [F.hll_sketch_agg(F.col(c), F.lit(REGISTERS)).alias(f"d_{c}") for c in distinct]
    for c in numbers:
        v = F.col(c).cast("double")
        made += [F.kll_sketch_agg_double(v, F.lit(QUANTILE_SIZE)).alias(f"q_{c}"), F.min(v).alias(f"lo_{c}"), F.max(v).alias(f"hi_{c}")]
    return df.groupBy(F.to_date(time).alias("day"), *keys).agg(*made)


def merged(days: DataFrame, group: Sequence[Column | str], distinct: Sequence[str], numbers: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(group..., n, distinct_*, least_*, most_*, quantiles_*) of spans of days from their sketches alone."""
    made: list[Column] = [F.sum("n").alias("n")]
    made += [F.hll_sketch_estimate(F.hll_union_agg(f"d_{c}")).alias(f"distinct_{c}") for c in distinct]
    for c in numbers:
        made += [F.min(f"lo_{c}").alias(f"least_{c}"), F.max(f"hi_{c}").alias(f"most_{c}"), F.kll_sketch_get_quantile_double(F.kll_merge_agg_double(f"q_{c}"), F.array(*map(F.lit, quantiles))).alias(f"quantiles_{c}")]
    return days.groupBy(*group).agg(*made)


#: Points of a sketch in a task, values that are sorted at once, and sets of points that are kept side by side.
POINTS, CHUNK, SETS = 10_000, 65_536, 32


class Sketch:
    """A column's quantiles in a task.  Up to ``points`` values are kept as they are, more as points of equal weight.

    Each reduction moves a rank by half of 1 / ``points`` of the values in it at most; a value is in one for its chunk, and one for every ``SETS`` sets.
    """

    def __init__(self, points: int = POINTS, chunk: int = CHUNK):
        self.points, self.chunk = points, chunk
        self.plain: list[np.ndarray] = []
        self.waiting = 0
        self.sets: list[tuple[np.ndarray, float]] = []

    def add(self, values: np.ndarray) -> None:
        """Take values in; NaN is none."""
        values = values[~np.isnan(values)]
        self.plain.append(values)
        self.waiting += len(values)
        if self.waiting >= self.chunk:
            self._reduce()

    def _reduce(self) -> None:
        found = np.sort(np.concatenate(self.plain))
        self.plain, self.waiting = [], 0
        n = len(found)
        self.sets.append((found, 1.0) if n <= self.points else (found[((np.arange(self.points) + 0.5) * (n / self.points)).astype(np.int64)], n / self.points))
        if len(self.sets) > SETS:
            self._merge()

    def _merge(self) -> None:
        if sum(len(v) for v, _ in self.sets) > self.points:
            total = sum(len(v) * w for v, w in self.sets)
            self.sets = [(weighted_values(self.sets, (np.arange(self.points) + 0.5) / self.points), total / self.points)]

    def parts(self) -> list[tuple[np.ndarray, float]]:
        """(points, weight of each) of all values."""
        if self.waiting:
            self._reduce()
        self._merge()
        return self.sets


def weighted_values(sets: Sequence[tuple[np.ndarray, float]], shares: Sequence[float]) -> np.ndarray:
    """The smallest values at or below which the shares of the weight lie."""
    values = np.concatenate([v for v, _ in sets])
    weight = np.concatenate([np.full(len(v), w) for v, w in sets])
    order = np.argsort(values, kind="stable")
    reached = np.cumsum(weight[order])
    at = np.searchsorted(reached, np.asarray(shares) * reached[-1] * (1 - 1e-12))
    return values[order][np.minimum(at, len(values) - 1)]
