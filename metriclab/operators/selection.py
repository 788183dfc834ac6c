"""Choosing among scored candidates: redundancy, vetoes, best of each origin, weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import rank_pct
from ..settings import Thresholds

SCORES = ("predictive", "information", "stability", "completeness")


def weak_veto(scores: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """``scores`` with ``weakest`` and ``kept``: any percentile below the limit drops a candidate, domain ones never.

    A score that nobody has is no reason to drop.
    """
    pct = {f"_{c}": rank_pct(c) for c in SCORES}
    out = scores.withColumns(pct)
    weakest = F.least(*[F.col(f"_{c}") for c in SCORES])
    missing = F.lit(False)
    for c in SCORES:
        missing = missing | (F.col(c).isNull() & (F.count(c).over(Window.partitionBy()) > 0))
    kept = (F.col("origin") == "domain") | (~missing & (F.coalesce(weakest, F.lit(1.0)) >= limits.veto))
    return out.withColumn("weakest", weakest).withColumn("kept", kept).drop(*pct)


def greedy_prune(ranking: list[tuple[str, float, str]], pairs: list[tuple[str, str, float]], limits: Thresholds = Thresholds()) -> list[str]:
    """Names that stay of (name, score, origin): best first, domain ones before all, each evicting what repeats it.

    It runs on a row per candidate; equal scores stand by name.
    """
    close: dict[str, set[str]] = {}
    for a, b, r in pairs:
        if r is not None and abs(r) > limits.redundancy_correlation:
            close.setdefault(a, set()).add(b)
            close.setdefault(b, set()).add(a)
    gone: set[str] = set()
    kept = []
    for name, _, _ in sorted(ranking, key=lambda x: (-((x[1] if x[1] is not None else 0.0) + 10 * (x[2] == "domain")), x[0])):
        if name not in gone:
            kept.append(name)
            gone |= close.get(name, set())
    return kept


def top_per_origin(scores: DataFrame, limit: int = 30, drop_crossover: bool = False) -> DataFrame:
    """All domain candidates and the best ``limit`` of the others, ranked together."""
    if drop_crossover:
        scores = scores.filter("origin != 'crossover'")
    domain = F.col("origin") == "domain"
    place = F.row_number().over(Window.partitionBy(domain).orderBy(F.col("score").desc_nulls_last(), F.col("cand")))
    return scores.withColumn("_place", place).filter(domain | (F.col("_place") <= limit)).drop("_place")


def weight_grid(step: float = 0.05, floor: float = 0.0) -> list[tuple[int, float, float, float, float]]:
    """Numbered weights on the simplex in order."""
    n, low = round(1 / step), round(floor / step)
    found = [(a, b, c, n - a - b - c) for a in range(low, n + 1) for b in range(low, n + 1 - a) for c in range(low, n + 1 - a - b) if n - a - b - c >= low]
    return [(i, *(w / n for w in ws)) for i, ws in enumerate(found)]


def weight_search(scores: DataFrame, step: float = 0.05, floor: float = 0.10) -> DataFrame:
    """(grid_id, weights, objective) of every weighting: the mean rank percentile of the domain candidates.

    Scores and grid both have a bounded number of rows, so all weightings are ranked in one job.
    """
    rows = ", ".join(f"({i}, {a}D, {b}D, {c}D, {d}D)" for i, a, b, c, d in weight_grid(step, floor))
    grid = scores.sparkSession.sql(f"SELECT * FROM VALUES {rows} AS t(grid_id, w1, w2, w3, w4)")
    total = F.round(F.col("w1") * F.col("predictive") + F.col("w2") * F.col("information") + F.col("w3") * F.col("stability") + F.col("w4") * F.col("completeness"), 9)
    ranked = grid.crossJoin(scores.select("origin", *SCORES)).withColumn("s", total)
    ranked = ranked.withColumn("p", rank_pct("s", ["grid_id"]))
    return ranked.filter("origin = 'domain'").groupBy("grid_id", "w1", "w2", "w3", "w4").agg(F.avg("p").alias("objective"))


def best_weights(search: DataFrame) -> tuple[float, ...] | None:
    """The first of the best; None where no domain candidate was there to judge by."""
    row = search.filter("objective is not null").orderBy(F.desc(F.round("objective", 9)), "grid_id").first()
    return row and (row["w1"], row["w2"], row["w3"], row["w4"])
