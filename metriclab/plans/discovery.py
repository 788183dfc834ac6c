"""The indicator pipeline: clean, generate, score in rounds with crossover, select, explain."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, VariantType

from ..functions.scratch import once
from ..operators import candidates as C
from ..operators import selection
from ..operators.cleaning import numeric_columns
from ..operators.roles import WorkingLists, extended_dims, ratio_pairs, with_date_parts
from ..settings import Thresholds
from .ledger import Ledger


@dataclass
class Discovery:
    """A finished run: the ranking, its candidates, held-out errors and what was rejected."""

    ranking: DataFrame
    candidates: dict[str, C.Candidate]
    errors: list[dict[str, float]] = field(default_factory=list)
    rejected: list[tuple[str, str]] = field(default_factory=list)


@dataclass(frozen=True)
class Options:
    limits: Thresholds = field(default_factory=Thresholds)
    trees: int = 200
    depth: int = 8
    folds: int = 5
    drop_crossover: bool = False
    use_forest: bool = True


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with ``row_id``, a hash of the row: after removal of repeats it tells rows apart."""
    plain = lambda f: isinstance(f.dataType, AtomicType) and not isinstance(f.dataType, VariantType)  # noqa: E731  hashed as it stands, which takes less than its text
    return df.withColumn("row_id", F.xxhash64(*[F.col(f"`{f.name}`") if plain(f) else F.col(f"`{f.name}`").cast("string") for f in df.schema]))


def discover(df: DataFrame, target: str, lists: WorkingLists, proposals: Sequence[dict] = (), year: str | None = None, options: Options = Options()) -> Discovery:
    """Rank the indicators of a cleaned table.

    Each round measures the candidates that are new, ranks all, drops what is redundant or
    weak, and crosses the best simple ratios for the next; what has been seen in any round
    isn't built again.  The last ranking is always cut to the final size.
    """
    limits = options.limits
    df = once(with_date_parts(numbered(df), lists.dates), "observations")
    dims = [d for d in extended_dims(df, lists, target, limits) if d in df.columns]
    year = year or (f"year(`{lists.dates[0]}`)" if lists.dates else "1")
    skip = []
    if lists.numerators and lists.denominators:
        skip = [(r["num"], r["den"]) for r in ratio_pairs(df, lists.numerators, lists.denominators, limits).filter("not kept").collect()]
    domain, rejected = C.guided(df, proposals, df.columns, numeric_columns(df), target, limits) if proposals else ([], [])
    found = C.unique([*domain, *C.exhaustive(lists.numerators, lists.denominators, dims, lists.targets, lists.dates, skip)])
    if not found:
        raise ValueError("the working lists give no candidates")
    ledger = Ledger(df, target, year, [*dims, *(x for c in found for x in (*c.inputs(), *c.dims()))], limits)
    ledger.prepare([*found, *C.ratio_means(found, dims, 1)])  # whatever a later round may cross, so that groups are joined once
    seen = {c.signature() for c in found}
    new, ranking, errors = found, None, []
    for round_ in range(limits.rounds):
        ledger.add(new)
        table, errors = ledger.scores(options.use_forest, trees=options.trees, depth=options.depth, folds=options.folds)
        kept_rows = table.collect()  # a row per candidate; the ranking starts from it
        table = df.sparkSession.createDataFrame(kept_rows, table.schema)
        by_name = {c.label(): c for c in ledger.found.values()}
        stay = selection.greedy_prune([(r["cand"], r["score"], r["origin"]) for r in kept_rows], ledger.correlations(), limits)
        ranking = selection.weak_veto(table, limits).filter(F.col("kept") & F.col("cand").isin(stay)).drop("kept", "weakest")
        if round_ == limits.rounds - 1:
            break
        order = ranking.orderBy(F.col("score").desc_nulls_last(), "cand").select("cand").collect()
        best = [c for r in order if (c := by_name[r["cand"]]).is_simple_ratio()][: limits.best_ratios]
        new = [c for c in C.crossed(best, dims, round_ + 1) if c.signature() not in seen]
        if not new:
            break
        seen |= {c.signature() for c in new}
        found = [*found, *new]
    final = selection.top_per_origin(ranking, limits.final, options.drop_crossover)
    return Discovery(final.orderBy(F.col("score").desc_nulls_last(), "cand"), {c.label(): c for c in found}, errors, rejected)
