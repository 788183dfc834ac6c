"""Candidate indicators as small trees: built, named, compared, projected and exported from one form."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import once
from ..settings import Thresholds

MICROSECONDS = 86_400_000_000
OPERATIONS = ("ratio", "plain", "complement", "ratio_sum")


@dataclass(frozen=True)
class Candidate:
    """An indicator.  ``kind`` says how ``args`` are read.

    ratio (numerators, denominators) | plain (column) | complement (column, whole) |
    gap (later, earlier) | count (dim) | mean (candidate or column, dim) | sum (candidates)
    """

    kind: str
    args: tuple
    origin: str = "exhaustive"
    round: int = 0
    name: str = ""

    def signature(self) -> tuple:
        """Equal for indicators with equal values, whatever their name, round or order of terms."""
        part = lambda a: a.signature() if isinstance(a, Candidate) else a
        if self.kind == "ratio":
            return ("ratio", *(tuple(sorted(side)) for side in self.args))
        if self.kind == "sum":
            return ("sum", tuple(sorted((part(a) for a in self.args), key=repr)))
        return (self.kind, *map(part, self.args))

    def label(self) -> str:
        if self.name:
            return self.name
        part = lambda a: a.label() if isinstance(a, Candidate) else str(a)
        match self.kind:
            case "ratio":
                return f"ratio__{'_'.join(self.args[0])}__over__{'_'.join(self.args[1])}"
            case "mean":
                return f"mean__{part(self.args[0])}__by__{self.args[1]}"
            case "count":
                return f"count__by__{self.args[0]}"
            case "gap":
                return f"gap__{self.args[0]}__minus__{self.args[1]}"
            case "sum":
                return "sum__" + "__and__".join(part(a) for a in self.args)
        return "__".join([self.kind, *map(str, self.args)])

    def inputs(self) -> list[str]:
        """Columns of the table that it reads, parts of dates as their date."""
        out: list[str] = []
        for a in self.args:
            if isinstance(a, Candidate):
                out += a.inputs()
            elif isinstance(a, tuple):
                out += a
            elif isinstance(a, str):
                out.append(re.sub(r"__(?:year|month)$", "", a))
        return list(dict.fromkeys(out))

    def dims(self) -> list[str]:
        own = [self.args[-1]] if self.kind in ("mean", "count") else []
        return own + [d for a in self.args if isinstance(a, Candidate) for d in a.dims()]

    def is_simple_ratio(self) -> bool:
        return self.kind == "ratio"

    def describe(self) -> str:
        part = lambda a: a.describe() if isinstance(a, Candidate) else str(a)
        match self.kind:
            case "ratio":
                return f"({' + '.join(self.args[0])}) / ({' + '.join(self.args[1])})"
            case "plain":
                return str(self.args[0])
            case "complement":
                return f"{self.args[1]} - {self.args[0]}"
            case "gap":
                return f"days from {self.args[1]} to {self.args[0]}"
            case "count":
                return f"rows with the same {self.args[0]}"
            case "mean":
                return f"mean of {part(self.args[0])} over rows with the same {self.args[1]}"
        return " + ".join(part(a) for a in self.args)

    def to_sql(self, group_min: int = 10) -> str:
        """Row expression in standard SQL, group values as windows."""
        part = lambda a: a.to_sql(group_min) if isinstance(a, Candidate) else str(a)
        match self.kind:
            case "ratio":
                return f"CAST({' + '.join(self.args[0])} AS DOUBLE) / nullif({' + '.join(self.args[1])}, 0)"
            case "plain":
                return f"CAST({self.args[0]} AS DOUBLE)"
            case "complement":
                return f"{self.args[1]} - {self.args[0]}"
            case "count":
                return f"CASE WHEN {self.args[0]} IS NOT NULL THEN count(*) OVER (PARTITION BY {self.args[0]}) END"
            case "mean":
                d = self.args[1]
                return f"CASE WHEN {d} IS NOT NULL AND count(*) OVER (PARTITION BY {d}) >= {group_min} THEN avg({part(self.args[0])}) OVER (PARTITION BY {d}) END"
            case "gap":
                return f"floor(timestampdiff(MICROSECOND, {self.args[1]}, {self.args[0]}) / {MICROSECONDS})"
        return " + ".join(f"({part(a)})" for a in self.args)

    def to_dax(self, table: str, group_min: int = 10) -> str:
        """Formula of a calculated column of a tabular model.  Missing groups stay blank as they do here."""
        ref = lambda c: f"{table}[{c}]"
        part = lambda a: a.to_dax(table, group_min) if isinstance(a, Candidate) else ref(a)
        match self.kind:
            case "ratio":
                return f"DIVIDE({' + '.join(map(ref, self.args[0]))}, {' + '.join(map(ref, self.args[1]))})"
            case "plain":
                return ref(self.args[0])
            case "complement":
                return f"{self.args[1]} - {ref(self.args[0])}"
            case "gap":
                return f"INT({ref(self.args[0])} - {ref(self.args[1])})"
            case "count" | "mean":
                d = self.args[-1]
                match_rows = f"FILTER({table}, {ref(d)} = EARLIER({ref(d)}))"
                if self.kind == "count":
                    return f"IF(ISBLANK({ref(d)}), BLANK(), COUNTROWS({match_rows}))"
                return f"IF(ISBLANK({ref(d)}) || COUNTROWS({match_rows}) < {group_min}, BLANK(), AVERAGEX({match_rows}, {part(self.args[0])}))"
        return " + ".join(f"({part(a)})" for a in self.args)

    def row_column(self) -> Column:
        """The value from the row alone; group values are read from the columns that ``projected`` joins."""
        match self.kind:
            case "ratio":
                top, bottom = (sum((F.col(c).cast("double") for c in side[1:]), F.col(side[0]).cast("double")) for side in self.args)
                return F.try_divide(top, bottom)
            case "plain":
                return F.col(self.args[0]).cast("double")
            case "complement":
                return F.lit(float(self.args[1])) - F.col(self.args[0]).cast("double")
            case "gap":
                return F.floor(F.timestamp_diff("MICROSECOND", F.col(self.args[1]), F.col(self.args[0])) / F.lit(MICROSECONDS)).cast("double")
            case "sum":
                first, *rest = (a.row_column() for a in self.args)
                return sum(rest, first)
        raise ValueError(f"{self.kind} is a group value")


def column(value: Candidate | str) -> Column:
    return value.row_column() if isinstance(value, Candidate) else F.col(value).cast("double")


def group_statistics(df: DataFrame, dim: str, means: Sequence[Candidate | str], limits: Thresholds = Thresholds()) -> DataFrame:
    """(dim, _n, _m0, _m1, ...): size and means of every group of one dimension, null keys left out.

    All means of a dimension come from one aggregation, partial before the shuffle.
    """
    rows = df.filter(F.col(dim).isNotNull()).groupBy(dim).agg(F.count("*").alias("_n"), *[F.avg(column(m)).alias(f"_m{i}") for i, m in enumerate(means)])
    big = F.col("_n") >= limits.group_min_rows
    return rows.select(dim, F.col("_n").cast("double").alias("_n"), *[F.when(big, F.col(f"_m{i}")).alias(f"_m{i}") for i in range(len(means))])


#: Dimensions of one aggregation by grouping sets.
FAMILIES = 30


def family_id(k: int, dims: int) -> int:
    """``grouping_id`` of the rows that are grouped by dimension ``k`` of ``dims`` alone."""
    return (1 << dims) - 1 - (1 << (dims - 1 - k))


def group_families(df: DataFrame, dims: Sequence[str], means: Sequence[Candidate | str], limits: Thresholds = Thresholds()) -> DataFrame:
    """(_d0, _d1, ..., _family, _n, _m0, _m1, ...): size and means of every group of every dimension, from one scan.

    ``_family`` is the grouping id, which names the dimension; null keys are left out.
    """
    ds = [f"_d{k}" for k in range(len(dims))]
    rows = df.select(*[F.col(f"`{d}`").alias(x) for d, x in zip(dims, ds)], *[column(m).alias(f"_v{i}") for i, m in enumerate(means)])
    found = rows.groupingSets([[F.col(x)] for x in ds], *map(F.col, ds)).agg(F.grouping_id().alias("_family"), F.count("*").alias("_n"), *[F.avg(f"_v{i}").alias(f"_m{i}") for i in range(len(means))])
    found = found.filter(reduce(or_, [F.col(x).isNotNull() for x in ds]))
    big = F.col("_n") >= limits.group_min_rows
    return found.select(*ds, F.col("_family").cast("long").alias("_family"), F.col("_n").cast("double").alias("_n"), *[F.when(big, F.col(f"_m{i}")).alias(f"_m{i}") for i in range(len(means))])


def statistics_by_dim(df: DataFrame, dims: Sequence[str], grouped: Sequence[Candidate], limits: Thresholds, write: bool = False) -> dict[str, tuple[DataFrame, list]]:
    """For each dimension (dim, _n, _m0, ...) and its means; several dimensions, or one to ``write``, come from one written aggregation."""
    wanted = {d: [c.args[0] for c in grouped if c.args[-1] == d and c.kind == "mean"] for d in dims}
    if len(dims) < 2 and not write:
        return {d: (group_statistics(df, d, means, limits), means) for d, means in wanted.items()}
    out = {}
    for lo in range(0, len(dims), FAMILIES):
        some = dims[lo : lo + FAMILIES]
        means = list(dict.fromkeys(m for d in some for m in wanted[d]))
        table = once(group_families(df, some, means, limits), "families")
        for k, d in enumerate(some):
            rows = table.filter((F.col("_family") == family_id(k, len(some))) & F.col(f"_d{k}").isNotNull())
            out[d] = rows.select(f"_d{k}", "_n", *[F.col(f"_m{means.index(m)}").alias(f"_m{i}") for i, m in enumerate(wanted[d])]), wanted[d]
    return out


def fine_name(candidate: Candidate) -> str:
    """The column that ``with_fine`` adds for a group value."""
    return f"__fine__{candidate.label()}"


def with_fine(df: DataFrame, candidates: Sequence[Candidate], dims: Sequence[str], limits: Thresholds = Thresholds()) -> DataFrame:
    """``df`` with the group values by ``dims`` as columns, which ``projected`` takes as they are.

    For dimensions with few rows in every group, nearly as many groups as rows: an
    aggregation and a join would both shuffle the table, a window shuffles it once and not at
    all where a join has already laid the groups together.
    """
    for c in unique(c for c in candidates if c.kind in ("mean", "count") and c.args[-1] in dims):
        own = Window.partitionBy(c.args[-1])
        n = F.count("*").over(own)
        value = F.when(n >= limits.group_min_rows, F.avg(column(c.args[0])).over(own)) if c.kind == "mean" else n.cast("double")
        df = df.withColumn(fine_name(c), F.when(F.col(c.args[-1]).isNotNull(), value))
    return df


def projected(df: DataFrame, candidates: Sequence[Candidate], keep: Sequence[str | Column] = (), limits: Thresholds = Thresholds()) -> DataFrame:
    """``keep`` and a DOUBLE column per candidate, named by its label, for every row.

    All dimensions are aggregated in one scan and joined one by one; whether a join is
    broadcast is left to the engine, which knows the size at run time.  Columns of ``with_fine`` are taken as they are.
    """
    source = {c.signature(): F.col(f"`{fine_name(c)}`") for c in candidates if fine_name(c) in df.columns}
    grouped = [c for c in candidates if c.kind in ("mean", "count") and c.signature() not in source]
    dims = list(dict.fromkeys(c.args[-1] for c in grouped))
    out = df
    for k, (dim, (stats, means)) in enumerate(statistics_by_dim(df, dims, grouped, limits).items()):
        stats = stats.toDF(f"_k{k}", f"_n{k}", *[f"_m{k}_{i}" for i in range(len(means))])
        out = out.join(stats, out[dim] == stats[f"_k{k}"], "left")
        source |= {(c.signature()): F.col(f"_n{k}") for c in grouped if c.args[-1] == dim and c.kind == "count"}
        source |= {c.signature(): F.col(f"_m{k}_{means.index(c.args[0])}") for c in grouped if c.args[-1] == dim and c.kind == "mean"}
    return out.select(*keep, *[(source[c.signature()] if c.kind in ("mean", "count") else c.row_column()).alias(c.label()) for c in candidates])


def long_form(df: DataFrame, candidates: Sequence[Candidate], keep: Sequence[Column] = (), limits: Thresholds = Thresholds()) -> DataFrame:
    """(keep..., cand, v): a row per row and candidate; NaN and infinities are missing."""
    wide = projected(df, candidates, keep, limits)
    names = [n for n in wide.columns if n not in {c.label() for c in candidates}]
    items = F.array(*[F.struct(F.lit(c.label()).alias("cand"), F.col(f"`{c.label()}`").alias("v")) for c in candidates])
    rows = wide.select(*names, F.explode(items).alias("_p")).select(*names, "_p.cand", "_p.v")
    return rows.withColumn("v", F.when(~F.isnan("v") & (F.abs("v") != float("inf")), F.col("v")))


def exhaustive(numerators: Sequence[str], denominators: Sequence[str], dims: Sequence[str], targets: Sequence[str], dates: Sequence[str], skip: Iterable[tuple[str, str]] = ()) -> list[Candidate]:
    """Ratios, group means, group counts and day gaps of the working lists; ``skip`` lists ratio pairs to leave out."""
    out_of = set(skip)
    ratios = [Candidate("ratio", ((n,), (d,))) for n in numerators for d in denominators if n != d and (n, d) not in out_of]
    means = [Candidate("mean", (t, d)) for d in dims for t in targets if t != d]
    counts = [Candidate("count", (d,)) for d in dims]
    gaps = [Candidate("gap", (a, b)) for i, a in enumerate(dates) for b in dates[i + 1 :]]
    return unique([*ratios, *means, *counts, *gaps])


def unique(candidates: Iterable[Candidate]) -> list[Candidate]:
    """The first of each signature."""
    return list({c.signature(): c for c in reversed(list(candidates))}.values())[::-1]


def crossed(ratios: Sequence[Candidate], dims: Sequence[str], round_: int) -> list[Candidate]:
    """Sums of simple ratios over the same denominators, and their group means."""
    simple = [c for c in ratios if c.is_simple_ratio()]
    sums = [Candidate("sum", (a, b), "crossover", round_) for i, a in enumerate(simple) for b in simple[i + 1 :] if sorted(a.args[1]) == sorted(b.args[1])]
    return unique([*sums, *ratio_means(simple, dims, round_)])


def ratio_means(ratios: Sequence[Candidate], dims: Sequence[str], round_: int) -> list[Candidate]:
    """The group means among ``crossed``."""
    return [Candidate("mean", (c, d), "crossover", round_) for c in ratios if c.is_simple_ratio() for d in dims if d not in c.inputs()]


def slug(text: str) -> str:
    return re.sub(r"\W+", "_", text.strip().lower()).strip("_") or "indicator"


def checked_proposals(proposals: Sequence[dict], columns: Sequence[str], numbers: Sequence[str], target: str) -> tuple[list[dict], list[tuple[str, str]]]:
    """Usable proposals without repeats, and (name, reason) of the others."""
    good, bad, seen = [], [], set()
    for p in proposals:
        name, op = str(p.get("name", "")), p.get("operation")
        pairs = p.get("ratios") or []
        sides = {"ratio": [p.get("numerator") or [], p.get("denominator") or []], "ratio_sum": [s for r in pairs for s in (r.get("numerator") or [], r.get("denominator") or [])]}.get(op, [[p.get("column")]] if p.get("column") else [[]])
        used = [c for side in sides for c in side]
        if op not in OPERATIONS:
            bad.append((name, f"unknown operation {op}"))
        elif not sides or any(not side for side in sides):
            bad.append((name, "an empty side"))
        elif missing := [c for c in used if c not in columns]:
            bad.append((name, f"unknown columns {', '.join(missing)}"))
        elif target in used:
            bad.append((name, "uses the target"))
        elif other := [c for c in used if c not in numbers]:
            bad.append((name, f"not numeric: {', '.join(other)}"))
        else:
            key = (op, tuple(sorted(tuple(map(tuple, map(sorted, sides[i : i + 2]))) for i in range(0, len(sides), 2))) if op != "ratio" else tuple(tuple(sorted(s)) for s in sides))
            if key in seen:
                bad.append((name, "repeats another"))
            else:
                seen.add(key)
                good.append(p)
    return good, bad


def guided(df: DataFrame, proposals: Sequence[dict], columns: Sequence[str], numbers: Sequence[str], target: str, limits: Thresholds = Thresholds()) -> tuple[list[Candidate], list[tuple[str, str]]]:
    """Candidates from proposals, and why others were rejected; one job settles all complements."""
    good, bad = checked_proposals(proposals, columns, numbers, target)
    wholes = complement_wholes(df, [p["column"] for p in good if p["operation"] == "complement"], limits)
    out: list[Candidate] = []
    taken: dict[str, int] = {}
    for p in good:
        base = slug(str(p.get("name", "")))
        taken[base] = taken.get(base, 0) + 1
        name = f"domain__{base}" + (f"_{taken[base]}" if taken[base] > 1 else "")
        match p["operation"]:
            case "ratio":
                out.append(Candidate("ratio", (tuple(p["numerator"]), tuple(p["denominator"])), "domain", name=name))
            case "plain":
                out.append(Candidate("plain", (p["column"],), "domain", name=name))
            case "complement" if wholes[p["column"]] is None:
                bad.append((str(p.get("name", "")), "values are neither shares nor percentages"))
            case "complement":
                out.append(Candidate("complement", (p["column"], wholes[p["column"]]), "domain", name=name))
            case _:
                parts = tuple(Candidate("ratio", (tuple(r["numerator"]), tuple(r["denominator"])), "domain") for r in p["ratios"])
                out.append(Candidate("sum", parts, "domain", name=name))
    return out, bad


def complement_wholes(df: DataFrame, columns: Sequence[str], limits: Thresholds = Thresholds()) -> dict[str, int | None]:
    """1 for columns of shares, 100 for columns of percentages, None for others."""
    names = list(dict.fromkeys(columns))
    if not names:
        return {}
    share = lambda c, top: F.avg(F.col(c).between(0, top).cast("double"))
    row = df.agg(*[share(c, top).alias(f"{c}|{top}") for c in names for top in (1, 100)]).first()
    return {c: next((top for top in (1, 100) if (row[f"{c}|{top}"] or 0) > limits.complement_share), None) for c in names}
