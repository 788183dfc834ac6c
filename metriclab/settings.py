"""Settings of a run, from the environment or given in code."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields
from pathlib import Path


@dataclass(frozen=True)
class Thresholds:
    """Limits of every operator; the defaults are the documented ones."""

    date_parse_share: float = 0.8
    zero_share: float = 0.5
    outlier_spread: float = 3.0
    outlier_min_rows: int = 10
    leak_correlation: float = 0.9
    duplicate_correlation: float = 0.98
    tautology_correlation: float = 0.95
    redundancy_correlation: float = 0.95
    near_key_ratio: float = 0.9
    low_cardinality: float = 0.3
    repeat_min_rows: int = 10
    repeat_share: float = 0.8
    group_min_rows: int = 10
    complement_share: float = 0.9
    clip_low: float = 0.01
    clip_high: float = 0.99
    min_completeness: float = 0.30
    min_spread: float = 1e-8
    veto: float = 0.10
    signal_share: float = 0.02
    weights: tuple[float, float, float, float] = (0.60, 0.20, 0.10, 0.10)
    best_ratios: int = 15
    final: int = 30
    rounds: int = 3
    sql_rows: int = 200
    sql_repairs: int = 2


@dataclass(frozen=True)
class Settings:
    """Where a run reads and writes.  Each field is read from ``METRICLAB_<NAME>``."""

    data_path: str = "data/observations.parquet"
    dictionary_path: str = ""
    target: str = "RESULTAT"
    year_column: str = ""
    output_dir: str = "output"
    table_name: str = "observations"
    bi_table_name: str = "Observations"
    model_url: str = ""
    model_name: str = ""
    thresholds: Thresholds = field(default_factory=Thresholds)

    @staticmethod
    def from_env(env: dict[str, str] | None = None) -> Settings:
        env = dict(os.environ) if env is None else env
        found = {f.name: env[f"METRICLAB_{f.name.upper()}"] for f in fields(Settings) if f"METRICLAB_{f.name.upper()}" in env}
        return Settings(**found)

    def dictionary(self) -> str:
        """The dictionary given, or the first of dictionary.xlsx, .csv and .txt beside the data."""
        if self.dictionary_path:
            return self.dictionary_path
        folder = Path(self.data_path).parent
        return next((str(p) for s in (".xlsx", ".csv", ".txt") if (p := folder / f"dictionary{s}").exists()), "")
