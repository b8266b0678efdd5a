"""J6 attach-baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_baseline(results: DataFrame, baseline_cells: DataFrame, keys: Sequence[str],
                    baseline_col: str = "baseline") -> DataFrame:
    """Full outer join of run summaries with baseline cell values; gaps -> 0."""
    keys = list(keys)
    base = baseline_cells.select(*keys, F.col("value").cast("double").alias(baseline_col))
    joined = results.join(base, on=keys, how="full")
    fill_cols = [c for c in joined.columns if c not in keys]
    return joined.na.fill(0, subset=fill_cols)
