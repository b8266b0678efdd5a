"""Partitioned scans.

Baselines live under ``{root}/{version}/{activity}/fyear=Y/dataset=D/*.parquet``
and full results under ``{results}/{activity}/model_run=N/*.parquet``.  One scan
covers every run or dataset; equality filters on partition columns become
``PartitionFilters`` (directory pruning), other predicates ``PushedFilters``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import require_columns


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """One parquet file or directory (aggregated results by name included)."""
    return spark.read.parquet(path)


def baseline_path(root: str, version: str, activity: str) -> str:
    return f"{root.rstrip('/')}/{version}/{activity}"


def filter_partitions(df: DataFrame, dataset: str | Sequence[str] | None = None,
                      fyear: int | None = None) -> DataFrame:
    """Exact partition equality (``RX`` never matches ``RX1``), all files."""
    if fyear is not None:
        df = df.where(F.col("fyear") == F.lit(int(fyear)))
    if dataset is not None:
        ds = [dataset] if isinstance(dataset, str) else list(dataset)
        df = df.where(F.col("dataset").isin(ds))
    return df


def scan_baseline(source: SparkSession | DataFrame, root: str | None = None,
                  version: str | None = None, activity: str = "ip",
                  dataset: str | Sequence[str] | None = None, fyear: int | None = None,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """Baseline rows of one version/activity, pruned to dataset and year.

    ``source`` is a session (read from the layout) or an already loaded table.
    ``columns`` is checked up front and used as the projection (column pruning).
    """
    if isinstance(source, SparkSession):
        df = source.read.option("basePath", baseline_path(root, version, activity)).parquet(
            baseline_path(root, version, activity))
    else:
        df = source
    df = filter_partitions(df, dataset, fyear)
    if columns is not None:
        require_columns(df, columns, f"{activity} baseline")
        df = df.select(*columns)
    return df


def scan_runs(source: SparkSession | DataFrame, results_root: str | None = None,
              activity: str = "ip", runs: Sequence[int] | None = None,
              columns: Sequence[str] | None = None) -> DataFrame:
    """Every run of an activity in one scan; ``model_run`` from partition
    discovery (``model_run=N`` directories)."""
    if isinstance(source, SparkSession):
        path = f"{results_root.rstrip('/')}/{activity}"
        df = source.read.option("basePath", path).parquet(path)
    else:
        df = source
    require_columns(df, ["model_run"], f"{activity} runs")
    if runs is not None:
        df = df.where(F.col("model_run").isin(list(runs)))
    if columns is not None:
        require_columns(df, columns, f"{activity} runs")
        df = df.select(*columns)
    return df


def list_datasets(df: DataFrame, by: Sequence[str] = ("fyear",)) -> DataFrame:
    """Datasets available (per year).  On a partitioned scan this reads only
    partition values (no data pages)."""
    return df.select(*by, "dataset").distinct()
