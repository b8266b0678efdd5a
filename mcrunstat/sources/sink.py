"""S17-S19 sinks: CSV and parquet side by side, skipped when both are complete."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


FORMATS = ("parquet", "csv")


def _hadoop_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def _complete(spark: SparkSession, path: str) -> bool:
    return _hadoop_exists(spark, f"{path}/_SUCCESS")


def outputs_exist(spark: SparkSession, base: str, formats: Sequence[str] = FORMATS) -> bool:
    """All formats written completely (``_SUCCESS`` in each)."""
    return all(_complete(spark, f"{base}.{f}") for f in formats)


def write_results(df: DataFrame, base: str, sort_by: Sequence[str] | None = None,
                  skip_existing: bool = True, formats: Sequence[str] = FORMATS,
                  descending: Sequence[str] = ()) -> bool:
    """S17/S18 + O1/O2: write ``{base}.{format}`` for each format (CSV with a header),
    sorted only here, at the sink, by ``sort_by`` (those in ``descending`` from the
    largest).  Returns False when all were complete already (S19).

    A format is skipped only if its folder holds ``_SUCCESS``; a folder left by a write
    that did not end is written anew.  With two formats to write, the plan is checkpointed
    once to the shared folder, so the second write does not compute it again.
    """
    spark = df.sparkSession
    todo = [f for f in formats if not (skip_existing and _complete(spark, f"{base}.{f}"))]
    if not todo:
        return False
    if len(todo) > 1:
        ensure_checkpoint_dir(spark)
        df = df.checkpoint(eager=True)
    if sort_by:
        df = df.orderBy(*[F.col(c).desc() if c in descending else F.col(c).asc() for c in sort_by])
    for f in todo:
        df.write.mode("overwrite").format(f).options(**({"header": True} if f == "csv" else {})).save(f"{base}.{f}")
    return True


def advance_state(batch: DataFrame, root: str, merge) -> DataFrame:
    """Join ``batch`` to the state under ``root`` and return the new state, read back.

    Each state is a folder ``version=N``; the latest complete one (``_SUCCESS``) counts, so a
    merge that failed leaves the old state as it was.  ``merge(states)`` makes one of two.
    """
    spark = batch.sparkSession
    last = 0
    while _complete(spark, f"{root}/version={last + 1}"):
        last += 1
    state = merge([spark.read.parquet(f"{root}/version={last}"), batch]) if last else batch
    state.write.mode("overwrite").parquet(f"{root}/version={last + 1}")
    return spark.read.parquet(f"{root}/version={last + 1}")


def output_base(root: str, scenario: str, product: str, activity: str, agg_type: str) -> str:
    """The aggregation type is part of the output name; ``root`` is the caller's, never
    the checkpoint folder."""
    return f"{root.rstrip('/')}/{scenario}_{product}_{activity}_{agg_type}"


def write_activities(products: dict[str, DataFrame], root: str, scenario: str, product: str, agg_type: str,
                     activities: Sequence[str] = ("ip", "op", "aae"), formats: Sequence[str] = FORMATS,
                     sort_by: dict[str, Sequence[str]] | None = None,
                     descending: Sequence[str] = ()) -> dict[str, bool]:
    """Write the chosen activities' products, each skipped on its own when complete;
    says per activity whether it was written."""
    unknown = [a for a in activities if a not in products]
    if unknown:
        raise ValueError(f"no product for {unknown}; there are {sorted(products)}")
    return {a: write_results(products[a], output_base(root, scenario, product, a, agg_type),
                             sort_by=(sort_by or {}).get(a), formats=formats, descending=descending)
            for a in activities}


def save_bucketed(df: DataFrame, table: str, buckets: int, key: str = "rn",
                  partition_by: Sequence[str] = (), mode: str = "overwrite",
                  path: str | None = None) -> None:
    """Store a baseline or run table bucketed (and sorted) by ``key``.

    When both sides of the baseline/run join are stored this way with the same
    bucket count, Spark joins them bucket by bucket without shuffling either side;
    ``partition_by`` (e.g. ``model_run``, ``fyear``) keeps directory pruning;
    ``path`` stores the table at a shared location instead of the warehouse.
    """
    w = df.write.mode(mode).bucketBy(buckets, key).sortBy(key)
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(table)
