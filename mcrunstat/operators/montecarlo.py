"""Summaries over Monte Carlo runs: A5 run summary, A6 run lists, A10 gap fill,
A11 normal interval.

Per cell there are at most ``n_runs`` values (one per run), so every per-cell
array below is bounded by the run count, never by the data size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N_RUNS = 256  # fixed value: runs per scenario
Z_90 = 1.645  # fixed value: two-sided 90 % normal quantile used for intervals
SUMMARY_COLUMNS = ("lwr_ci", "median", "mean", "upr_ci")
SUMMARY_QUANTILES = (("lwr_ci", 0.1), ("median", 0.5), ("upr_ci", 0.9))


def _quantile(sorted_arr: Column, p: float, n: int) -> Column:
    """Linear-interpolated quantile of a sorted array of length ``n`` (numpy rule)."""
    h = p * (n - 1)
    lo = math.floor(h)
    t = h - lo
    a = F.element_at(sorted_arr, lo + 1)
    if t == 0 or lo + 1 >= n:
        return a
    b = F.element_at(sorted_arr, lo + 2)
    d = b - a
    # numpy evaluates from the nearer end for t >= 0.5
    return a + d * t if t < 0.5 else b - d * (1 - t)


def run_summary(per_run: DataFrame, cells: Sequence[str], n_runs: int = N_RUNS,
                value: str = "value", all_runs_kept: bool = False) -> DataFrame:
    """A5: per cell, zero-pad to ``n_runs`` values, then p10/p50/mean/p90.

    One aggregation keyed by cell after the per-(run, cell) totals; the padding is
    an ``array_repeat`` of zeros, never materialised rows.  More values than runs
    raises (D12); with ``all_runs_kept`` any shortfall raises as well.
    """
    cells = list(cells)
    g = per_run.groupBy(*cells).agg(
        F.collect_list(F.col(value).cast("double")).alias("_vals"),
        F.sum(F.col(value).cast("double")).alias("_sum"),
    )
    return _summarised(g, cells, n_runs, all_runs_kept)


def _summarised(g: DataFrame, cells: Sequence[str], n_runs: int, all_runs_kept: bool = False) -> DataFrame:
    """Quantiles and mean of ``_vals`` (at most ``n_runs``) and ``_sum`` per cell."""
    have = F.size("_vals")
    bad = have > n_runs if not all_runs_kept else have != n_runs
    padded = F.when(bad, F.raise_error(F.lit(f"cell has a run count other than n_runs={n_runs}"))) \
        .otherwise(F.array_sort(F.concat(F.col("_vals"),
                                         F.array_repeat(F.lit(0.0), F.lit(n_runs) - have))))
    g = g.withColumn("_sorted", padded)
    out = {name: _quantile(F.col("_sorted"), p, n_runs) for name, p in SUMMARY_QUANTILES}
    out["mean"] = F.col("_sum") / F.lit(float(n_runs))
    return g.select(*cells, *[out[c].alias(c) for c in SUMMARY_COLUMNS])


#: Fixed value: the measure under which a table of per-run values carries its row counts.
ROWS = "_rows"


def checked_summary(per_run: DataFrame, expected: DataFrame, cells: Sequence[str], by: Sequence[str],
                    n_runs: int = N_RUNS, run: str = "model_run") -> DataFrame:
    """A5 with C6 inside, in one pass: ``run_summary`` of a table that also holds, under the
    measure ``ROWS``, how many run rows went into each (run, cell).

    ``expected`` has ``by`` and ``rows``.  If for any ``by`` a run among 1..``n_runs`` is
    missing or has another number of rows, or there are runs beyond, the job raises.  Row counts
    are added per run by a second, map-side combined aggregation of the reduced table, so nothing
    reads the runs again.  Null ``by`` (run rows without a baseline row) raise as well; cells
    with a null key are counted but not reported (D4).
    """
    cells, by = list(cells), list(by)
    keys = [*cells, "measure"]
    is_rows = F.col("measure") == ROWS
    whole = F.lit(True)
    for c in keys:
        whole = whole & F.col(c).isNotNull()
    long = per_run.where(is_rows | (whole & F.col("value").isNotNull())).select(
        run, *[F.col(c) if c in by else F.when(~is_rows, F.col(c)).alias(c) for c in cells], "measure", "value")
    # the expected count travels as a run of its own: null
    types = dict(long.dtypes)
    base = expected.select(F.lit(None).cast(types[run]).alias(run),
                           *[F.col(c) if c in by else F.lit(None).cast(types[c]).alias(c) for c in cells],
                           F.lit(ROWS).alias("measure"), F.col("rows").cast(types["value"]).alias("value"))
    totals = long.unionByName(base).groupBy(run, *keys).agg(F.sum("value").alias("value"))
    real = F.when(F.col(run).isNotNull(), F.col("value").cast("double"))
    g = totals.groupBy(*keys).agg(
        F.collect_list(real).alias("_vals"), F.sum(real).alias("_sum"), F.min(real).alias("_least"), F.max(real).alias("_most"),
        F.max(F.when(F.col(run).isNull(), F.col("value").cast("double"))).alias("_expected"),
        F.count_if(F.col(run).between(1, n_runs)).alias("_runs"))
    right = ((F.col("_runs") == n_runs) & (F.size("_vals") == n_runs)
             & (F.col("_least") == F.col("_expected")) & (F.col("_most") == F.col("_expected")))
    what = F.concat(F.lit("runs do not hold the baseline's rows: "), F.to_json(F.struct(
        *by, F.col("_runs").alias("runs"), F.col("_least").alias("least"), F.col("_most").alias("most"),
        F.col("_expected").alias("expected"))))
    shown = (F.when(is_rows & ~F.coalesce(right, F.lit(False)), F.raise_error(what).cast("boolean"))
             .otherwise(~is_rows))
    return _summarised(g.where(shown), keys, n_runs)


# ------------------------------------------------------- runs that arrive in batches
def run_state(per_run: DataFrame, cells: Sequence[str], run: str = "model_run", value: str = "value") -> DataFrame:
    """A5/A6 as a state that can be merged: per cell the runs seen so far with their values,
    in run order (``runs``: array of run and value, at most one entry per run)."""
    pair = F.struct(F.col(run).cast("long").alias("run"), F.col(value).cast("double").alias("value"))
    return _unique_runs(per_run.groupBy(*cells).agg(F.collect_list(pair).alias("runs")), list(cells))


def _unique_runs(g: DataFrame, cells: list[str]) -> DataFrame:
    ids = F.transform("runs", lambda r: r["run"])
    twice = F.size(F.array_distinct(ids)) < F.size(ids)
    return g.select(*cells, F.when(twice, F.raise_error(F.lit("a run is in the state already")))
                    .otherwise(F.array_sort("runs")).alias("runs"))


def merge_states(states: Sequence[DataFrame], cells: Sequence[str]) -> DataFrame:
    """One state of several over different runs; a run in two of them raises.  Only
    states are read, so a new batch costs its own runs and one row per cell."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    return _unique_runs(both.groupBy(*cells).agg(F.flatten(F.collect_list("runs")).alias("runs")), list(cells))


def summarise_state(state: DataFrame, cells: Sequence[str], n_runs: int = N_RUNS,
                    all_runs_kept: bool = False) -> DataFrame:
    """``run_summary`` of the runs in a state; values are added in run order."""
    values = F.transform("runs", lambda r: r["value"])
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0)))
    g = state.select(*cells, F.filter(values, lambda v: v.isNotNull()).alias("_vals"), total.alias("_sum"))
    return _summarised(g, list(cells), n_runs, all_runs_kept)


def collect_runs(results: DataFrame, include_baseline: bool = True, run: str = "model_run",
                 value: str = "value") -> DataFrame:
    """Run 0 -> ``baseline``; other runs -> ``model_runs`` list (in run order) and
    their ``mean``.  Cells seen on one side only are kept (D22: null keys kept).

    With ``include_baseline=False`` every run, 0 included, goes into the list.
    """
    cells = [c for c in results.columns if c not in (run, value)]
    in_list = (F.col(run) != 0) if include_baseline else F.lit(True)
    pairs = F.array_sort(F.collect_list(F.when(in_list, F.struct(F.col(run).alias("r"),
                                                                 F.col(value).alias("v")))))
    aggs = []
    if include_baseline:
        aggs.append(F.max(F.when(F.col(run) == 0, F.col(value))).alias("baseline"))
    aggs += [pairs.alias("_pairs"), F.avg(F.when(in_list, F.col(value))).alias("mean")]
    g = results.groupBy(*cells).agg(*aggs)
    runs = F.transform(F.col("_pairs"), lambda s: s["v"])
    g = g.withColumn("model_runs", F.when(F.size("_pairs") > 0, runs))
    keep = cells + (["baseline"] if include_baseline else []) + ["model_runs", "mean"]
    return g.select(*keep)


def _run_count(per_run: DataFrame, run: str) -> Column:
    return per_run.where(F.col(run).isNotNull()).agg(F.countDistinct(run)).scalar()


def fill_missing_groups(per_run: DataFrame, cells: Sequence[str], value_cols: Sequence[str],
                        run: str = "model_run") -> DataFrame:
    """A10: add zero rows for every (run, cell) pair absent from ``per_run``.

    The run list (bounded by the run count) is a scalar subquery; each cell
    explodes the runs it lacks.  No cross join, no driver collect; null keys match
    null keys (D2) because grouping is null-safe.
    """
    cells = list(cells)
    all_runs = per_run.where(F.col(run).isNotNull()).agg(
        F.array_sort(F.collect_set(run))).scalar()
    have = per_run.groupBy(*cells).agg(F.collect_set(run).alias("_have"))
    missing = have.select(*cells, F.explode(F.array_except(all_runs, F.col("_have"))).alias(run))
    extra = [c for c in per_run.columns if c not in cells + [run] + list(value_cols)]
    if extra:
        raise ValueError(f"per_run may only hold run, cell and value columns; extra: {extra}")
    types = dict(per_run.dtypes)
    missing = missing.select(*[
        F.lit(0).cast(types[c]).alias(c) if c in value_cols else F.col(c) for c in per_run.columns
    ])
    return per_run.unionByName(missing)


def normal_ci(per_run: DataFrame, cells: Sequence[str], value_cols: Sequence[str],
              run: str = "model_run", z: float = Z_90, n_runs: int | None = None) -> DataFrame:
    """A11 over zero-filled runs, without materialising the zeros.

    For each value: mean, sample sd, count and ``mean -/+ z*sd/sqrt(n)`` (lower
    floored at 0, D18) where n is the number of runs.  The (n - k) missing runs are
    zeros; their effect is added with the pairwise variance-combination rule on
    top of Spark's stable per-cell moments, so the result equals the statistics
    of the explicitly gap-filled table (A10) without building it.
    """
    cells = list(cells)
    n = F.lit(float(n_runs)) if n_runs else _run_count(per_run, run).cast("double")
    aggs = []
    for v in value_cols:
        # a null value (a run whose sum is null) counts as a missing run: as a zero
        aggs += [F.count(v).alias(f"_k_{v}"), F.sum(F.col(v).cast("double")).alias(f"_s_{v}"), F.avg(v).alias(f"_m_{v}"),
                 F.var_pop(v).alias(f"_vp_{v}")]
    g = per_run.where(F.col(run).isNotNull()).groupBy(*cells).agg(*aggs).withColumn("_n", n)
    nn = F.col("_n")
    zero = F.lit(0.0)
    out = []
    for v in value_cols:
        k = F.col(f"_k_{v}").cast("double")
        m_a = F.coalesce(F.col(f"_m_{v}"), zero)
        m2 = F.coalesce(F.col(f"_vp_{v}"), zero) * k + m_a * m_a * k * (nn - k) / nn
        mean = F.coalesce(F.col(f"_s_{v}"), zero) / nn
        sd = F.when(nn > 1, F.sqrt(F.greatest(m2, F.lit(0.0)) / (nn - 1)))
        half = F.lit(z) * (sd / F.sqrt(nn))
        out += [mean.alias(f"mean_{v}"), sd.alias(f"std_{v}"), nn.cast("long").alias(f"n_{v}"),
                F.greatest(F.lit(0.0), mean - half).alias(f"{v}_lower_ci"),
                (mean + half).alias(f"{v}_upper_ci")]
    return g.select(*cells, *out)
