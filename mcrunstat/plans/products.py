"""Products: end-to-end compositions of the operators.

Each returns one lazy DataFrame (``national_filled`` writes its reduced input once).  Hospital-specific names live here and in
``schema.AggConfig``; the operators only take column names and parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bands import los_avoided, los_custom, los_detailed, los_national, age_custom
from ..functions.predicates import aae_measure, ip_pod_from_class, op_pod
from ..operators import measures as M
from ..operators.combine import attach_baseline
from ..operators.montecarlo import N_RUNS, ROWS, checked_summary, fill_missing_groups, normal_ci, run_summary
from ..operators.suppress import suppress_small_counts
from ..schema import AAE_RUN_COLUMNS, IP_RUN_COLUMNS, OP_RUN_COLUMNS, HRG, STANDARD, AggConfig, require_columns
from ..session import materialize
from ..sources.catalog import run_completeness


#: What a product is made for; kept apart wherever a table carries them.
BY = ("dataset", "fyear")


def by_columns(baseline: DataFrame, by: Sequence[str] | None = None) -> list[str]:
    """The keys that go before the cells: by default those of ``BY`` in the baseline, so
    many datasets and years go through one job and never mix."""
    return [c for c in BY if c in baseline.columns] if by is None else list(by)


# ------------------------------------------------------------------ P1-P3
def ip_per_run(baseline: DataFrame, runs: DataFrame, config: AggConfig = STANDARD,
               keep_null_keys: bool = False, by: Sequence[str] | None = None) -> DataFrame:
    base = M.with_age_groups(baseline, config.age_groups)
    rows = M.ip_run_rows(base, runs, los_detailed)
    return M.ip_cell_values(rows, by_columns(baseline, by) + list(config.ip_cols), "model_run",
                            positive_only=True, keep_null_keys=keep_null_keys)


def detailed_ip(baseline: DataFrame, runs: DataFrame, config: AggConfig = STANDARD,
                n_runs: int = N_RUNS, keep_null_keys: bool = False,
                by: Sequence[str] | None = None) -> DataFrame:
    """Inpatient cells summarised over all runs (one plan, all runs at once)."""
    per_run = ip_per_run(baseline, runs, config, keep_null_keys, by)
    return run_summary(per_run, by_columns(baseline, by) + list(config.ip_cols) + ["measure"], n_runs)


def op_per_run(baseline: DataFrame, runs: DataFrame, conversions: DataFrame | None,
               config: AggConfig = STANDARD, by: Sequence[str] | None = None) -> DataFrame:
    cells = by_columns(baseline, by) + list(config.op_cols)
    base = M.op_baseline_prepared(baseline, config.age_groups)
    rows = M.op_run_rows(base, runs)
    conv = None if conversions is None else M.op_conversion_rows(conversions, cells, config.age_groups)
    return M.op_cell_values(rows, cells, "model_run", conv)


def detailed_op(baseline: DataFrame, runs: DataFrame, conversions: DataFrame | None,
                config: AggConfig = STANDARD, n_runs: int = N_RUNS,
                by: Sequence[str] | None = None) -> DataFrame:
    """Outpatient cells incl. ip->op conversions, summarised over runs."""
    per_run = op_per_run(baseline, runs, conversions, config, by)
    return run_summary(per_run, by_columns(baseline, by) + list(config.op_cols) + ["measure"], n_runs)


def aae_per_run(baseline: DataFrame, runs: DataFrame, conversions: DataFrame | None,
                config: AggConfig = STANDARD, by: Sequence[str] | None = None) -> DataFrame:
    cells = by_columns(baseline, by) + list(config.aae_cols)
    base = M.aae_baseline_prepared(baseline, config.age_groups)
    rows = M.aae_run_rows(base, runs)
    conv = None if conversions is None else M.aae_conversion_rows(conversions, cells, config.age_groups)
    return M.aae_cell_values(rows, cells, "model_run", conv)


def detailed_aae(baseline: DataFrame, runs: DataFrame, conversions: DataFrame | None,
                 config: AggConfig = STANDARD, n_runs: int = N_RUNS,
                 by: Sequence[str] | None = None) -> DataFrame:
    """A&E cells incl. same-day-care conversions, summarised over runs."""
    per_run = aae_per_run(baseline, runs, conversions, config, by)
    return run_summary(per_run, by_columns(baseline, by) + list(config.aae_cols) + ["measure"], n_runs)


def _expected_rows(baseline: DataFrame, by: Sequence[str]) -> DataFrame:
    return baseline.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def detailed_op_checked(baseline: DataFrame, runs: DataFrame, conversions: DataFrame | None,
                        config: AggConfig = STANDARD, n_runs: int = N_RUNS, by: Sequence[str] | None = None) -> DataFrame:
    """P2 with C6 inside: raises if a run does not hold the rows of the baseline; the runs are
    read once."""
    require_columns(runs, OP_RUN_COLUMNS, "op runs")
    by = by_columns(baseline, by)
    cells = by + list(config.op_cols)
    base = M.op_baseline_prepared(baseline, config.age_groups)
    rows = M.matched_rows(base, runs, OP_RUN_COLUMNS, M.OP_MEASURES)
    conv = None if conversions is None else M.op_conversion_rows(conversions, cells, config.age_groups)
    per_run = M.op_cell_values_counted(rows, cells, ROWS, conversions=conv)
    return checked_summary(per_run, _expected_rows(base, by), cells, by, n_runs)


def detailed_aae_checked(baseline: DataFrame, runs: DataFrame, conversions: DataFrame | None,
                         config: AggConfig = STANDARD, n_runs: int = N_RUNS, by: Sequence[str] | None = None) -> DataFrame:
    """P3 with C6 inside, as ``detailed_op_checked``."""
    require_columns(runs, AAE_RUN_COLUMNS, "aae runs")
    by = by_columns(baseline, by)
    cells = by + list(config.aae_cols)
    base = M.aae_baseline_prepared(baseline, config.age_groups)
    rows = M.matched_rows(base, runs, AAE_RUN_COLUMNS, ("arrivals",))
    conv = None if conversions is None else M.aae_conversion_rows(conversions, cells, config.age_groups)
    per_run = M.aae_cell_values_counted(rows, cells, ROWS, conversions=conv)
    return checked_summary(per_run, _expected_rows(base, by), cells, by, n_runs)


# ------------------------------------------------------------------ P5
def ip_baseline_cells(baseline: DataFrame, config: AggConfig = HRG, by: Sequence[str] | None = None) -> DataFrame:
    base = M.ip_measures(M.with_age_groups(baseline, config.age_groups), los_detailed)
    return M.ip_cell_values(base, by_columns(baseline, by) + list(config.ip_cols), run=None, positive_only=True)


def op_baseline_cells(baseline: DataFrame, config: AggConfig = HRG, by: Sequence[str] | None = None) -> DataFrame:
    """The baseline gets the same ``unknown`` fill as the run results."""
    base = M.op_baseline_prepared(baseline, config.age_groups)
    return M.op_cell_values(base, by_columns(baseline, by) + list(config.op_cols), run=None)


def aae_baseline_cells(baseline: DataFrame, config: AggConfig = HRG, by: Sequence[str] | None = None) -> DataFrame:
    base = M.aae_baseline_prepared(baseline, config.age_groups)
    return M.aae_cell_values(base, by_columns(baseline, by) + list(config.aae_cols), run=None)


def attach_baseline_ip(baseline, runs, config: AggConfig = HRG, n_runs: int = N_RUNS,
                       by: Sequence[str] | None = None) -> DataFrame:
    res = detailed_ip(baseline, runs, config, n_runs, by=by)
    return attach_baseline(res, ip_baseline_cells(baseline, config, by),
                           by_columns(baseline, by) + list(config.ip_cols) + ["measure"])


def attach_baseline_op(baseline, runs, conversions, config: AggConfig = HRG,
                       n_runs: int = N_RUNS, by: Sequence[str] | None = None) -> DataFrame:
    res = detailed_op(baseline, runs, conversions, config, n_runs, by)
    return attach_baseline(res, op_baseline_cells(baseline, config, by),
                           by_columns(baseline, by) + list(config.op_cols) + ["measure"])


def attach_baseline_aae(baseline, runs, conversions, config: AggConfig = HRG,
                        n_runs: int = N_RUNS, by: Sequence[str] | None = None) -> DataFrame:
    res = detailed_aae(baseline, runs, conversions, config, n_runs, by)
    return attach_baseline(res, aae_baseline_cells(baseline, config, by),
                           by_columns(baseline, by) + list(config.aae_cols) + ["measure"])


# ------------------------------------------------------------------ P6
# The keys of the custom, avoided and national layouts.
CUSTOM_IP_KEYS = ("sitetret", "custom_age_groups", "custom_los_groups", "tretspef", "pod",
                  "maternity_delivery_in_spell")
CUSTOM_OP_KEYS = ("sitetret", "custom_age_groups", "tretspef", "pod")
CUSTOM_AAE_KEYS = ("sitetret", "pod", "custom_age_groups", "aedepttype", "acuity")


def custom_baseline_ip(baseline: DataFrame, by: Sequence[str] | None = None,
                       sites: Sequence[str] = ("ALL",)) -> DataFrame:
    """A20 + A21 ip: custom bands, positive cells per dataset and year, suppressed by (pod, measure)."""
    by = by_columns(baseline, by)
    df = M.filter_sites(baseline, sites)
    df = M.ip_measures(df.withColumn("custom_age_groups", age_custom("age")), los_custom)
    df = df.withColumnRenamed("los_group", "custom_los_groups")
    keys = by + list(CUSTOM_IP_KEYS)
    df = M.drop_null_keys(df, keys)
    totals = df.groupBy(*keys).agg(*[F.sum(m).cast("long").alias(m) for m in M.IP_MEASURES])
    cells = totals.unpivot(keys, list(M.IP_MEASURES), "measure", "value").where(F.col("value") > 0)
    return suppress_small_counts(cells, keys + ["measure"], by + ["pod", "measure"])


def custom_baseline_op(baseline: DataFrame, by: Sequence[str] | None = None,
                       sites: Sequence[str] = ("ALL",)) -> DataFrame:
    """A20 + A21 op: per dataset and, where the table has it, year; suppressed by pod."""
    by = by_columns(baseline, by)
    df = M.filter_sites(baseline, sites).withColumns(
        {"pod": op_pod(), "custom_age_groups": age_custom("age")})
    keys = by + list(CUSTOM_OP_KEYS)
    cells = M.op_cell_values(df, keys, run=None)
    return suppress_small_counts(cells, keys + ["measure"], by + ["pod"])


def custom_baseline_aae(baseline: DataFrame, by: Sequence[str] | None = None,
                        sites: Sequence[str] = ("ALL",)) -> DataFrame:
    """A20 + A21 aae, per dataset and, where the table has it, year: null acuity cells drop out
    (no ``unknown`` fill here)."""
    by = by_columns(baseline, by)
    df = M.filter_sites(baseline, sites).withColumns(
        {"measure": aae_measure(), "custom_age_groups": age_custom("age")})
    keys = by + list(CUSTOM_AAE_KEYS)
    df = M.drop_null_keys(df, keys + ["measure"])
    cells = df.groupBy(*keys, "measure").agg(F.sum("arrivals").cast("long").alias("value"))
    return suppress_small_counts(cells, keys + ["measure"], by + ["pod"])


# ------------------------------------------------------------------ P7
AVOIDED_CELLS = ("pod", "los_group", "sushrg")


def activity_avoided(baseline: DataFrame, avoided: DataFrame, n_runs: int = N_RUNS,
                     by: Sequence[str] | None = None) -> DataFrame:
    """Avoided ip activity by HRG; zero cells stay (no positive filter)."""
    cells = by_columns(baseline, by) + list(AVOIDED_CELLS)
    rows = M.ip_run_rows(baseline, avoided, los_avoided)
    per_run = M.ip_cell_values(rows, cells, "model_run", positive_only=False)
    return run_summary(per_run, cells + ["measure"], n_runs)


# ------------------------------------------------------------------ P8
NATIONAL = "NATIONAL"
NATIONAL_CELLS = ("los_group", "pod", "sushrg")


def hash_sample(df: DataFrame, fraction: float, seed: int, key: str = "rn") -> DataFrame:
    """Deterministic sample by a hash of (seed, key): the same rows whatever
    the partitioning, on any engine.  The hash is compared at 60 bits, so any fraction
    in (0, 1] keeps its share; others raise."""
    if not 0 < fraction <= 1:
        raise ValueError(f"fraction {fraction} is not in (0, 1]")
    if fraction == 1:
        return df
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 15), 16, 10)
    return df.where(h.cast("long") < int(fraction * 2**60))


def national_sample(baseline: DataFrame, fraction: float = 1.0, seed: int = 0,
                    fyear: int | None = None) -> DataFrame:
    """F16 + F13 (+ F17): one year, every dataset relabelled ``NATIONAL``; the whole table
    unless a smaller fraction is asked for.  The row's own dataset stays as ``source_dataset``,
    because ``rn`` alone repeats between datasets."""
    df = baseline if fyear is None else baseline.where(F.col("fyear") == fyear)
    if "dataset" in df.columns:
        df = df.withColumn("source_dataset", F.col("dataset"))
    df = df.withColumns({"dataset": F.lit(NATIONAL), "sitetret": F.lit(NATIONAL)})
    return hash_sample(df, fraction, seed)


def _source_rows(sample: DataFrame) -> DataFrame:
    """The rows of a national sample under the keys that runs know them by."""
    if "source_dataset" not in sample.columns:
        return sample.drop("dataset")
    return sample.withColumn("dataset", F.col("source_dataset")).drop("source_dataset")


def national_baseline(sample: DataFrame) -> DataFrame:
    """F5 + A9: bed days and admissions per national cell (null keys kept)."""
    df = sample.withColumns({"los_group": los_national("speldur"), "beddays": F.col("speldur") + 1})
    return df.groupBy(*NATIONAL_CELLS).agg(F.sum("beddays").cast("long").alias("beddays"),
                                           F.count(F.lit(1)).alias("admissions"))


def national_per_run(sample: DataFrame, runs: DataFrame) -> DataFrame:
    """J2 + A9: baseline left-joined to runs; rows without a run are dropped (D3)."""
    apc = _source_rows(sample).drop("speldur", "classpat")
    runs = runs.select(*M.run_columns(runs, IP_RUN_COLUMNS))
    j = apc.join(runs, M.row_keys(apc, runs), "left")
    j = j.where(F.col("model_run").isNotNull())
    j = j.withColumns({"los_group": los_national("speldur"), "beddays": F.col("speldur") + 1})
    return j.groupBy("model_run", *NATIONAL_CELLS).agg(
        F.sum("beddays").cast("long").alias("beddays"), F.count(F.lit(1)).alias("admissions"))


def national_avoided_per_run(sample: DataFrame, avoided: DataFrame) -> DataFrame:
    """J3 + F9 + A9: avoided rows left-joined to the baseline; pod re-derived."""
    apc = _source_rows(sample).drop("speldur", "classpat", "pod")
    avoided = avoided.select(*M.run_columns(avoided, IP_RUN_COLUMNS))
    j = avoided.join(apc, M.row_keys(avoided, apc), "left")
    j = j.withColumns({"los_group": los_national("speldur"), "beddays": F.col("speldur") + 1,
                       "pod": ip_pod_from_class()})
    return j.groupBy("model_run", *NATIONAL_CELLS).agg(
        F.sum("beddays").cast("long").alias("beddays"), F.count(F.lit(1)).alias("admissions"))


def _national_stats(per_run: DataFrame, n_runs: int) -> DataFrame:
    out = normal_ci(per_run, list(NATIONAL_CELLS), ["beddays", "admissions"], n_runs=n_runs)
    return out.drop("n_beddays", "n_admissions")


def national_results(sample: DataFrame, runs: DataFrame, n_runs: int = N_RUNS) -> DataFrame:
    """P8 results: A10 + A11 with the zero runs folded in analytically.

    The number of runs is known, so the per-run table has one consumer and the product
    is one lazy plan.
    """
    return _national_stats(national_per_run(sample, runs), n_runs)


def national_avoided(sample: DataFrame, avoided: DataFrame, n_runs: int = N_RUNS) -> DataFrame:
    return _national_stats(national_avoided_per_run(sample, avoided), n_runs)


def national_filled(sample: DataFrame, runs: DataFrame) -> DataFrame:
    """A10 materialised: every (run, national cell) pair, zeros where absent.  The reduced
    per-run table feeds two consumers, so it is written once when this is called."""
    return fill_missing_groups(materialize(national_per_run(sample, runs)), list(NATIONAL_CELLS),
                               ["beddays", "admissions"])


# ------------------------------------------------------------------ P12
def complete_datasets(listing: DataFrame, scenario: str, n_runs: int = N_RUNS) -> DataFrame:
    """Datasets of a scenario whose full results hold every run."""
    done = run_completeness(listing, n_runs=n_runs).where("all_runs_present")
    parts = F.split("prefix", "/")
    return done.where(F.get(parts, 3) == scenario).select(F.get(parts, 2).alias("dataset")).distinct()


def _stacked(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in parts.items():
        df = df.withColumn("activity", F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def pipeline_hrg_baseline(fx, listing: DataFrame, scenario: str,
                          n_runs_ip: int = N_RUNS, n_runs_other: int = 16) -> DataFrame:
    """P12, hrg branch: results with baseline for all three activities, stacked with an
    ``activity`` column, for the datasets of which all runs are there.

    The others leave by a semi-join on the baselines and conversions, below every other
    join, so nothing is computed for them and nothing is decided on the driver.  Five plans
    need the list of complete datasets, so it is written once when this is called.
    """
    done = materialize(complete_datasets(listing, scenario, n_runs_ip))

    def only(name: str) -> DataFrame:
        return fx[name].join(done, "dataset", "left_semi")

    return _stacked({
        "ip": attach_baseline_ip(only("ip_baseline"), fx["ip_runs"], HRG, n_runs_ip),
        "op": attach_baseline_op(M.add_op_pod(only("op_baseline")), fx["op_runs"], only("op_conversion"), HRG, n_runs_other),
        "aae": attach_baseline_aae(only("aae_baseline"), fx["aae_runs"], only("sdec_conversion"), HRG, n_runs_other),
    })


def custom_baselines(ip: DataFrame, op: DataFrame, aae: DataFrame, sites: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """P6 for all three activities, each with its own list of sites (F1)."""
    sites = sites or {}
    return _stacked({
        "ip": custom_baseline_ip(ip, sites=sites.get("ip", ("ALL",))),
        "op": custom_baseline_op(op, sites=sites.get("op", ("ALL",))),
        "aae": custom_baseline_aae(aae, sites=sites.get("aae", ("ALL",))),
    })


def pipeline_standard(fx, listing: DataFrame, scenario: str, n_runs_ip: int = N_RUNS,
                      sites: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """P12, standard branch: the custom baselines of the datasets with complete results, the list
    of which is written once when this is called."""
    done = materialize(complete_datasets(listing, scenario, n_runs_ip))
    tables = (fx[f"{a}_baseline"].join(done, "dataset", "left_semi") for a in ("ip", "op", "aae"))
    return custom_baselines(*tables, sites)
