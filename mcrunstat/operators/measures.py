"""Per-run cell totals for the three activity types (joins, measures, unpivot).

Every function is DataFrame -> DataFrame and lazy.  A "cell" is a tuple of key
columns plus ``measure``; values are long sums per ``model_run``.  Passing
``run=None`` aggregates a table that has no runs (a baseline).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bands import los_detailed
from ..functions.predicates import (
    POD_OP_PROCEDURE,
    POD_SDEC,
    UNKNOWN,
    aae_measure,
    ip_pod,
    is_op_procedure,
    op_pod,
)
from ..schema import (
    AAE_BASELINE_COLUMNS,
    AAE_RUN_COLUMNS,
    IP_BASELINE_COLUMNS,
    IP_RUN_COLUMNS,
    OP_BASELINE_COLUMNS,
    OP_RUN_COLUMNS,
    require_columns,
)

IP_MEASURES = ("admissions", "beddays", "procedures")
OP_MEASURES = ("attendances", "tele_attendances")


#: What identifies a baseline row; ``rn`` alone repeats across datasets and years.
ROW_KEYS = ("dataset", "fyear", "rn")


def row_keys(left: DataFrame, right: DataFrame) -> list[str]:
    """The row keys that both tables carry; one-dataset, one-year tables may have only ``rn``."""
    return [c for c in ROW_KEYS if c in left.columns and c in right.columns]


def run_columns(runs: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns of a run table to join: its values and whichever row keys it carries."""
    return [*[c for c in ROW_KEYS if c in runs.columns], *[c for c in columns if c not in ROW_KEYS]]


def duplicate_rows(baseline: DataFrame) -> DataFrame:
    """Row keys that occur more than once in a baseline, which would multiply every join."""
    keys = row_keys(baseline, baseline)
    return baseline.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def _keys(run: str | None, cells: Sequence[str]) -> list[str]:
    return ([run] if run else []) + list(cells)


def filter_sites(df: DataFrame, sites: Sequence[str] = ("ALL",), col: str = "sitetret") -> DataFrame:
    """keep the listed sites; a list containing ``ALL`` keeps everything."""
    if "ALL" in sites:
        return df
    return df.where(F.col(col).isin(list(sites)))


def compile_sites(ip: str = "ALL", op: str = "ALL", aae: str = "ALL") -> dict[str, list[str]]:
    """comma-separated, case-insensitive site lists per activity."""
    return {k: v.upper().split(",") for k, v in (("ip", ip), ("op", op), ("aae", aae))}


def fill_unknown(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """null strings become ``unknown`` (all string columns unless named)."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill(UNKNOWN, subset=list(columns)) if columns else df


def with_age_groups(df: DataFrame, age_groups: Callable[[Column], Column] | None) -> DataFrame:
    """Config hook: derive ``age_group`` from ``age`` (hrg layout)."""
    if age_groups is None:
        return df
    return df.withColumn("age_group", age_groups(F.col("age")))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells with a null key are not reported (pandas groupby default)."""
    return df.dropna(subset=list(keys)) if keys else df


def add_op_pod(df: DataFrame) -> DataFrame:
    """F7 as a table operator."""
    return df.withColumn("pod", op_pod())


# --------------------------------------------------------------------------- ip
def ip_measures(df: DataFrame, los_band: Callable[[Column], Column] = los_detailed) -> DataFrame:
    """F2 + F3 + F4: day-case pod, length-of-stay band and the three measures."""
    return df.withColumns({
        "pod": ip_pod(),
        "los_group": los_band(F.col("speldur")),
        "admissions": F.lit(1),
        "beddays": F.col("speldur") + 1,
        "procedures": F.col("has_procedure").cast("int"),
    })


def ip_run_rows(baseline: DataFrame, runs: DataFrame,
                los_band: Callable[[Column], Column] = los_detailed) -> DataFrame:
    """F14 + J1: baseline attributes joined to every run row on the row keys both carry.

    The run's own ``speldur``/``classpat`` win over the baseline's.  One join for all
    runs: both sides are hash-partitioned on the keys (AQE splits skewed ones).
    """
    require_columns(baseline, [c for c in IP_BASELINE_COLUMNS], "ip baseline")
    require_columns(runs, IP_RUN_COLUMNS, "ip runs")
    joined = baseline.drop("speldur", "classpat").join(
        runs.select(*run_columns(runs, IP_RUN_COLUMNS)), row_keys(baseline, runs), "inner")
    return ip_measures(joined, los_band)


def ip_cell_values(rows: DataFrame, cells: Sequence[str], run: str | None = "model_run",
                   positive_only: bool = True, keep_null_keys: bool = False) -> DataFrame:
    """A1 + F10 + A2 + F11: (run, cell, measure) -> value.

    Outpatient-procedure rows inside ip report only ``attendances`` (their
    admissions); bed days and procedures are zero for them and are left out, which
    is the same as zeroing then re-summing under one label.
    """
    keys = _keys(run, cells)
    if not keep_null_keys:
        rows = drop_null_keys(rows, cells)
    totals = rows.groupBy(*keys).agg(*[F.sum(m).cast("long").alias(m) for m in IP_MEASURES])
    long = totals.unpivot(keys, list(IP_MEASURES), "measure", "value")
    opp = is_op_procedure()
    long = (long.where(~opp | (F.col("measure") == "admissions"))
            .withColumn("measure", F.when(opp, F.lit("attendances")).otherwise(F.col("measure"))))
    if positive_only:
        long = long.where(F.col("value") > 0)
    return long.select(*keys, "measure", "value")


# --------------------------------------------------------------------------- op
def op_baseline_prepared(baseline: DataFrame, age_groups=None) -> DataFrame:
    """Age cut first, then null strings -> ``unknown``."""
    require_columns(baseline, OP_BASELINE_COLUMNS, "op baseline")
    return fill_unknown(with_age_groups(baseline, age_groups))


def _every_run(baseline: DataFrame, runs: DataFrame) -> DataFrame:
    """J1 where every run holds the whole baseline: the runs are many times the baseline's rows,
    whatever their size is estimated at, so neither side is gathered and sent to every task."""
    return baseline.join(runs.hint("merge"), row_keys(baseline, runs), "inner")


def op_run_rows(baseline: DataFrame, runs: DataFrame) -> DataFrame:
    """F14 + J1 for outpatients (run counts replace baseline counts)."""
    require_columns(runs, OP_RUN_COLUMNS, "op runs")
    return _every_run(baseline.drop(*OP_MEASURES), runs.select(*run_columns(runs, OP_RUN_COLUMNS)))


def op_conversion_rows(conv: DataFrame, cells: Sequence[str], age_groups=None,
                       run: str | None = "model_run") -> DataFrame:
    """A7 + F13: ip activity converted to outpatient procedures (attendances only)."""
    conv = with_age_groups(conv.withColumn("pod", F.lit(POD_OP_PROCEDURE)), age_groups)
    conv = drop_null_keys(conv, cells)
    return conv.select(*_keys(run, cells), F.col("attendances").cast("long").alias("attendances"),
                       F.lit(None).cast("long").alias("tele_attendances"))


def op_cell_values(rows: DataFrame, cells: Sequence[str], run: str | None = "model_run",
                   conversions: DataFrame | None = None) -> DataFrame:
    """A3 (+ J5): attendances and tele-attendances per cell, plus conversions.

    Conversion rows are appended before the single aggregation, so the outer add
    of the two sources costs no extra shuffle.  A sum over nulls only is 0; cells seen
    only in conversions carry no tele-attendance row.
    """
    keys = _keys(run, cells)
    rows = drop_null_keys(rows, cells).select(
        *keys, *[F.coalesce(F.col(m), F.lit(0)).cast("long").alias(m) for m in OP_MEASURES])
    if conversions is not None:
        rows = rows.unionByName(conversions.select(
            *keys, F.coalesce("attendances", F.lit(0)).cast("long").alias("attendances"), "tele_attendances"))
    totals = rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in OP_MEASURES])
    long = totals.unpivot(keys, list(OP_MEASURES), "measure", "value")
    return long.where(F.col("value").isNotNull())


# -------------------------------------------------------------------------- aae
def aae_baseline_prepared(baseline: DataFrame, age_groups=None) -> DataFrame:
    require_columns(baseline, AAE_BASELINE_COLUMNS, "aae baseline")
    return fill_unknown(with_age_groups(baseline, age_groups))


def aae_run_rows(baseline: DataFrame, runs: DataFrame) -> DataFrame:
    require_columns(runs, AAE_RUN_COLUMNS, "aae runs")
    return _every_run(baseline.drop("arrivals"), runs.select(*run_columns(runs, AAE_RUN_COLUMNS)))


def aae_conversion_rows(conv: DataFrame, cells: Sequence[str], age_groups=None,
                        run: str | None = "model_run", group: str = "grp") -> DataFrame:
    """A7 + F13: same-day emergency care converted from ip; its group is the measure."""
    conv = with_age_groups(conv.withColumn("pod", F.lit(POD_SDEC)), age_groups)
    conv = conv.withColumn("measure", F.col(group))
    conv = drop_null_keys(conv, list(cells) + ["measure"])
    return conv.select(*_keys(run, cells), "measure", F.col("arrivals").cast("long").alias("arrivals"))


def aae_cell_values(rows: DataFrame, cells: Sequence[str], run: str | None = "model_run",
                    conversions: DataFrame | None = None) -> DataFrame:
    """A4 + F8 (+ J5): arrivals per cell and arrival mode."""
    keys = _keys(run, cells)
    rows = drop_null_keys(rows.withColumn("measure", aae_measure()), cells).select(
        *keys, "measure", F.col("arrivals").cast("long").alias("arrivals"))
    if conversions is not None:
        rows = rows.unionByName(conversions.select(*keys, "measure", "arrivals"))
    return rows.groupBy(*keys, "measure").agg(F.sum("arrivals").alias("value"))


def matched_rows(baseline: DataFrame, runs: DataFrame, columns: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """J1 for checked products: every run row, those without a baseline row with null attributes."""
    runs = runs.select(*run_columns(runs, columns))
    keys = row_keys(baseline, runs)
    known = baseline.drop(*measures).withColumn("_known", F.lit(True))
    # the run's own dataset or year says nothing if the baseline lacks the row
    rows = runs.join(known, keys, "left")
    return rows.withColumns({c: F.when(F.col("_known"), F.col(c)) for c in keys}).drop("_known")


def op_cell_values_counted(rows: DataFrame, cells: Sequence[str], rows_measure: str, run: str = "model_run",
                           conversions: DataFrame | None = None) -> DataFrame:
    """A3 (+ J5) with the number of rows of every (run, cell) as one more measure, from the
    same aggregation; null keys stay."""
    keys = _keys(run, cells)
    rows = rows.select(*keys, *[F.coalesce(F.col(m), F.lit(0)).cast("long").alias(m) for m in OP_MEASURES],
                       F.lit(1).cast("long").alias(rows_measure))
    if conversions is not None:
        rows = rows.unionByName(conversions.select(
            *keys, F.coalesce("attendances", F.lit(0)).cast("long").alias("attendances"), "tele_attendances",
            F.lit(0).cast("long").alias(rows_measure)))
    names = [*OP_MEASURES, rows_measure]
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in names]).unpivot(keys, names, "measure", "value")


def aae_cell_values_counted(rows: DataFrame, cells: Sequence[str], rows_measure: str, run: str = "model_run",
                            conversions: DataFrame | None = None) -> DataFrame:
    """A4 + F8 (+ J5) with the number of rows as one more measure, as in ``op_cell_values_counted``."""
    keys = _keys(run, cells)
    rows = rows.select(*keys, aae_measure().alias("measure"), F.col("arrivals").cast("long").alias("arrivals"),
                       F.lit(1).cast("long").alias("_n"))
    if conversions is not None:
        rows = rows.unionByName(conversions.select(*keys, "measure", "arrivals", F.lit(0).cast("long").alias("_n")))
    totals = rows.groupBy(*keys, "measure").agg(F.sum("arrivals").alias("value"), F.sum("_n").alias("_n"))
    return totals.select(*keys, F.inline(F.array(
        F.struct("measure", "value"), F.struct(F.lit(rows_measure).alias("measure"), F.col("_n").alias("value")))))


def run_row_counts(baseline: DataFrame, runs: DataFrame, run: str = "model_run",
                   n_runs: int | None = None) -> DataFrame:
    """Every run must have exactly the baseline's row count (report, not raise).

    With ``n_runs`` the runs 1..n_runs are expected: one without any row is reported
    with 0 rows, not left out.
    """
    base = baseline.agg(F.count(F.lit(1)).alias("baseline_rows"))
    per_run = runs.groupBy(run).agg(F.count(F.lit(1)).alias("run_rows"))
    if n_runs is not None:
        expected = runs.sparkSession.range(1, n_runs + 1).select(F.col("id").cast(runs.schema[run].dataType).alias(run))
        per_run = per_run.join(expected, run, "full").na.fill(0, subset=["run_rows"])
    return (per_run.withColumn("baseline_rows", base.scalar())
            .withColumn("ok", F.col("run_rows") == F.col("baseline_rows")))
