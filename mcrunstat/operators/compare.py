"""Release and scenario comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INF = float("inf")


def pct_change(old: Column, new: Column, scale: float = 100.0, decimals: int | None = None) -> Column:
    """|new/old - 1| * scale with the source's edge cases, ANSI-safe (no raw x/0).

    Either side null -> 0; 0 -> 0 is 0; 0 -> non-zero is infinity.
    """
    ratio = new / old - 1
    if decimals is not None:
        ratio = F.bround(ratio, decimals)
    return (F.when(old.isNull() | new.isNull(), F.lit(0.0))
            .when(old == 0, F.when(new == 0, F.lit(0.0)).otherwise(F.lit(INF)))
            .otherwise(F.abs(ratio) * scale))


def _status(left_present: Column, right_present: Column) -> Column:
    return (F.when(left_present & right_present, F.lit("both"))
            .when(left_present, F.lit("only_old")).otherwise(F.lit("only_new")))


def compare_results(old: DataFrame, new: DataFrame,
                    keys: Sequence[str] = ("dataset", "pod", "measure")) -> DataFrame:
    """C1 + J7 over two run-list tables (A6 output): summed baseline and mean per
    key, full outer, percent change of the means.  A vanished or new cell is 0 %
    (D16 adds ``status``)."""
    keys = list(keys)

    def side(df: DataFrame, sfx: str) -> DataFrame:
        return df.dropna(subset=keys).groupBy(*keys).agg(
            F.coalesce(F.sum("baseline"), F.lit(0)).cast("double").alias(f"baseline_{sfx}"),
            F.coalesce(F.sum("mean"), F.lit(0)).cast("double").alias(f"mean_{sfx}"),
            F.lit(True).alias(f"_in_{sfx}"))

    j = side(old, "old").join(side(new, "new"), keys, "full")
    return j.select(
        *keys, "baseline_old", "mean_old", "baseline_new", "mean_new",
        pct_change(F.col("mean_old"), F.col("mean_new")).alias("pct_diff"),
        _status(F.col("_in_old").isNotNull(), F.col("_in_new").isNotNull()).alias("status"))


def compare_stepcounts(old: DataFrame, new: DataFrame, keys: Sequence[str] = (
        "dataset", "activity_type", "pod", "change_factor", "strategy", "measure")) -> DataFrame:
    """A19 + C2: mean step count per key (no zero padding), full outer, gaps -> 0
    first, so a vanished cell is 100 % and a new one infinite."""
    keys = list(keys)

    def side(df: DataFrame, sfx: str) -> DataFrame:
        return df.dropna(subset=keys).groupBy(*keys).agg(
            F.avg("value").alias(f"mean_{sfx}"), F.lit(True).alias(f"_in_{sfx}"))

    j = side(old, "old").join(side(new, "new"), keys, "full")
    mo, mn = F.coalesce(F.col("mean_old"), F.lit(0.0)), F.coalesce(F.col("mean_new"), F.lit(0.0))
    return j.select(
        *keys, mo.alias("mean_old"), mn.alias("mean_new"),
        pct_change(mo, mn).alias("pct_diff"),
        _status(F.col("_in_old").isNotNull(), F.col("_in_new").isNotNull()).alias("status"))


def baseline_vs_mean(baseline: Column, mean: Column) -> Column:
    """|round(baseline/mean - 1, 4)|, numpy half-even rounding, null -> 0."""
    return pct_change(mean, baseline, scale=1.0, decimals=4)


METADATA_COLUMNS = ("scenario", "app_version", "create_datetime", "model_runs")


def compare_default(a: DataFrame, b: DataFrame, names: tuple[str, str],
                    keys: Sequence[str] = ("dataset", "pod", "sitetret", "measure")) -> DataFrame:
    """C3 + J8 + O3: per side baseline-vs-mean change (D1), inner join on the cell,
    non-key columns suffixed with the scenario name, columns sorted by name.

    ``dataset`` is a key, so one call compares every dataset of two releases.
    """
    keys = list(keys)

    def side(df: DataFrame, name: str) -> DataFrame:
        df = df.drop(*[c for c in METADATA_COLUMNS if c in df.columns])
        df = df.withColumn("pct_diff", baseline_vs_mean(F.col("baseline"), F.col("mean")))
        return df.select(*keys, *[F.col(c).alias(f"{c}_{name}") for c in df.columns if c not in keys])

    left, right = side(a, names[0]), side(b, names[1])
    # null keys are cells too (D22) and match null keys
    same = [left[c].eqNullSafe(right[c]) for c in keys]
    j = left.join(right, same, "inner").drop(*[right[c] for c in keys])
    return j.select(*sorted(j.columns))


def compare_default_rowwise(df: DataFrame, partition: Sequence[str] = ("dataset",),
                            order: Sequence[str] = ("pod", "sitetret", "measure")) -> DataFrame:
    """The source's row-over-row reading of the same change: each cell's baseline
    against the previous cell's (cells ordered by key within a dataset)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    prev = F.lag("baseline").over(w)
    return df.select(*partition, *order, "baseline",
                     pct_change(prev, F.col("baseline"), scale=1.0, decimals=4).alias("pct_diff"))


def release_check(dev: DataFrame, release: DataFrame, keys: Sequence[str],
                  value_cols: Sequence[str], names: tuple[str, str] = ("dev", "release"),
                  fill_zero: bool = True, prefix: bool = True) -> DataFrame:
    """J7 + C7: two versions' aggregates side by side, one equality flag per value
    and ``all_equal`` per row.  ``fill_zero`` makes one-sided keys count as 0."""
    keys = list(keys)

    def nm(v: str, n: str) -> str:
        return f"{n}_{v}" if prefix else f"{v}_{n}"

    left = dev.select(*keys, *[F.col(v).alias(nm(v, names[0])) for v in value_cols])
    right = release.select(*keys, *[F.col(v).alias(nm(v, names[1])) for v in value_cols])
    j = left.join(right, keys, "full")
    cols = []
    for v in value_cols:
        for n in names:
            c = F.col(nm(v, n))
            cols.append((F.coalesce(c, F.lit(0)) if fill_zero else c).alias(nm(v, n)))
    j = j.select(*keys, *cols)
    eq = [F.col(nm(v, names[0])).eqNullSafe(F.col(nm(v, names[1]))).alias(f"{v}_equal")
          for v in value_cols]
    j = j.select("*", *eq)
    all_eq = None
    for v in value_cols:
        all_eq = F.col(f"{v}_equal") if all_eq is None else all_eq & F.col(f"{v}_equal")
    return j.withColumn("all_equal", all_eq)


def release_verdict(checked: DataFrame) -> DataFrame:
    """Per value column, whether every row of a ``release_check`` agrees, and how many
    do not."""
    flags = [c for c in checked.columns if c.endswith("_equal")]
    one = checked.agg(*[F.bool_and(F.col(c)).alias(c) for c in flags],
                      *[F.count_if(~F.col(c)).alias(f"_n_{c}") for c in flags])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c.removesuffix("_equal")).alias("value"), F.col(c).alias("all_rows_equal"),
                 F.col(f"_n_{c}").alias("rows_differing")) for c in flags])))


def reconcile(detailed: DataFrame, default: DataFrame, measures: Sequence[str],
              rule: str = "trunc", tolerance: float = 1.0, value: str = "mean") -> DataFrame:
    """Totals of the detailed summaries against the aggregated results.

    rule ``trunc``: totals truncated to whole numbers (ip); ``round1``: each detailed
    cell rounded to 1 dp, then the total truncated (op); ``round0``: totals rounded
    half-even (aae); ``exact``: raw totals.  ``ok`` when |diff| <= tolerance; a
    mismatch is reported, not raised.
    """
    det_val = F.bround(F.col(value), 1) if rule == "round1" else F.col(value)
    det = detailed.where(F.col("measure").isin(list(measures))).groupBy("measure").agg(
        F.sum(det_val).alias("detailed"))
    dft = default.where(F.col("measure").isin(list(measures))).groupBy("measure").agg(
        F.sum(F.col(value)).alias("default"))
    j = dft.join(det, "measure", "full").na.fill(0.0, subset=["default", "detailed"])

    def fix(c: Column) -> Column:
        if rule in ("trunc", "round1"):
            # sums of rounded cells end in binary dust: 6 places first
            return F.round(c, 6).cast("long").cast("double")
        if rule == "round0":
            return F.bround(c, 0)
        return c

    j = j.select("measure", fix(F.col("default")).alias("default"),
                 fix(F.col("detailed")).alias("detailed"))
    j = j.withColumn("diff", F.col("detailed") - F.col("default"))
    return j.withColumn("ok", F.abs(F.col("diff")) <= tolerance)


#: Exact totals: values as decimals of this type, so sums do not depend on the order of rows.
EXACT = "decimal(38,12)"


def reconcile_cells(detailed: DataFrame, default: DataFrame, measures: Sequence[str], by: Sequence[str] = ("dataset", "fyear"),
                    tolerance: float = 0.0, value: str = "mean") -> DataFrame:
    """C4/C5 per ``by`` and measure, so that opposite errors of two datasets do not cancel.

    Totals are sums of decimals: equal on any partitioning, and with ``tolerance`` 0 any
    difference is reported.  A group that one side lacks counts as 0 there.
    """
    keys = [*by, "measure"]

    def totals(df: DataFrame, name: str) -> DataFrame:
        return (df.where(F.col("measure").isin(list(measures))).groupBy(*keys)
                .agg(F.sum(F.col(value).cast(EXACT)).alias(name)))

    left, right = totals(default, "default"), totals(detailed, "detailed")
    # null keys match null keys; one union and one aggregation instead of a null-safe full join
    both = left.unionByName(right, allowMissingColumns=True).groupBy(*keys).agg(
        *[F.coalesce(F.max(n), F.lit(0).cast(EXACT)).alias(n) for n in ("default", "detailed")])
    both = both.withColumn("diff", F.col("detailed") - F.col("default"))
    return both.withColumn("ok", F.abs("diff") <= F.lit(str(tolerance)).cast(EXACT))
