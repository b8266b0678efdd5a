"""Baseline cohorts, strategy and release aggregates.

Cohort tables that the source builds as separate filtered group-bys glued by
outer joins are computed here as conditional sums in one grouped scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import (
    AAE_FLAGS,
    op_consultant_referral,
    op_followup,
    op_gp_referred_first,
    op_tele_convertible,
)
from .measures import ROW_KEYS, drop_null_keys, row_keys

# Output names of the outpatient cohorts (prefix, predicate).
OP_COHORTS = (
    ("gp_referred", op_gp_referred_first),
    ("consultant_to_consultant_referrals", op_consultant_referral),
    ("followup_reduction", op_followup),
)
OP_TELE_PREFIX = "convert_to_tele"


def _keys(df: DataFrame, keys: Sequence[str] | None, own: Sequence[str]) -> list[str]:
    """The given keys; by default the dataset and, where the table has it, the year before ``own``."""
    return list(keys) if keys is not None else [c for c in ("dataset", "fyear") if c in df.columns] + list(own)


def _csum(pred: Column, col: str) -> Column:
    return F.sum(F.when(pred, F.col(col)))


def op_mitigators(df: DataFrame, keys: Sequence[str] | None = None, site_form: bool = False) -> DataFrame:
    """Outpatient mitigator cohorts per key, by default per dataset, year (where the table has
    it), site (site form) and type.

    Dataset form: tele conversion counts attendances only and a cohort without
    rows for a key is null.  Site form: tele conversion also counts
    tele-attendances and gaps are 0.  A key present in no cohort is not reported.
    """
    keys = _keys(df, keys, ("sitetret", "type") if site_form else ("type",))
    df = drop_null_keys(df, keys)
    tele = op_tele_convertible()
    aggs = [_csum(tele, "attendances").alias(f"{OP_TELE_PREFIX}_attendances")]
    if site_form:
        aggs.append(_csum(tele, "tele_attendances").alias(f"{OP_TELE_PREFIX}_tele_attendances"))
    for name, pred in OP_COHORTS:
        aggs += [_csum(pred(), "attendances").alias(f"{name}_attendances"),
                 _csum(pred(), "tele_attendances").alias(f"{name}_tele_attendances")]
    any_cohort = tele
    for _, pred in OP_COHORTS:
        any_cohort = any_cohort | pred()
    aggs.append(F.max(any_cohort).alias("_any"))
    g = df.groupBy(*keys).agg(*aggs).where(F.col("_any")).drop("_any")
    value_cols = [c for c in g.columns if c not in keys]
    if site_form:
        g = g.select(*keys, *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in value_cols])
    else:
        g = g.select(*keys, *[F.col(c).cast("long").alias(c) for c in value_cols])
    return g


def aae_mitigators(df: DataFrame, keys: Sequence[str] | None = None, value: str = "arrivals",
                   site_form: bool = False) -> DataFrame:
    """Arrivals per A&E flag for every key group, by default per dataset, year (where the table
    has it), site (site form) and group; 0 when no row has the flag."""
    keys = _keys(df, keys, ("sitetret", "hsagrp") if site_form else ("hsagrp",))
    df = drop_null_keys(df, keys)
    return df.groupBy(*keys).agg(*[
        F.coalesce(_csum(F.col(flag), value), F.lit(0)).cast("long").alias(flag)
        for flag in AAE_FLAGS
    ])


# ------------------------------------------------------------------ A13 / A14
def ip_pod_totals(df: DataFrame, keys: Sequence[str] = ("dataset", "pod")) -> DataFrame:
    """A13 ip: admissions (row count) and bed days per key."""
    keys = list(keys)
    return drop_null_keys(df, keys).groupBy(*keys).agg(
        F.count("rn").alias("admissions"), F.sum(F.col("speldur") + 1).cast("long").alias("beddays"))


def op_pod_totals(df: DataFrame, keys: Sequence[str] = ("dataset", "pod")) -> DataFrame:
    keys = list(keys)
    return drop_null_keys(df, keys).groupBy(*keys).agg(
        F.sum("attendances").cast("long").alias("attendances"),
        F.sum("tele_attendances").cast("long").alias("tele_attendances"))


def aae_pod_totals(df: DataFrame, keys: Sequence[str] = ("dataset", "pod", "grp")) -> DataFrame:
    keys = list(keys)
    return drop_null_keys(df, keys).groupBy(*keys).agg(
        F.sum("arrivals").cast("long").alias("arrivals"))


def strategy_totals(df: DataFrame, keys: Sequence[str] = ("kind", "strategy")) -> DataFrame:
    """Rows and summed sample rate per strategy (both strategy kinds stacked)."""
    keys = list(keys)
    return drop_null_keys(df, keys).groupBy(*keys).agg(
        F.count("rn").alias("count"), F.sum("sample_rate").alias("sample_rate"))


def cell_levels(df: DataFrame, levels: dict[str, Sequence[str]], aggs: dict[str, Column]) -> DataFrame:
    """P5/P10: several cell definitions in one scan: ``level``, the columns of all levels (null where
    a level has them not) and the aggregates, one row per cell of each level.

    One Expand and one aggregation (grouping sets) instead of a scan per definition; rows with
    a null in one of a level's own keys make no cell of that level (D4).
    """
    columns = list(dict.fromkeys(c for keys in levels.values() for c in keys))
    names = list(levels)
    missing = [[c not in levels[n] for c in columns] for n in names]
    codes = [sum(m << (len(columns) - 1 - i) for i, m in enumerate(row)) for row in missing]
    if len(set(codes)) < len(codes):
        raise ValueError("two levels have the same keys")
    out = df.groupingSets([[F.col(c) for c in levels[n]] for n in names], *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_level"), *[a.alias(n) for n, a in aggs.items()])
    whole = F.lit(False)
    for n, code in zip(names, codes):
        own = F.col("_level") == code
        for c in levels[n]:
            own &= F.col(c).isNotNull()
        whole |= own
    level = F.coalesce(*[F.when(F.col("_level") == code, n) for n, code in zip(names, codes)])
    return out.where(whole).select(level.alias("level"), *columns, *aggs)


# ----------------------------------------------------------------- A15 / A18
def _strategy_spells(strategies: DataFrame, baseline: DataFrame) -> DataFrame:
    """J4 on the row keys that both tables carry: ``rn`` alone repeats between datasets and years."""
    spells = baseline.select(*[c for c in ROW_KEYS if c in baseline.columns], "sitetret", "speldur")
    return strategies.join(spells, row_keys(strategies, spells), "inner")


def strategy_efficiencies(strategies: DataFrame, baseline: DataFrame,
                          keys: Sequence[str] = ("dataset", "fyear", "strategy", "sitetret")) -> DataFrame:
    """J4 + A15: efficiency strategies joined to their spells, per dataset and year."""
    keys = list(keys)
    j = _strategy_spells(strategies, baseline)
    return drop_null_keys(j, keys).groupBy(*keys).agg(
        F.sum("speldur").cast("long").alias("speldur"),
        F.sum(F.col("speldur") + 1).cast("long").alias("beddays"),
        F.count("rn").alias("admissions"))


def strategy_avoidance(strategies: DataFrame, baseline: DataFrame,
                       keys: Sequence[str] = ("dataset", "fyear", "strategy", "sitetret")) -> DataFrame:
    """J4 + A15: activity-avoidance strategies joined to their spells, per dataset and year."""
    keys = list(keys)
    j = _strategy_spells(strategies, baseline)
    return drop_null_keys(j, keys).groupBy(*keys).agg(
        F.count("rn").alias("admissions"),
        F.sum("sample_rate").alias("sample_rate_sum"),
        F.sum(F.col("speldur") + 1).cast("long").alias("beddays"))


def detailed_baseline_ip(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """A18 ip, per dataset, year (where the table has it) and cell."""
    keys = _keys(df, keys, ("sitetret", "grp", "pod", "tretspef"))
    return drop_null_keys(df, keys).groupBy(*keys).agg(
        F.count("rn").alias("admissions"),
        F.sum(F.col("speldur") + 1).cast("long").alias("beddays"),
        F.sum("speldur").cast("long").alias("speldur"))


def detailed_baseline_op(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """A18 op, per dataset, year (where the table has it) and cell."""
    return op_pod_totals(df, _keys(df, keys, ("sitetret", "grp", "tretspef", "type")))


def detailed_baseline_aae(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """A18 aae, per dataset, year (where the table has it) and cell."""
    return aae_pod_totals(df, _keys(df, keys, ("sitetret", "hsagrp", "aedepttype", "attendance_category")))
