"""Declared schemas, required-column checks and aggregation configurations."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from .functions.bands import age_cut


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "input") -> DataFrame:
    """Fail at plan-build time (not mid-job) when a needed column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"{what} lacks columns {missing}; has {df.columns}")
    return df


# Columns each table must carry for the products that read it.
IP_BASELINE_COLUMNS = ("rn", "sitetret", "age", "pod", "tretspef", "has_procedure", "speldur", "classpat")
IP_RUN_COLUMNS = ("rn", "model_run", "speldur", "classpat")
OP_BASELINE_COLUMNS = ("rn", "sitetret", "age", "tretspef", "is_first", "has_procedures",
                       "attendances", "tele_attendances")
OP_RUN_COLUMNS = ("rn", "model_run", "attendances", "tele_attendances")
AAE_BASELINE_COLUMNS = ("rn", "sitetret", "age", "pod", "attendance_category", "aedepttype",
                        "is_ambulance", "arrivals")
AAE_RUN_COLUMNS = ("rn", "model_run", "arrivals")


@dataclass(frozen=True)
class AggConfig:
    """Cell definition per activity, plus an optional age-group rule.

    ``age_groups`` replaces ``age_group`` from ``age`` when set (the hrg products).
    """

    name: str
    ip_cols: tuple[str, ...]
    op_cols: tuple[str, ...]
    aae_cols: tuple[str, ...]
    age_groups: Callable[[Column], Column] | None = None


# The cell keys of the two output layouts.
STANDARD = AggConfig(
    name="standard",
    ip_cols=("sitetret", "age_group", "sex", "pod", "tretspef", "los_group",
             "maternity_delivery_in_spell"),
    op_cols=("sitetret", "pod", "age_group", "tretspef"),
    aae_cols=("sitetret", "pod", "age_group", "attendance_category", "aedepttype", "acuity"),
)
HRG = AggConfig(
    name="hrg",
    ip_cols=("sitetret", "age_group", "pod", "tretspef", "sushrg", "maternity_delivery_in_spell"),
    op_cols=("sitetret", "pod", "age_group", "tretspef"),
    aae_cols=("sitetret", "pod", "age_group", "attendance_category", "aedepttype"),
    age_groups=lambda age: age_cut(age),
)
