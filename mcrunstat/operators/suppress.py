"""A21 small-cell suppression for disclosure control."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import GROUPED


def suppress_small_counts(df: DataFrame, full_keys: Sequence[str], group_keys: Sequence[str],
                          value: str = "value", grouped_value: str = GROUPED,
                          threshold: float = 5, flag: str = "is_grouped") -> DataFrame:
    """Cells >= threshold stay; cells below it are re-summed by ``group_keys`` and the
    other keys read ``grouped``.  Null values drop out (D15); re-summed groups may
    still be small (D13).  With no small cell the input comes back unchanged.

    One pass over the (already aggregated, one row per ``full_keys``) cells: small
    cells get their collapsed keys rewritten, ``flag`` joins the grouping key (a real
    key could equal ``grouped``), and a single grouped sum does the rest, partial
    aggregation first, so the input plan is evaluated once.
    """
    full_keys, group_keys = list(full_keys), list(group_keys)
    collapsed = set(full_keys) - set(group_keys)
    small = F.col(value) < threshold
    rows = df.where(F.col(value).isNotNull()).select(
        *[F.when(small, F.lit(grouped_value)).otherwise(F.col(c).cast("string")).alias(c)
          if c in collapsed else F.col(c) for c in full_keys],
        small.alias(flag), F.col(value))
    out = rows.groupBy(*full_keys, flag).agg(F.sum(value).alias(value))
    return out.select(*full_keys, value, flag)
