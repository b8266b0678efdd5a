"""Banding expressions (Column -> Column), all plain CASE WHEN.

A dict lookup with a default band maps null, negative and fractional values to the
default; ``int_band`` reproduces that. ``cut_band`` is a half-open interval cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Band edges and labels that must equal the source behaviour.
# Inclusive integer ranges (lo, hi, label); anything else takes the default.
LOS_DETAILED = [(0, 0, "0 days"), (1, 1, "1 day"), (2, 2, "2 days"), (3, 3, "3 days"),
                (4, 7, "4-7 days"), (8, 14, "8-14 days"), (15, 21, "15-21 days")]
LOS_DETAILED_DEFAULT = "22+ days"
LOS_AVOIDED = [(0, 0, "0 days")]
LOS_AVOIDED_DEFAULT = "1+ days"
LOS_CUSTOM = [(0, 0, "0 days"), (1, 6, "1-6 days"), (7, 14, "7-14 days")]
LOS_CUSTOM_DEFAULT = "15+ days"
AGE_CUSTOM = [(0, 9, "Paeds < 10"), (10, 17, "Paeds 10-17"), (18, 64, "Adults 18-64")]
AGE_CUSTOM_DEFAULT = "Adults >= 65"
# Half-open age cut [-1,0) [0,1) [1,18) [18,1000); null counts as -1; outside -> "nan".
AGE_CUT_EDGES = [-1, 0, 1, 18, 1000]
AGE_CUT_LABELS = ["Unknown", "0", "1-17", "18+"]
AGE_CUT_OUTSIDE = "nan"
# National length-of-stay groups: 0, 1, 2 and over; anything else null.
LOS_NATIONAL = [(0, 0, "0"), (1, 1, "1")]
LOS_NATIONAL_OPEN = (2, "2+")
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_band(c: Column | str, ranges: Sequence[tuple[int, int, str]], default: str | None) -> Column:
    """Lookup of whole values in inclusive ranges; null/fractional/other -> default."""
    x = _col(c)
    expr = F.when(x != F.floor(x), F.lit(default))  # fractional values: default band
    for lo, hi, label in ranges:
        cond = (x == lo) if lo == hi else x.between(lo, hi)
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def cut_band(c: Column | str, edges: Sequence[float], labels: Sequence[str],
             null_as: float | None = None, outside: str | None = None) -> Column:
    """Half-open cut: [edges[i], edges[i+1]) -> labels[i]."""
    x = _col(c)
    if null_as is not None:
        x = F.coalesce(x, F.lit(null_as))
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (x >= lo) & (x < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(outside))


def los_detailed(c: Column | str = "speldur") -> Column:
    return int_band(c, LOS_DETAILED, LOS_DETAILED_DEFAULT)


def los_avoided(c: Column | str = "speldur") -> Column:
    return int_band(c, LOS_AVOIDED, LOS_AVOIDED_DEFAULT)


def los_custom(c: Column | str = "speldur") -> Column:
    return int_band(c, LOS_CUSTOM, LOS_CUSTOM_DEFAULT)


def age_custom(c: Column | str = "age") -> Column:
    return int_band(c, AGE_CUSTOM, AGE_CUSTOM_DEFAULT)


def age_cut(c: Column | str = "age") -> Column:
    return cut_band(c, AGE_CUT_EDGES, AGE_CUT_LABELS, null_as=-1, outside=AGE_CUT_OUTSIDE)


def los_national(c: Column | str = "speldur") -> Column:
    """0 -> '0', 1 -> '1', >= 2 -> '2+', anything else (null, negative) -> null."""
    x = _col(c)
    expr = None
    for lo, _hi, label in LOS_NATIONAL:
        expr = F.when(x == lo, F.lit(label)) if expr is None else expr.when(x == lo, F.lit(label))
    lo, label = LOS_NATIONAL_OPEN
    return expr.when(x >= lo, F.lit(label)).otherwise(F.lit(None).cast("string"))
