"""Every registered query against its DuckDB oracle on the small fixture tables."""

import math

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry
from mcrunstat.plans.oracle import oracle_sql
from mcrunstat.plans.queries import queries
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else (v if math.isinf(v) else float(f"{v:.9g}"))
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(df):
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("key", sorted(queries()))
def test_query_matches_oracle(spark, con, key):
    sdf = queries()[key](spark, SF_SMALL).toPandas()
    ddf = con.execute(oracle_sql()[key]).fetchdf()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    assert len(sdf) == len(ddf)
    assert _rows(sdf) == _rows(ddf)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "median" in df.columns
