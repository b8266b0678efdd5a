"""Tables of run rows are never gathered on the driver, however small they are estimated."""

import duckdb
import pytest
from pyspark.sql import functions as F

from mcrunstat.operators import measures as M
from mcrunstat.plans.oracle import oracle_sql
from mcrunstat.plans.queries import queries
from mcrunstat.sources.fixtures import Fixtures
from tests.conftest import SF_SMALL
from tests.test_oracle import _rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark, kind):
    """Three baseline rows, one of them without runs, and an exploded run list whose estimate
    is far below its rows, as stored run tables have it."""
    base = spark.sql("select * from values (1L, 'S01'), (2L, null), (3L, 'S02') as t(rn, sitetret)")
    names = M.OP_MEASURES if kind == "op" else ("arrivals",)
    base = base.select("*", *[F.lit(9).alias(c) for c in names])
    runs = spark.range(1, 3).select(F.col("id").alias("rn"), F.explode(F.sequence(F.lit(1), F.lit(16))).alias("model_run"))
    return base, runs.select("*", *[(F.col("model_run") + k).alias(c) for k, c in enumerate(names)])


@pytest.mark.parametrize("kind", ["op", "aae"])
def test_runs_are_not_broadcast(spark, kind):
    base, runs = _tables(spark, kind)
    df = (M.op_run_rows if kind == "op" else M.aae_run_rows)(base, runs)
    plan = _plan(df)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    value = "attendances" if kind == "op" else "arrivals"
    got = sorted((r["rn"], r["model_run"], r[value]) for r in df.collect())
    assert got == [(rn, run, run) for rn in (1, 2) for run in range(1, 17)]


@pytest.mark.parametrize("kind", ["op", "aae"])
def test_aggregated_results_do_not_broadcast_runs(spark, kind):
    plan = _plan(Fixtures(spark, SF_SMALL)["default_means"].where(F.col("activity") == kind))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_run_listing_does_not_broadcast_runs(spark):
    plan = _plan(Fixtures(spark, SF_SMALL)["default_old"])
    assert plan.count("SortMergeJoin") >= 1


def _own_tables(spark, folder):
    """Nine events, one of an unknown kind and one user without an age group, sixteen orders (a run
    each) and a few converted line items; returns the folder and a DuckDB connection over it."""
    spark.sql("""select id as event_id, timestamp'2024-01-01' as ts, if(id = 3, 0L, 7 + id % 4) as user_id,
                        element_at(array('click', 'view', 'error'), cast(id % 3 + 1 as int)) as event_type,
                        cast(id * 12 as double) as value, '{}' as props from range(9)""") \
        .write.parquet(f"{folder}/events.parquet")
    spark.sql("select id as o_orderkey from range(16)").write.parquet(f"{folder}/orders.parquet")
    spark.sql("""select id as l_orderkey, id * 5 as l_partkey, id % 4 as l_suppkey, cast(id % 3 + 1 as int) as l_linenumber,
                        if(id % 2 = 0, 'R', 'A') as l_returnflag, if(id % 3 = 0, 'F', 'O') as l_linestatus from range(12)""") \
        .write.parquet(f"{folder}/lineitem.parquet")
    con = duckdb.connect()
    for t in ("events", "orders", "lineitem"):
        con.execute(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet/*.parquet')")
    return str(folder), con


@pytest.mark.parametrize("key", ["detailed_aae_hrg", "detailed_aae_standard", "detailed_op_hrg"])
def test_detailed_query_broadcasts_nothing(spark, tmp_path, key):
    sf, con = _own_tables(spark, tmp_path)
    df = queries()[key](spark, sf)
    got = _rows(df.toPandas())
    plan = _plan(df)
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert got and got == _rows(con.execute(oracle_sql()[key]).fetchdf())
