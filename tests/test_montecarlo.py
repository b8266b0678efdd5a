import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mcrunstat.operators.montecarlo import (
    collect_runs,
    fill_missing_groups,
    normal_ci,
    run_summary,
)


def test_run_summary_matches_numpy_with_padding(spark):
    rng = np.random.default_rng(3)
    rows, expect = [], {}
    for cell, k in (("a", 256), ("b", 10), ("c", 1)):
        vals = rng.integers(0, 100, size=k).astype(float)
        rows += [(cell, i + 1, float(v)) for i, v in enumerate(vals)]
        padded = np.concatenate([vals, np.zeros(256 - k)])
        p = np.percentile(padded, [10, 50, 90])
        expect[cell] = (p[0], p[1], padded.mean(), p[2])
    df = spark.createDataFrame(rows, "cell string, model_run int, value double")
    got = {r["cell"]: (r["lwr_ci"], r["median"], r["mean"], r["upr_ci"])
           for r in run_summary(df, ["cell"], 256).collect()}
    for cell, e in expect.items():
        assert got[cell] == pytest.approx(e, rel=1e-12, abs=1e-12)
        assert got[cell][0] <= got[cell][1] <= got[cell][3]


def test_run_summary_small_n_runs(spark):
    vals = [5.0, 1.0, 3.0]
    df = spark.createDataFrame([("x", i, v) for i, v in enumerate(vals)], "cell string, model_run int, value double")
    r = run_summary(df, ["cell"], 4).collect()[0]
    padded = np.array(vals + [0.0])
    assert r["median"] == pytest.approx(np.percentile(padded, 50))
    assert r["upr_ci"] == pytest.approx(np.percentile(padded, 90))


def test_run_summary_more_values_than_runs_raises(spark):
    df = spark.createDataFrame([("x", i, 1.0) for i in range(5)], "cell string, model_run int, value double")
    with pytest.raises(Exception, match="n_runs"):
        run_summary(df, ["cell"], 4).collect()


def test_run_summary_all_runs_kept(spark):
    df = spark.createDataFrame([("x", i, 1.0) for i in range(3)], "cell string, model_run int, value double")
    with pytest.raises(Exception):
        run_summary(df, ["cell"], 4, all_runs_kept=True).collect()


def test_collect_runs_one_sided_and_order(spark):
    rows = [("p", 0, 7), ("p", 2, 4), ("p", 1, 2), ("base_only", 0, 3), ("runs_only", 1, 5),
            (None, 0, 1), (None, 1, 9)]
    df = spark.createDataFrame(rows, "pod string, model_run int, value long")
    got = {r["pod"]: r for r in collect_runs(df).collect()}
    assert got["p"]["baseline"] == 7 and list(got["p"]["model_runs"]) == [2, 4] and got["p"]["mean"] == 3.0
    assert got["base_only"]["model_runs"] is None and got["base_only"]["mean"] is None
    assert got["runs_only"]["baseline"] is None and got["runs_only"]["mean"] == 5.0
    assert got[None]["baseline"] == 1 and list(got[None]["model_runs"]) == [9]  # D22
    nb = {r["pod"]: r for r in collect_runs(df, include_baseline=False).collect()}
    assert list(nb["p"]["model_runs"]) == [7, 2, 4] and "baseline" not in nb["p"].asDict()


def _per_run(spark):
    rows = [(1, "a", None, 5, 1), (2, "a", None, 7, 2), (3, "a", None, 1, 1),
            (1, "b", "x", 2, 1), (3, "b", "x", 4, 1), (2, "c", "y", 10, 3)]
    return spark.createDataFrame(rows, "model_run int, g1 string, g2 string, beddays long, admissions long")


def test_fill_missing_groups_is_runs_times_cells_and_null_safe(spark):
    pr = _per_run(spark)
    filled = fill_missing_groups(pr, ["g1", "g2"], ["beddays", "admissions"])
    assert filled.count() == 3 * 3  # runs x cells; null-key cell gains no extra rows (D2)
    a = filled.where((F.col("g1") == "a") & F.col("g2").isNull()).count()
    assert a == 3
    assert filled.agg(F.sum("beddays")).collect()[0][0] == pr.agg(F.sum("beddays")).collect()[0][0]


def test_normal_ci_equals_stats_of_filled_table(spark):
    pr = _per_run(spark)
    got = {(r["g1"], r["g2"]): r for r in normal_ci(pr, ["g1", "g2"], ["beddays", "admissions"]).collect()}
    filled = fill_missing_groups(pr, ["g1", "g2"], ["beddays", "admissions"])
    ref = filled.groupBy("g1", "g2").agg(F.avg("beddays").alias("m"), F.stddev("beddays").alias("s"),
                                         F.count("beddays").alias("n")).collect()
    for r in ref:
        g = got[(r["g1"], r["g2"])]
        assert g["mean_beddays"] == pytest.approx(r["m"])
        assert g["std_beddays"] == pytest.approx(r["s"])
        half = 1.645 * r["s"] / math.sqrt(r["n"])
        assert g["beddays_upper_ci"] == pytest.approx(r["m"] + half)
        assert g["beddays_lower_ci"] == pytest.approx(max(0.0, r["m"] - half))


def test_normal_ci_single_run_lower_zero_upper_null(spark):
    df = spark.createDataFrame([(1, "a", 4)], "model_run int, g string, v long")
    r = normal_ci(df, ["g"], ["v"]).collect()[0]
    assert r["std_v"] is None and r["v_lower_ci"] == 0.0 and r["v_upper_ci"] is None  # D18


def test_normal_ci_counts_null_values_as_zeros(spark):
    from mcrunstat.operators.montecarlo import normal_ci

    per_run = spark.createDataFrame([("a", 1, None, 4), ("a", 2, 6.0, None), ("b", 1, None, 1)],
                                    "cell string, model_run int, v double, w int")
    got = {r["cell"]: r for r in normal_ci(per_run, ["cell"], ["v", "w"], n_runs=4).collect()}
    assert (got["a"]["mean_v"], got["a"]["n_v"], got["b"]["mean_v"], got["b"]["std_v"]) == (1.5, 4, 0.0, 0.0)
    assert got["a"]["mean_w"] == 1.0 and abs(got["a"]["std_v"] - 3.0) < 1e-12


def test_sampling_takes_any_fraction(spark):
    import pytest

    from mcrunstat.plans.products import hash_sample

    df = spark.range(200_000).withColumnRenamed("id", "rn")
    assert 0 < hash_sample(df, 0.00004, 1).count() < 40
    assert hash_sample(df, 1, 1).count() == 200_000
    for bad in (0, -1, 1.5):
        with pytest.raises(ValueError):
            hash_sample(df, bad, 1)
