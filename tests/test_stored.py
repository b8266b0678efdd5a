"""Stored layouts, parameter files, products kept up to date, states, and repeating row numbers."""

import os
import shutil
import subprocess
import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mcrunstat.operators import cohorts as C
from mcrunstat.operators import compare as K
from mcrunstat.operators import measures as M
from mcrunstat.operators.montecarlo import merge_states, run_state, run_summary, summarise_state
from mcrunstat.plans import products as P
from mcrunstat.sources import layout as L
from mcrunstat.sources import scan as S
from mcrunstat.sources.sink import advance_state

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _base(spark):
    return spark.createDataFrame([(1, 1994, "RX", 5), (2, 1995, "RX", 6), (3, 1995, "RX1", 7), (4, 1995, None, 8)],
                                 "rn long, fyear int, dataset string, speldur int")


def test_layout_prunes_folders_and_merges_schemas(spark, tmp_path):
    path = str(tmp_path / "v1" / "ip")
    df = _base(spark)
    L.write_partitioned(df.where("fyear = 1994"), path, ["fyear", "dataset"])
    L.write_partitioned(df.where("fyear = 1995").withColumn("more", F.lit("x")), path, ["fyear", "dataset"], mode="append")
    whole = L.scan_layout(spark, path)
    assert sorted((r.rn, r.fyear, r.dataset, r.more) for r in whole.collect()) == [
        (1, 1994, "RX", None), (2, 1995, "RX", "x"), (3, 1995, "RX1", "x"), (4, 1995, None, "x")]
    one = S.filter_partitions(whole, "RX", 1995).select("rn")
    assert "PartitionFilters: [isnotnull(fyear" in _plan(one) and [r.rn for r in one.collect()] == [2]
    # the first file is not opened: it is broken, and the answer is the same
    broken = next((tmp_path / "v1" / "ip" / "fyear=1994" / "dataset=RX").glob("*.parquet"))
    named = L.scan_layout(spark, path, merge_schema=False)
    broken.write_bytes(b"no parquet")
    assert [r.rn for r in S.filter_partitions(named, "RX", 1995).select("rn").collect()] == [2]
    names = S.list_datasets(named)
    assert "ReadSchema: struct<>" in _plan(names)
    with pytest.raises(Exception):
        L.scan_layout(spark, str(tmp_path / "v1" / "ip" / "fyear=1995"), columns=["nothing"])


def test_flat_layout_takes_keys_from_paths(spark, tmp_path):
    root = str(tmp_path)
    paths = L.write_flat(_base(spark).where("dataset is not null"), root, "v3", "ip")
    assert sorted(p.split("/v3/")[1] for p in paths) == ["1994/RX/ip.parquet", "1995/RX/ip.parquet", "1995/RX1/ip.parquet"]
    every = L.scan_baseline_flat(spark, root, "v3", "ip")
    assert sorted((r.rn, r.fyear, r.dataset) for r in every.collect()) == [(1, 1994, "RX"), (2, 1995, "RX"), (3, 1995, "RX1")]
    one = L.scan_baseline_flat(spark, root, "v3", "ip", dataset=["RX"], fyear=1995)
    assert [(r.rn, r.speldur) for r in one.collect()] == [(2, 6)]
    files = L.list_files(spark, root)
    assert "content" not in _plan(files)
    assert sorted(r.path.rsplit("/", 1)[0] for r in files.collect() if r.path.endswith(".parquet"))[0] == "v3/1994/RX/ip.parquet"


PARAMS = [
    ("A", "s1", "t1", '{"seed": 1, "new": {"deep": [1, 2]}, "non-demographic_adjustment": {"x": [1.5, 2.0]}}'),
    ("A", "s2", "t1", '{"seed": 2, "non-demographic_adjustment": {"variant": "own", "value-type": "v", "values": {"x": [3.0]}}}'),
    ("B", "s1", "t1", '{"seed": "three"}'), ("B", "s2", "t1", "not json"),
]


def test_parameter_files_keep_unknown_fields_and_are_upgraded(spark, tmp_path):
    docs = spark.createDataFrame(PARAMS, "dataset string, scenario string, create_datetime string, document string")
    L.write_params(docs, str(tmp_path / "old"))
    old = L.read_params_variant(spark, str(tmp_path / "old"))
    got = {(r.dataset, r.scenario): (r.seed, r.deep) for r in old.select(
        "dataset", "scenario", L.param("$.seed", "int").alias("seed"), L.param("$.new.deep[1]", "int").alias("deep")).collect()}
    assert got == {("A", "s1"): (1, 2), ("A", "s2"): (2, None), ("B", "s1"): (None, None), ("B", "s2"): (None, None)}
    L.write_params(L.upgrade_documents(old.where("document is not null")), str(tmp_path / "new"))
    new = L.read_params_variant(spark, str(tmp_path / "new"))
    before = {(r.dataset, r.scenario, r.field): r.value for r in L.param_fields(old).collect()}
    after = {(r.dataset, r.scenario, r.field): r.value for r in L.param_fields(new).collect()}
    assert {k for k in before if before[k] != after.get(k)} == {("A", "s1", "non-demographic_adjustment")}
    assert set(before) == set(after)
    ndg = new.where("dataset = 'A' and scenario = 's1'").select(
        L.param("$['non-demographic_adjustment'].values.x[0]", "double").alias("x"),
        L.param("$['non-demographic_adjustment'].variant", "string").alias("v")).first()
    assert tuple(ndg) == (1.5, "ndg-test")
    # once more changes nothing
    again = {(r.dataset, r.scenario): r.document for r in L.upgrade_documents(new).collect()}
    assert again == {(r.dataset, r.scenario): r.d for r in new.select("*", F.to_json("document").alias("d")).collect()}


def test_product_computes_only_partitions_that_are_not_complete(spark, tmp_path):
    base, root = _base(spark).where("dataset is not null"), str(tmp_path / "product")
    asked = []

    def build(todo):
        asked.append(sorted((r.dataset, r.fyear) for r in todo.collect()))
        rows = base.join(todo, ["dataset", "fyear"], "left_semi")
        return rows.groupBy("dataset", "fyear").agg(F.sum("speldur").alias("days"))

    keys = base.select("dataset", "fyear").distinct()
    L.refresh(spark, root, keys.where("dataset = 'RX'"), ["dataset", "fyear"], build)
    kept = {p.name for p in (tmp_path / "product" / "rows" / "dataset=RX" / "fyear=1995").glob("*.parquet")}
    L.refresh(spark, root, keys, ["dataset", "fyear"], build)
    assert L.refresh(spark, root, keys, ["dataset", "fyear"], build).count() == 0
    assert asked == [[("RX", 1994), ("RX", 1995)], [("RX1", 1995)]]
    assert kept == {p.name for p in (tmp_path / "product" / "rows" / "dataset=RX" / "fyear=1995").glob("*.parquet")}
    got = sorted((r.dataset, r.fyear, r.days) for r in L.read_product(spark, root, ["dataset", "fyear"]).collect())
    assert got == [("RX", 1994, 5), ("RX", 1995, 6), ("RX1", 1995, 7)]
    # a write that failed marks nothing as done
    more = spark.createDataFrame([("NEW", 1)], "dataset string, fyear int")
    with pytest.raises(PySparkException):
        L.refresh(spark, root, more, ["dataset", "fyear"],
                  lambda todo: todo.withColumn("days", F.raise_error(F.lit("cut off")).cast("long")))
    assert L.outstanding(more, spark, root, ["dataset", "fyear"]).count() == 1


def test_runs_in_batches_equal_one_pass(spark, tmp_path):
    rows = [(c, r, float((7 * r + len(c)) % 11)) for c in ("a", "bb") for r in range(1, 65) if not (c == "a" and r % 5 == 0)]
    df = spark.createDataFrame(rows, "cell string, model_run int, value double")
    for k in range(4):
        batch = run_state(df.where(F.col("model_run").between(16 * k + 1, 16 * k + 16)), ["cell"])
        state = advance_state(batch, str(tmp_path), lambda states: merge_states(states, ["cell"]))
    got = sorted(map(tuple, summarise_state(state, ["cell"], 64).collect()))
    assert got == sorted(map(tuple, run_summary(df, ["cell"], 64).collect()))
    with pytest.raises(PySparkException, match="in the state already"):
        advance_state(run_state(df.where("model_run = 3"), ["cell"]), str(tmp_path), lambda s: merge_states(s, ["cell"]))
    # the state before the refused batch is still the latest
    more = run_state(spark.createDataFrame([("a", 65, 1.0)], "cell string, model_run int, value double"), ["cell"])
    state = advance_state(more, str(tmp_path), lambda s: merge_states(s, ["cell"]))
    assert {r.cell: len(r.runs) for r in state.collect()} == {"a": 53, "bb": 64}


def test_opposite_errors_do_not_cancel(spark):
    schema = "dataset string, measure string, mean double"
    a = spark.createDataFrame([("A", "m", 0.1)] * 10 + [("B", "m", 2.0), ("C", "m", 1.0), (None, "m", 4.0)], schema)
    b = spark.createDataFrame([("A", "m", 1.5), ("B", "m", 1.5), (None, "m", 4.0)], schema)
    got = {r.dataset: (float(r.diff), r.ok) for r in K.reconcile_cells(a, b, ["m"], by=("dataset",)).collect()}
    assert got == {"A": (-0.5, False), "B": (0.5, False), "C": (1.0, False), None: (0.0, True)}
    many = spark.createDataFrame([("A", "m", 0.1 * k) for k in range(1, 400)], schema)
    totals = {K.reconcile_cells(many.repartition(n), b, ["m"], by=("dataset",)).where("dataset = 'A'").first().detailed for n in (1, 3, 7)}
    assert len(totals) == 1


def test_levels_equal_separate_group_bys(spark):
    df = spark.createDataFrame([("A", "x", 1), ("A", "y", 2), ("A", None, 4), ("B", "x", 8), (None, "x", 16)], "d string, p string, v int")
    out = C.cell_levels(df, {"d": ["d"], "p": ["p"], "both": ["d", "p"]}, {"v": F.sum("v")})
    assert _plan(out).count("Expand") == 1
    assert {(r.level, r.d, r.p): r.v for r in out.collect()} == {
        ("d", "A", None): 7, ("d", "B", None): 8, ("p", None, "x"): 25, ("p", None, "y"): 2,
        ("both", "A", "x"): 1, ("both", "A", "y"): 2, ("both", "B", "x"): 8}
    with pytest.raises(ValueError):
        C.cell_levels(df, {"a": ["d"], "b": ["d"]}, {"v": F.sum("v")})


def test_row_numbers_that_repeat_between_datasets(spark):
    base = spark.createDataFrame([(1, d, y, "S", "p", "g", "h", 3, "1") for d, y in (("A", 2000), ("B", 2000), ("A", 2001))],
                                 "rn long, dataset string, fyear int, sitetret string, pod string, grp string, sushrg string, speldur int, classpat string")
    runs = spark.createDataFrame([(1, d, y, 1, 2, "1") for d, y in (("A", 2000), ("B", 2000))],
                                 "rn long, dataset string, fyear int, model_run int, speldur int, classpat string")
    sample = P.national_sample(base)
    assert {r.dataset for r in sample.collect()} == {P.NATIONAL}
    assert [r.admissions for r in P.national_per_run(sample, runs).collect()] == [2]
    assert [r.admissions for r in P.national_avoided_per_run(sample, runs).collect()] == [2]
    assert [r.admissions for r in P.national_per_run(P.national_sample(base.where("dataset = 'A'")), runs).collect()] == [1]
    # tables of one dataset and year, which carry rn alone
    one = base.where("dataset = 'B'").drop("dataset", "fyear")
    assert [r.admissions for r in P.national_per_run(P.national_sample(one), runs.where("dataset = 'B'").drop("dataset", "fyear")).collect()] == [1]
    strategies = spark.createDataFrame([(1, "A", 2000, "s", 0.5), (1, "B", 2000, "s", 0.25)],
                                       "rn long, dataset string, fyear int, strategy string, sample_rate double")
    got = {(r.dataset, r.fyear): (r.admissions, r.sample_rate_sum) for r in C.strategy_avoidance(strategies, base).collect()}
    assert got == {("A", 2000): (1, 0.5), ("B", 2000): (1, 0.25)}
    assert {(r.dataset, r.fyear): r.admissions for r in C.strategy_efficiencies(strategies, base).collect()} == {("A", 2000): 1, ("B", 2000): 1}


def test_short_and_missing_runs_are_reported(spark):
    base = spark.range(4).withColumnRenamed("id", "rn")
    runs = spark.createDataFrame([(i, r) for r in (1, 2) for i in range(4) if not (r == 2 and i == 3)], "rn long, model_run int")
    got = {r.model_run: (r.run_rows, r.ok) for r in M.run_row_counts(base, runs, n_runs=3).collect()}
    assert got == {1: (4, True), 2: (3, False), 3: (0, False)}


def test_the_rest_works_without_the_llm_folders(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "spark-warehouse"))
    code = ("import __spark_entry__ as e\n"
            "assert set(e.queries()) == set(e.oracle_sql()) and 'detailed_ip_standard' in e.queries()\n"
            "assert not [k for k in e.queries() if k.startswith('op1') and k[3:4].isdigit()] and 'pipeline' not in e.queries()\n")
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env={**os.environ, "PYTHONPATH": str(copy)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
