import pytest
from pyspark.sql import functions as F

from mcrunstat.operators import measures as M
from mcrunstat.plans import products as P
from mcrunstat.schema import STANDARD


def _ip(spark):
    base = spark.createDataFrame(
        [(1, "S1", 30, "ag1", "1", "ip_elective_admission", "t", "h1", 0, 1, 3, "1"),
         (2, "S1", None, "ag1", "1", "op_procedure", "t", None, 0, 1, 3, "1"),
         (3, None, 40, "ag2", "2", "ip_elective_admission", "t", "h2", 1, 0, 3, "1")],
        "rn long, sitetret string, age int, age_group string, sex string, pod string, tretspef string,"
        " sushrg string, maternity_delivery_in_spell int, has_procedure int, speldur int, classpat string")
    runs = spark.createDataFrame(
        [(1, 1, 0, "2"), (1, 2, 4, "1"), (2, 1, 2, "1"), (3, 1, 1, "1"), (1, 1, 5, "1")],
        "rn long, model_run int, speldur int, classpat string")
    return base, runs


def test_ip_cells_daycase_opprocedure_nullkeys(spark):
    base, runs = _ip(spark)
    per_run = P.ip_per_run(base, runs, STANDARD)
    got = sorted((r["model_run"], r["pod"], r["los_group"], r["measure"], r["value"]) for r in per_run.collect())
    assert got == [
        (1, "ip_elective_admission", "4-7 days", "admissions", 1),
        (1, "ip_elective_admission", "4-7 days", "beddays", 6),
        (1, "ip_elective_admission", "4-7 days", "procedures", 1),
        (1, "ip_elective_daycase", "0 days", "admissions", 1),
        (1, "ip_elective_daycase", "0 days", "beddays", 1),
        (1, "ip_elective_daycase", "0 days", "procedures", 1),
        (1, "op_procedure", "2 days", "attendances", 1),
        (2, "ip_elective_admission", "4-7 days", "admissions", 1),
        (2, "ip_elective_admission", "4-7 days", "beddays", 5),
        (2, "ip_elective_admission", "4-7 days", "procedures", 1),
    ]  # rn 3 has a null site: its cell is not reported (D4)


def test_ip_cells_keep_null_keys_flag(spark):
    base, runs = _ip(spark)
    rows = M.ip_run_rows(base, runs)
    n = M.ip_cell_values(rows, STANDARD.ip_cols, keep_null_keys=True).where(F.col("sitetret").isNull()).count()
    assert n == 2  # admissions and beddays (procedures 0 filtered)


def test_op_conversion_outer_add_preserves_totals(spark):
    rows = spark.createDataFrame([(1, "S1", "op_first", "a", "t", 3, 1), (1, "S1", "op_first", "a", "t", 2, 0)],
                                 "model_run int, sitetret string, pod string, age_group string, tretspef string,"
                                 " attendances int, tele_attendances int")
    conv = spark.createDataFrame([(1, "S1", "a", "t", 4, 1), (1, "S2", "a", "t", 6, 1), (1, None, "a", "t", 9, 1)],
                                 "model_run int, sitetret string, age_group string, tretspef string,"
                                 " attendances int, age int")
    cells = STANDARD.op_cols
    out = M.op_cell_values(rows, cells, conversions=M.op_conversion_rows(conv, cells))
    got = sorted((r["sitetret"], r["pod"], r["measure"], r["value"]) for r in out.collect())
    assert got == [("S1", "op_first", "attendances", 5), ("S1", "op_first", "tele_attendances", 1),
                   ("S1", "op_procedure", "attendances", 4), ("S2", "op_procedure", "attendances", 6)]


def test_duplicate_rn_plain_unpivot(spark):
    base = spark.createDataFrame([(1, "S1", "a", "t", 2, 1), (1, "S1", "a", "t", 3, 1)],
                                 "rn long, sitetret string, age_group string, tretspef string,"
                                 " attendances int, tele_attendances int").withColumn("pod", F.lit("op_first"))
    out = M.op_cell_values(base, STANDARD.op_cols, run=None)
    got = {r["measure"]: r["value"] for r in out.collect()}
    assert got == {"attendances": 5, "tele_attendances": 2}  # D14: no squaring


def test_filter_sites(spark):
    df = spark.createDataFrame([("S01",), ("S02",), ("S03",)], "sitetret string")
    sites = M.compile_sites(ip="s01,S03")["ip"]
    assert sorted(r[0] for r in M.filter_sites(df, sites).collect()) == ["S01", "S03"]
    assert M.filter_sites(df, ["ALL"]).count() == 3


def test_run_row_counts(spark):
    base = spark.createDataFrame([(1,), (2,)], "rn long")
    runs = spark.createDataFrame([(1, 1), (2, 1), (1, 2)], "rn long, model_run int")
    got = {r["model_run"]: r["ok"] for r in M.run_row_counts(base, runs).collect()}
    assert got == {1: True, 2: False}


def test_rows_join_on_dataset_and_year(spark):
    base = spark.createDataFrame(
        [(1, d, y, "S1", 30, "ip_elective_admission", "t", 1, 3, "1", "a") for d, y in (("A", 2023), ("B", 2024))],
        "rn long, dataset string, fyear int, sitetret string, age int, pod string, tretspef string, has_procedure int,"
        " speldur int, classpat string, age_group string")
    runs = spark.createDataFrame([(1, "A", 2023, 1, 5, "1")],
                                 "rn long, dataset string, fyear int, model_run int, speldur int, classpat string")
    got = M.ip_run_rows(base, runs).collect()
    assert [(r["dataset"], r["speldur"]) for r in got] == [("A", 5)]
    assert M.duplicate_rows(base).count() == 0 and M.duplicate_rows(base.drop("dataset", "fyear")).count() == 1


def test_run_row_counts_reports_missing_runs(spark):
    base = spark.createDataFrame([(1,), (2,)], "rn long")
    runs = spark.createDataFrame([(1, 1), (2, 1), (1, 3)], "rn long, model_run int")
    got = {r["model_run"]: (r["run_rows"], r["ok"]) for r in M.run_row_counts(base, runs, n_runs=3).collect()}
    assert got == {1: (2, True), 2: (0, False), 3: (1, False)}


def test_null_sums_of_op_cells_are_zero(spark):
    rows = spark.createDataFrame([("S", None, None)], "sitetret string, attendances int, tele_attendances int")
    got = {r["measure"]: r["value"] for r in M.op_cell_values(rows, ["sitetret"], run=None).collect()}
    assert got == {"attendances": 0, "tele_attendances": 0}


def _op_checked(spark, drop=None, extra=None):
    base = spark.createDataFrame(
        [(1, "A", "S1", "ag", 3, "t", "op_first", 5, 1), (2, "A", None, "ag", 4, "t", "op_first", 2, 0),
         (1, "B", "S1", "ag", 5, "t", None, 7, 2)],
        "rn long, dataset string, sitetret string, age_group string, age int, tretspef string, pod string,"
        " attendances int, tele_attendances int").withColumns({"is_first": F.lit(True), "has_procedures": F.lit(False)})
    runs = [(r, d, n, 10 * r, r) for r in (1, 2) for d, n in (("A", 1), ("A", 2), ("B", 1)) if (r, d, n) != drop]
    runs = spark.createDataFrame(runs + (extra or []), "model_run int, dataset string, rn long, attendances int, tele_attendances int")
    return base, runs


def test_checked_product_equals_the_plain_one_and_reads_runs_once(spark, tmp_path):
    base, runs = _op_checked(spark)
    runs.write.parquet(f"{tmp_path}/runs")
    runs = spark.read.parquet(f"{tmp_path}/runs")
    got = P.detailed_op_checked(base, runs, None, STANDARD, n_runs=2)
    want = P.detailed_op(base, runs, None, STANDARD, n_runs=2)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


@pytest.mark.parametrize("case", [
    {"drop": (2, "A", 2)},                                        # a short run
    {"extra": [(1, "B", 1, 4, 4)]},                               # a row twice
    {"extra": [(1, "A", 9, 4, 4)]},                               # a row that the baseline lacks
    {"extra": [(3, "A", 1, 1, 1), (3, "A", 2, 1, 1), (3, "B", 1, 1, 1)]},  # a run beyond
])
def test_checked_product_raises_on_other_row_counts(spark, case):
    base, runs = _op_checked(spark, **case)
    with pytest.raises(Exception, match="runs do not hold"):
        P.detailed_op_checked(base, runs, None, STANDARD, n_runs=2).collect()


def test_checked_product_raises_on_a_missing_run(spark):
    base, runs = _op_checked(spark)
    with pytest.raises(Exception, match="runs do not hold"):
        P.detailed_op_checked(base, runs.where("model_run = 1"), None, STANDARD, n_runs=2).collect()
