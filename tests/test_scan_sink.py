import os
import tempfile

from mcrunstat.sources import scan as S
from mcrunstat.sources.sink import write_results


def test_partition_pruning_exact_dataset(spark):
    root = tempfile.mkdtemp(prefix="scan-")
    df = spark.createDataFrame([(1, 2023, "RX", 1), (2, 2023, "RX1", 2), (3, 2024, "RX", 3)],
                               "rn long, fyear int, dataset string, speldur int")
    df.write.partitionBy("fyear", "dataset").parquet(f"{root}/v1.0.0/ip")
    out = S.scan_baseline(spark, root, "v1.0.0", "ip", dataset="RX", fyear=2023, columns=["rn", "speldur"])
    assert [r["rn"] for r in out.collect()] == [1]  # RX never matches RX1 (D8)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionFilters" in plan.lower()
    ds = S.list_datasets(S.scan_baseline(spark, root, "v1.0.0", "ip"))
    assert sorted((r["fyear"], r["dataset"]) for r in ds.collect()) == [(2023, "RX"), (2023, "RX1"), (2024, "RX")]


def test_scan_runs_partition_discovery(spark):
    root = tempfile.mkdtemp(prefix="runs-")
    df = spark.createDataFrame([(1, 1, 5), (2, 2, 6)], "rn long, model_run int, speldur int")
    df.write.partitionBy("model_run").parquet(f"{root}/ip")
    out = S.scan_runs(spark, root, "ip", runs=[2])
    assert [(r["rn"], r["model_run"]) for r in out.collect()] == [(2, 2)]


def test_write_results_skips_when_both_exist(spark):
    base = os.path.join(tempfile.mkdtemp(prefix="sink-"), "scn_detailed_ip_hrg")
    df = spark.createDataFrame([("b", 2.0), ("a", 1.0)], "k string, v double")
    assert write_results(df, base, sort_by=["k"]) is True
    assert write_results(df, base) is False
    back = spark.read.parquet(f"{base}.parquet")
    assert sorted(r["k"] for r in back.collect()) == ["a", "b"]
    assert spark.read.option("header", True).csv(f"{base}.csv").count() == 2


def test_bucketed_tables_join_without_shuffle(spark):
    from mcrunstat.operators.measures import ip_run_rows
    from mcrunstat.sources.sink import save_bucketed

    base = spark.createDataFrame(
        [(i, "S1", 30, "ip_elective_admission", "t", 1, 3, "1", "a") for i in range(40)],
        "rn long, sitetret string, age int, pod string, tretspef string, has_procedure int,"
        " speldur int, classpat string, age_group string")
    runs = spark.createDataFrame([(i % 40, r, 2, "1") for i in range(200) for r in (1, 2)],
                                 "rn long, model_run int, speldur int, classpat string")
    loc = tempfile.mkdtemp(prefix="bucketed-")
    tag = os.path.basename(loc).replace("-", "_")
    tb, tr = f"base_{tag}", f"runs_{tag}"
    save_bucketed(base, tb, 4, path=f"{loc}/base")
    save_bucketed(runs, tr, 4, path=f"{loc}/runs")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = ip_run_rows(spark.table(tb), spark.table(tr))
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_half_written_output_is_written_anew(spark):
    base = os.path.join(tempfile.mkdtemp(prefix="sink-"), "o")
    df = spark.createDataFrame([("b", 2.0), ("a", 1.0), ("c", 3.0)], "k string, v double")
    os.makedirs(f"{base}.parquet")  # a write that ended without _SUCCESS
    assert write_results(df, base, sort_by=["v"], descending=["v"]) is True
    assert spark.read.parquet(f"{base}.parquet").count() == 3
    lines = [x for f in sorted(os.listdir(f"{base}.csv")) if f.endswith(".csv")
             for x in open(f"{base}.csv/{f}").read().split()[1:]]
    assert lines == ["c,3.0", "b,2.0", "a,1.0"]
    os.remove(f"{base}.csv/_SUCCESS")
    assert write_results(df, base) is True and write_results(df, base) is False


def test_chosen_activities_and_formats(spark):
    import pytest

    from mcrunstat.sources.sink import write_activities

    root = tempfile.mkdtemp(prefix="acts-")
    df = spark.range(3)
    products = {"ip": df, "op": df}
    first = write_activities(products, root, "scn", "detailed", "hrg", ["op"], formats=["csv"])
    assert first == {"op": True} and os.listdir(root) == ["scn_detailed_op_hrg.csv"]
    both = write_activities(products, root, "scn", "detailed", "hrg", ["ip", "op"], formats=["csv"])
    assert both == {"ip": True, "op": False}
    with pytest.raises(ValueError):
        write_activities(products, root, "scn", "detailed", "hrg", ["aae"])


def test_checkpoint_folder_is_required_on_a_cluster():
    import pytest

    from mcrunstat.session import ensure_checkpoint_dir

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())
