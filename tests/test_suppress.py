from pyspark.sql import functions as F

from mcrunstat.operators.suppress import suppress_small_counts

KEYS = ["site", "age", "pod", "measure"]


def _df(spark, rows):
    return spark.createDataFrame(rows, "site string, age string, pod string, measure string, value long")


def test_threshold_edges_and_totals(spark):
    rows = [("A", "x", "p1", "m", 5), ("A", "y", "p1", "m", 4), ("B", "x", "p1", "m", 3),
            ("B", "y", "p2", "m", 100), ("C", "z", "p2", "m", 1), ("D", "z", "p2", "m", None)]
    out = suppress_small_counts(_df(spark, rows), KEYS, ["pod", "measure"])
    got = sorted((r["site"], r["age"], r["pod"], r["value"], r["is_grouped"]) for r in out.collect())
    assert got == [("A", "x", "p1", 5, False), ("B", "y", "p2", 100, False),
                   ("grouped", "grouped", "p1", 7, True), ("grouped", "grouped", "p2", 1, True)]
    # total of non-null values preserved (D15: null values drop out)
    assert out.agg(F.sum("value")).collect()[0][0] == 5 + 4 + 3 + 100 + 1


def test_no_small_cell_unchanged(spark):
    rows = [("A", "x", "p1", "m", 5), ("B", "y", "p2", "m", 9)]
    out = suppress_small_counts(_df(spark, rows), KEYS, ["pod"])
    assert sorted((r["site"], r["value"]) for r in out.collect()) == [("A", 5), ("B", 9)]
    assert out.where("is_grouped").count() == 0
