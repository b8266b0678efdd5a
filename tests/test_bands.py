from pyspark.sql import functions as F

from mcrunstat.functions import bands as B


def _map(spark, values, fn, typ="int"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_age_cut_edges_and_nulls(spark):
    ages = [None, -2, -1, 0, 1, 17, 18, 999, 1000]
    got = _map(spark, ages, B.age_cut)
    assert got == ["Unknown", "nan", "Unknown", "0", "1-17", "1-17", "18+", "18+", "nan"]


def test_age_cut_fractional(spark):
    assert _map(spark, [-0.5, 0.5, 17.9], B.age_cut, "double") == ["Unknown", "0", "1-17"]


def test_los_detailed_default_band(spark):
    vals = [None, -1, 0, 1, 2, 3, 4, 7, 8, 14, 15, 21, 22, 100]
    got = _map(spark, vals, B.los_detailed)
    assert got == ["22+ days", "22+ days", "0 days", "1 day", "2 days", "3 days", "4-7 days",
                   "4-7 days", "8-14 days", "8-14 days", "15-21 days", "15-21 days", "22+ days",
                   "22+ days"]


def test_dict_lookup_fractional_takes_default(spark):
    assert _map(spark, [4.5, 4.0], B.los_detailed, "double") == ["22+ days", "4-7 days"]


def test_custom_bands(spark):
    assert _map(spark, [None, 0, 9, 10, 17, 18, 64, 65], B.age_custom) == [
        "Adults >= 65", "Paeds < 10", "Paeds < 10", "Paeds 10-17", "Paeds 10-17",
        "Adults 18-64", "Adults 18-64", "Adults >= 65"]
    assert _map(spark, [0, 1, 6, 7, 14, 15, None], B.los_custom) == [
        "0 days", "1-6 days", "1-6 days", "7-14 days", "7-14 days", "15+ days", "15+ days"]
    assert _map(spark, [0, 1, None], B.los_avoided) == ["0 days", "1+ days", "1+ days"]


def test_los_national(spark):
    assert _map(spark, [None, -1, 0, 1, 2, 40], B.los_national) == [None, None, "0", "1", "2+", "2+"]
