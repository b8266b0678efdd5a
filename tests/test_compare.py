import math

from mcrunstat.operators import compare as K


def test_compare_results_edge_cases(spark):
    old = spark.createDataFrame([("D", "a", "m", 1.0, 10.0), ("D", "z", "m", 0.0, 0.0), ("D", "n", "m", 1.0, 0.0),
                                 ("D", "gone", "m", 1.0, 5.0)],
                                "dataset string, pod string, measure string, baseline double, mean double")
    new = spark.createDataFrame([("D", "a", "m", 1.0, 12.0), ("D", "z", "m", 0.0, 0.0), ("D", "n", "m", 1.0, 3.0),
                                 ("D", "new", "m", 1.0, 5.0)],
                                "dataset string, pod string, measure string, baseline double, mean double")
    got = {r["pod"]: (r["pct_diff"], r["status"]) for r in K.compare_results(old, new).collect()}
    assert math.isclose(got["a"][0], 20.0)
    assert got["z"][0] == 0.0 and math.isinf(got["n"][0])
    assert got["gone"] == (0.0, "only_old") and got["new"] == (0.0, "only_new")  # D16


def test_compare_stepcounts_gone_is_100_new_is_inf(spark):
    cols = "dataset string, activity_type string, pod string, change_factor string, strategy string, measure string, value double"
    old = spark.createDataFrame([("D", "ip", "p", "c", "s1", "m", 2.0), ("D", "ip", "p", "c", "s1", "m", 4.0),
                                 ("D", "ip", "p", "c", "gone", "m", 4.0)], cols)
    new = spark.createDataFrame([("D", "ip", "p", "c", "s1", "m", 6.0), ("D", "ip", "p", "c", "new", "m", 1.0)], cols)
    got = {r["strategy"]: r for r in K.compare_stepcounts(old, new).collect()}
    assert got["s1"]["mean_old"] == 3.0 and math.isclose(got["s1"]["pct_diff"], 100.0)
    assert got["gone"]["pct_diff"] == 100.0 and math.isinf(got["new"]["pct_diff"])


def test_compare_default_half_even_and_suffixes(spark):
    a = spark.createDataFrame([("D", "p", "s", "m", 3.0, 2.0, "x")],
                              "dataset string, pod string, sitetret string, measure string, baseline double, mean double, scenario string")
    b = spark.createDataFrame([("D", "p", "s", "m", 0.0, 0.0, "y")],
                              "dataset string, pod string, sitetret string, measure string, baseline double, mean double, scenario string")
    out = K.compare_default(a, b, ("x", "y"))
    assert out.columns == sorted(out.columns)
    r = out.collect()[0]
    assert r["pct_diff_x"] == 0.5 and r["pct_diff_y"] == 0.0


def test_reconcile_rules(spark):
    det = spark.createDataFrame([("beddays", 10.26), ("beddays", 5.26)], "measure string, mean double")
    dft = spark.createDataFrame([("beddays", 15.9)], "measure string, mean double")
    r = K.reconcile(det, dft, ["beddays"], rule="trunc").collect()[0]
    assert (r["default"], r["detailed"], r["ok"]) == (15.0, 15.0, True)
    r1 = K.reconcile(det, dft, ["beddays"], rule="round1").collect()[0]
    assert r1["detailed"] == 15.0


def test_release_check_flags(spark):
    dev = spark.createDataFrame([("D", "a", 3), ("D", "b", 1)], "dataset string, pod string, n long")
    rel = spark.createDataFrame([("D", "a", 3), ("D", "c", 2)], "dataset string, pod string, n long")
    got = {r["pod"]: r for r in K.release_check(dev, rel, ["dataset", "pod"], ["n"]).collect()}
    assert got["a"]["all_equal"] and not got["b"]["all_equal"]
    assert (got["c"]["dev_n"], got["c"]["release_n"]) == (0, 2)


def test_compare_default_keeps_null_key_cells(spark):
    from mcrunstat.operators.compare import compare_default

    rows = [("D", None, "S", "m", 2.0, 4.0), ("D", "p", "S", "m", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "dataset string, pod string, sitetret string, measure string, baseline double, mean double")
    got = compare_default(df, df, ("a", "b"))
    assert got.count() == 2 and got.where("pod is null").count() == 1


def test_reconcile_op_reports_a_total_off_by_two(spark, monkeypatch):
    from mcrunstat.plans import queries as Q
    from tests.conftest import SF_SMALL

    plain = Q._fx

    def off_by_two(spark, sf):
        fx = plain(spark, sf)
        more = spark.createDataFrame([("op", "D1", "x", "x", "attendances", 2.0)], fx["default_means"].schema)
        means = fx["default_means"].unionByName(more)
        return type("Changed", (), {"__getitem__": lambda self, name: means if name == "default_means" else fx[name]})()

    ok = {r.measure: (r.diff, r.ok) for r in Q.REGISTRY["reconcile_op"](spark, SF_SMALL).where("pair = 'match'").collect()}
    assert ok["attendances"] == (0.0, True)
    monkeypatch.setattr(Q, "_fx", off_by_two)
    off = {r.measure: (r.diff, r.ok) for r in Q.REGISTRY["reconcile_op"](spark, SF_SMALL).where("pair = 'match'").collect()}
    assert off["attendances"] == (-2.0, False) and off["tele_attendances"] == ok["tele_attendances"]
