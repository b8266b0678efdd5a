from pyspark.sql import functions as F

from mcrunstat.sources import catalog as G

ROOT = "full-model-results/v4.1/RAA/winter/20250301_080000"


def _listing(*tails):
    return [f"{ROOT}/{t}" for t in tails]


def test_completeness_cases(spark):
    lists = {
        "all three runs": _listing(*[f"ip/model_run={k}/0.parquet" for k in (1, 2, 3)]),
        "one of three": _listing("ip/model_run=2/0.parquet", "notes.txt"),
        "names only": ["summary.json", "totals.csv"],
        "folders without runs": _listing("ip/totals.csv", "op/extra/log.txt"),
        "runs without parquet": _listing("ip/model_run=1/rows.csv", "ip/model_run=2/_SUCCESS"),
        "parquet of other names": _listing("ip/model_run=1/part-0.parquet", "ip/model_run=2/10.parquet.crc"),
    }
    rows = [(k, p) for k, ps in lists.items() for p in ps]
    listing = spark.createDataFrame(rows, "listing string, path string")
    expected = spark.createDataFrame([(k,) for k in [*lists, "nothing"]], "listing string")
    out = G.run_completeness(listing, group_col="listing", expected=expected, n_runs=3)
    got = {r["prefix"]: (r["is_full_results"], r["status"], r["all_runs_present"]) for r in out.collect()}
    assert got == {
        "all three runs": (True, "ok", True), "one of three": (True, "ok", False),
        "names only": (False, "flat", False), "nothing": (False, "flat", False),
        "folders without runs": (False, "no_model_run_dirs", False),
        "runs without parquet": (False, "no_parquet_in_model_run", False),
        "parquet of other names": (False, "no_parquet_in_model_run", False)}


def test_completeness_of_many_scenarios(spark):
    paths = [f"full-model-results/v4.1/{d}/s{k}/20250301_080000/ip/model_run={r}/0.parquet"
             for d in ("RAA", "RBB") for k in (1, 2) for r in range(1, 4) if (d, k, r) != ("RBB", 2, 3)]
    out = G.run_completeness(spark.createDataFrame([(p,) for p in paths], "path string"), n_runs=3)
    got = {r["prefix"].split("/")[2:4][0] + r["prefix"].split("/")[3]: r["all_runs_present"] for r in out.collect()}
    assert got == {"RAAs1": True, "RAAs2": True, "RBBs1": True, "RBBs2": False}


def test_parse_paths(spark):
    df = spark.createDataFrame([("aggregated-model-results/v3.5/RXX/test/20250610_112654/",),
                                ("aggregated-model-results/v3.5/RXX/test",),
                                ("other-root/v3.5/RXX/test/20250610_112654",),
                                ("aggregated-model-results/v3.5/RXX/test/latest",)], "path string")
    got = [r.asDict() for r in G.parse_paths(df).collect()]
    assert got[0]["valid"] and (got[0]["version"], got[0]["dataset"], got[0]["scenario"]) == ("v3.5", "RXX", "test")
    assert got[0]["run_datetime"] == "20250610_112654"
    assert got[0]["full_path"] == "full-model-results/v3.5/RXX/test/20250610_112654"
    assert not got[1]["valid"] and not got[2]["valid"]
    assert got[3]["valid"] and got[3]["run_datetime"] is None


def test_resolve_versions(spark):
    versions = spark.createDataFrame([(v,) for v in ["v3.0.0", "v3.0.2", "v3.1.0", "v3.9.1", "v3.10.0",
                                                     "v4.0.1", "dev", "v3.1", "vnext.0.1"]], "version string")
    req = spark.createDataFrame([(r,) for r in ["v3.0", "v3.2", "v3.10", "v2.0", "dev", "v5.1", "v3"]], "requested string")
    got = {r["requested"]: r["resolved"] for r in G.resolve_versions(versions, req).collect()}
    assert got == {"v3.0": "v3.0.2", "v3.2": "v3.1.0", "v3.10": "v3.10.0", "v2.0": "N/A",
                   "dev": "N/A", "v5.1": "v4.0.1", "v3": "v3.10.0"}
    assert G.latest_version(versions).collect()[0][0] == "v4.0.1"  # numeric, not text (D6)
    s = versions.select(G.simplify_version(F.col("version"))).collect()
    assert s[0][0] == "v3.0" and s[6][0] == "dev"


def test_params_upgrade(spark):
    docs = spark.createDataFrame([('{"scenario": "s", "seed": 1, "non-demographic_adjustment": {"a": [1.0, 2.0]}}',)],
                                 "json string")
    p = G.upgrade_ndg(G.parse_params(docs)).collect()[0]
    ndg = p["non-demographic_adjustment"]
    assert ndg["variant"] == "ndg-test" and ndg["value-type"] == "year-on-year-growth"
    assert list(ndg["values"]["a"]) == [1.0, 2.0]


def test_params_keep_the_whole_document(spark):
    new = '{"scenario": "s", "other": {"deep": [1]}, "non-demographic_adjustment": ' \
          '{"variant": "own", "value-type": "x", "values": {"a": [1.5]}}}'
    docs = spark.createDataFrame([(new,), (None,), ("{}",)], "json string")
    got = G.upgrade_ndg(G.parse_params(docs)).collect()
    ndg = got[0]["non-demographic_adjustment"]
    assert (ndg["variant"], ndg["value-type"], ndg["values"]) == ("own", "x", {"a": [1.5]})
    assert got[0]["document"] == new and len(got) == 3


def test_versions_with_a_suffix(spark):
    versions = spark.createDataFrame([("v3.1.0-beta",), ("v2.0.1",), ("v3.1",)], "version string")
    req = spark.createDataFrame([("v3.1",), ("v2",), (None,)], "requested string")
    assert {r["requested"]: r["resolved"] for r in G.resolve_versions(versions, req).collect()} == {
        "v3.1": "v3.1.0-beta", "v2": "v2.0.1", None: "N/A"}
