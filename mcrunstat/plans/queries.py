"""Registered queries: one per operator key of the coverage checklist.

Each takes (spark, sf_dir), stands the domain tables up on the driver's tables
(``sources.fixtures``) and returns a lazy DataFrame over the whole tables.
Double columns that come from order-dependent floating sums are rounded to
``ROUND`` places so the Spark and DuckDB answers compare exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bands as B
from ..operators import cohorts as C
from ..operators import compare as K
from ..operators import measures as M
from ..operators.montecarlo import collect_runs, run_summary
from ..operators.suppress import suppress_small_counts
from ..schema import HRG, STANDARD, IP_BASELINE_COLUMNS, IP_RUN_COLUMNS
from ..session import ensure_checkpoint_dir
from ..sources import catalog as G
from ..sources import scan as S
from ..sources.fixtures import Fixtures
from ..sources.sink import write_results
from . import products as P

ROUND = 6
N_OTHER = 16          # runs in the op/aae fixtures
NATIONAL_YEARS = (1995, 1996)
NATIONAL_SEED = 7
SAMPLE_FRACTION = 0.01
SITES_ARG = "s00,S03"  # F1 argument as a user types it
SCENARIO = "scn-ip_elective_admission"
SITES = {"ip": "s00,S03", "op": "S01", "aae": "all"}

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, places: int = ROUND) -> DataFrame:
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), places).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def _fx(spark, sf_dir) -> Fixtures:
    return Fixtures(spark, sf_dir)


# ----------------------------------------------------------------- sources
@query("scan_baseline")
def q_scan_baseline(spark, sf):
    fx = _fx(spark, sf)
    return S.scan_baseline(fx["ip_baseline"], columns=["dataset", "fyear", *IP_BASELINE_COLUMNS])


@query("scan_runs")
def q_scan_runs(spark, sf):
    return S.scan_runs(_fx(spark, sf)["ip_runs"], columns=list(IP_RUN_COLUMNS))


@query("list_datasets")
def q_list_datasets(spark, sf):
    return S.list_datasets(_fx(spark, sf)["ip_baseline"])


@query("resolve_version")
def q_resolve_version(spark, sf):
    v = _fx(spark, sf)["data_versions"]
    requests = v.select(G.simplify_version(F.col("version")).alias("requested")).distinct()
    out = G.resolve_versions(v, requests)
    return out.withColumn("latest", G.latest_version(v).scalar())


@query("parse_paths")
def q_parse_paths(spark, sf):
    paths = _fx(spark, sf)["file_paths"]
    return G.parse_paths(paths.select(G.to_aggregated_path(F.col("path")).alias("path")))


@query("run_completeness")
def q_run_completeness(spark, sf):
    return G.run_completeness(_fx(spark, sf)["file_paths"], n_runs=256)


@query("params_catalog")
def q_params_catalog(spark, sf):
    p = G.upgrade_ndg(G.parse_params(_fx(spark, sf)["params_json"]))
    ndg = F.col("`non-demographic_adjustment`")
    flat = p.select("scenario", "dataset", "app_version", "start_year", "create_datetime", "seed",
                    F.get_json_object("document", "$.extra").alias("extra"), ndg["variant"].alias("ndg_variant"), ndg["value-type"].alias("ndg_value_type"),
                    F.explode(ndg["values"]).alias("ndg_key", "_vals"))
    return flat.select("*", F.posexplode("_vals").alias("ndg_pos", "ndg_value")).drop("_vals")


@query("sink_roundtrip")
def q_sink_roundtrip(spark, sf):
    fx = _fx(spark, sf)
    res = P.detailed_ip(fx["ip_baseline"], fx["ip_runs"], STANDARD)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sink-{uuid.uuid4().hex}/scn_detailed_ip_standard"
    write_results(res, base, sort_by=list(STANDARD.ip_cols) + ["measure"])
    # A second call finds both outputs and skips the work.
    assert write_results(res, base) is False
    return spark.read.parquet(f"{base}.parquet")


# ---------------------------------------------------------- filters, bands
@query("filter_sites")
def q_filter_sites(spark, sf):
    sites = M.compile_sites(ip=SITES_ARG)["ip"]
    return M.filter_sites(_fx(spark, sf)["ip_baseline"], sites).select("rn", "dataset", "sitetret")


@query("bands")
def q_bands(spark, sf):
    b = _fx(spark, sf)["ip_baseline"]
    return b.select("rn", B.los_detailed("speldur").alias("los_detailed"),
                    B.los_avoided("speldur").alias("los_avoided"),
                    B.los_custom("speldur").alias("los_custom"),
                    B.los_national("speldur").alias("los_national"),
                    B.age_custom("age").alias("age_custom"), B.age_cut("age").alias("age_cut"))


@query("op_pod")
def q_op_pod(spark, sf):
    return M.add_op_pod(_fx(spark, sf)["op_baseline"]).select("rn", "pod")


# ---------------------------------------------------------- detailed results
@query("run_summary")
def q_run_summary(spark, sf):
    d = _fx(spark, sf)["default_old"].where(F.col("model_run") > 0)
    return run_summary(d, ["dataset", "pod", "sitetret", "measure"], n_runs=256)


def _detailed_ip(config):
    def q(spark, sf):
        fx = _fx(spark, sf)
        return P.detailed_ip(fx["ip_baseline"], fx["ip_runs"], config)
    return q


def _detailed_op(config):
    def q(spark, sf):
        fx = _fx(spark, sf)
        return P.detailed_op(M.add_op_pod(fx["op_baseline"]), fx["op_runs"], fx["op_conversion"],
                             config, N_OTHER)
    return q


def _detailed_aae(config):
    def q(spark, sf):
        fx = _fx(spark, sf)
        return P.detailed_aae(fx["aae_baseline"], fx["aae_runs"], fx["sdec_conversion"], config, N_OTHER)
    return q


REGISTRY["detailed_ip_standard"] = _detailed_ip(STANDARD)
REGISTRY["detailed_ip_hrg"] = _detailed_ip(HRG)
REGISTRY["detailed_op_standard"] = _detailed_op(STANDARD)
REGISTRY["detailed_op_hrg"] = _detailed_op(HRG)
REGISTRY["detailed_aae_standard"] = _detailed_aae(STANDARD)
REGISTRY["detailed_aae_hrg"] = _detailed_aae(HRG)


@query("detailed_op_checked")
def q_detailed_op_checked(spark, sf):
    fx = _fx(spark, sf)
    return P.detailed_op_checked(M.add_op_pod(fx["op_baseline"]), fx["op_runs"], fx["op_conversion"], STANDARD, N_OTHER)


@query("detailed_aae_checked")
def q_detailed_aae_checked(spark, sf):
    fx = _fx(spark, sf)
    return P.detailed_aae_checked(fx["aae_baseline"], fx["aae_runs"], fx["sdec_conversion"], STANDARD, N_OTHER)


@query("run_row_counts")
def q_run_row_counts(spark, sf):
    fx = _fx(spark, sf)
    return M.run_row_counts(fx["op_baseline"], fx["op_runs"], n_runs=N_OTHER)


@query("run_row_counts_aae")
def q_run_row_counts_aae(spark, sf):
    fx = _fx(spark, sf)
    return M.run_row_counts(fx["aae_baseline"], fx["aae_runs"], n_runs=N_OTHER)


@query("activity_avoided")
def q_activity_avoided(spark, sf):
    fx = _fx(spark, sf)
    return P.activity_avoided(fx["ip_baseline"], fx["ip_avoided"])


@query("attach_baseline_ip")
def q_attach_ip(spark, sf):
    fx = _fx(spark, sf)
    return P.attach_baseline_ip(fx["ip_baseline"], fx["ip_runs"], HRG)


@query("attach_baseline_op")
def q_attach_op(spark, sf):
    fx = _fx(spark, sf)
    return P.attach_baseline_op(M.add_op_pod(fx["op_baseline"]), fx["op_runs"], fx["op_conversion"],
                                HRG, N_OTHER)


@query("attach_baseline_aae")
def q_attach_aae(spark, sf):
    fx = _fx(spark, sf)
    return P.attach_baseline_aae(fx["aae_baseline"], fx["aae_runs"], fx["sdec_conversion"], HRG, N_OTHER)


@query("pipeline_hrg_baseline")
def q_pipeline(spark, sf):
    fx = _fx(spark, sf)
    return P.pipeline_hrg_baseline(fx, fx["file_paths"], SCENARIO)


@query("pipeline_standard")
def q_pipeline_standard(spark, sf):
    fx = _fx(spark, sf)
    return P.pipeline_standard(fx, fx["file_paths"], SCENARIO)


@query("custom_baseline_sites")
def q_custom_sites(spark, sf):
    fx = _fx(spark, sf)
    return P.custom_baselines(fx["ip_baseline"], fx["op_baseline"], fx["aae_baseline"], M.compile_sites(**SITES))


# ------------------------------------------------------------ run lists
@query("collect_runs")
def q_collect_runs(spark, sf):
    d = collect_runs(_fx(spark, sf)["default_old"])
    return d.withColumn("model_runs", F.array_join("model_runs", ","))


@query("collect_runs_no_baseline")
def q_collect_runs_nb(spark, sf):
    d = collect_runs(_fx(spark, sf)["default_old"], include_baseline=False)
    return d.withColumn("model_runs", F.array_join("model_runs", ","))


def _reconcile(kind, measures, rule, tolerance):
    """C4: the detailed totals against aggregated results of the same cells, and against a
    broken table that lacks one dataset."""
    def q(spark, sf):
        fx = _fx(spark, sf)
        det = REGISTRY[f"detailed_{kind}_standard"](spark, sf)
        dft = fx["default_means"].where(F.col("activity") == kind)
        out = [K.reconcile(det, d, measures, rule, tolerance).withColumn("pair", F.lit(pair))
               for pair, d in (("match", dft), ("broken", dft.where("dataset <> 'D0'")))]
        return rounded(out[0].unionByName(out[1]))
    return q


# the reference's tolerance of 1 for all: where the rounding of many cells adds up to more, the key says not ok
REGISTRY["reconcile"] = _reconcile("ip", ["beddays", "admissions"], "trunc", 1.0)
REGISTRY["reconcile_op"] = _reconcile("op", ["attendances", "tele_attendances"], "round1", 1.0)
REGISTRY["reconcile_aae"] = _reconcile("aae", ["ambulance", "walk-in"], "round0", 1.0)


# ------------------------------------------------------------ baselines
@query("baseline_ip")
def q_baseline_ip(spark, sf):
    return C.detailed_baseline_ip(_fx(spark, sf)["ip_baseline"])


@query("baseline_op")
def q_baseline_op(spark, sf):
    return C.detailed_baseline_op(_fx(spark, sf)["op_baseline"])


@query("baseline_aae")
def q_baseline_aae(spark, sf):
    return C.detailed_baseline_aae(_fx(spark, sf)["aae_baseline"])


@query("custom_baseline_ip")
def q_custom_ip(spark, sf):
    return P.custom_baseline_ip(_fx(spark, sf)["ip_baseline"])


@query("custom_baseline_op")
def q_custom_op(spark, sf):
    return P.custom_baseline_op(_fx(spark, sf)["op_baseline"])


@query("custom_baseline_aae")
def q_custom_aae(spark, sf):
    return P.custom_baseline_aae(_fx(spark, sf)["aae_baseline"])


@query("suppress_small_counts")
def q_suppress(spark, sf):
    b = _fx(spark, sf)["ip_baseline"]
    cells = C.detailed_baseline_ip(b, keys=("dataset", "sitetret", "pod", "tretspef", "sushrg")) \
        .select("dataset", "sitetret", "pod", "tretspef", "sushrg", F.col("admissions").alias("value"))
    return suppress_small_counts(cells, ["dataset", "sitetret", "pod", "tretspef", "sushrg"],
                                 ["dataset", "pod"])


# ------------------------------------------------------------ national
def _sample(fx, fraction):
    return P.national_sample(fx["ip_baseline"], fraction=fraction, seed=NATIONAL_SEED)


@query("national_baseline")
def q_national_baseline(spark, sf):
    return P.national_baseline(_sample(_fx(spark, sf), 1.0))


@query("sample_rows")
def q_sample_rows(spark, sf):
    """the seeded sample itself; sampling is the feature here."""
    return P.hash_sample(_fx(spark, sf)["ip_baseline"], SAMPLE_FRACTION, NATIONAL_SEED).select("rn", "dataset", "fyear")


@query("national_results")
def q_national_results(spark, sf):
    fx = _fx(spark, sf)
    return rounded(P.national_results(_sample(fx, 1.0), fx["ip_runs"]))


@query("national_avoided")
def q_national_avoided(spark, sf):
    fx = _fx(spark, sf)
    return rounded(P.national_avoided(_sample(fx, 1.0), fx["ip_avoided"]))


@query("fill_missing_groups")
def q_fill_missing(spark, sf):
    fx = _fx(spark, sf)
    return P.national_filled(_sample(fx, 1.0), fx["ip_runs"])


@query("national_reconcile")
def q_national_reconcile(spark, sf):
    fx = _fx(spark, sf)
    nat = P.national_results(_sample(fx, 1.0), fx["ip_runs"]).where(F.col("pod").startswith("ip_"))
    nat_long = nat.select(F.lit("admissions").alias("measure"), F.col("mean_admissions").alias("mean")) \
        .unionByName(nat.select(F.lit("beddays").alias("measure"), F.col("mean_beddays").alias("mean")))
    dft = collect_runs(fx["default_old"]).where(F.col("pod").startswith("ip_"))
    return rounded(K.reconcile(nat_long, dft, ["admissions", "beddays"], rule="exact", tolerance=1e-6))


@query("national_reconcile_years")
def q_national_reconcile_years(spark, sf):
    """C5 per year over equal populations: the national product of two years against the
    aggregated results of the same rows and pods, and against those of the other year."""
    fx = _fx(spark, sf)
    by_year = None
    for year in NATIONAL_YEARS:
        sample = P.national_sample(fx["ip_baseline"], seed=NATIONAL_SEED, fyear=year)
        nat = P.national_results(sample, fx["ip_runs"]).where(F.col("pod").startswith("ip_"))
        nat = nat.select(F.lit(year).alias("fyear"), F.inline(F.array(*[
            F.struct(F.lit(m).alias("measure"), F.col(f"mean_{m}").alias("mean")) for m in ("admissions", "beddays")])))
        by_year = nat if by_year is None else by_year.unionByName(nat)
    default = fx["default_means_national"].where(F.col("pod").startswith("ip_") & F.col("fyear").isin(*NATIONAL_YEARS))
    pairs = F.explode(F.array(F.lit("match"), F.lit("other_year")))
    default = default.withColumn("pair", pairs).withColumn("fyear", F.when(
        F.col("pair") == "match", F.col("fyear")).otherwise(F.lit(sum(NATIONAL_YEARS)) - F.col("fyear")))
    found = K.reconcile_cells(by_year.withColumn("pair", pairs), default, ["admissions", "beddays"],
                              by=("pair", "fyear"), tolerance=1e-6)
    return rounded(found.select("pair", "fyear", "measure", *[
        F.col(c).cast("double").alias(c) for c in ("default", "detailed", "diff")], "ok"))


# ------------------------------------------------------------ cohorts
@query("mitigators_op")
def q_mit_op(spark, sf):
    return C.op_mitigators(_fx(spark, sf)["op_baseline"], ("dataset", "type"))


@query("mitigators_op_site")
def q_mit_op_site(spark, sf):
    return C.op_mitigators(_fx(spark, sf)["op_baseline"], ("dataset", "sitetret", "type"), site_form=True)


@query("mitigators_aae")
def q_mit_aae(spark, sf):
    return C.aae_mitigators(_fx(spark, sf)["aae_baseline"], ("dataset", "hsagrp"))


@query("mitigators_aae_site")
def q_mit_aae_site(spark, sf):
    return C.aae_mitigators(_fx(spark, sf)["aae_baseline"], ("dataset", "sitetret", "hsagrp"))


@query("strategy_efficiencies")
def q_strat_eff(spark, sf):
    fx = _fx(spark, sf)
    return C.strategy_efficiencies(fx["strategies"].where(F.col("kind") == "ef"), fx["ip_baseline"])


@query("strategy_avoidance")
def q_strat_aa(spark, sf):
    fx = _fx(spark, sf)
    return rounded(C.strategy_avoidance(fx["strategies"].where(F.col("kind") == "aa"), fx["ip_baseline"]))


# Years of one table are kept apart by default wherever it has them.
REGISTRY["baseline_op_years"] = lambda spark, sf: C.detailed_baseline_op(_fx(spark, sf)["op_years"])
REGISTRY["baseline_aae_years"] = lambda spark, sf: C.detailed_baseline_aae(_fx(spark, sf)["aae_years"])
REGISTRY["mitigators_op_years"] = lambda spark, sf: C.op_mitigators(_fx(spark, sf)["op_years"])
REGISTRY["mitigators_op_site_years"] = lambda spark, sf: C.op_mitigators(_fx(spark, sf)["op_years"], site_form=True)
REGISTRY["mitigators_aae_years"] = lambda spark, sf: C.aae_mitigators(_fx(spark, sf)["aae_years"])
REGISTRY["mitigators_aae_site_years"] = lambda spark, sf: C.aae_mitigators(_fx(spark, sf)["aae_years"], site_form=True)


@query("custom_baseline_years")
def q_custom_years(spark, sf):
    fx = _fx(spark, sf)
    return P.custom_baselines(fx["ip_baseline"], fx["op_years"], fx["aae_years"])


# ------------------------------------------------------------ comparisons
@query("compare_results")
def q_compare_results(spark, sf):
    fx = _fx(spark, sf)
    return rounded(K.compare_results(collect_runs(fx["default_old"]), collect_runs(fx["default_new"])))


@query("compare_stepcounts")
def q_compare_stepcounts(spark, sf):
    fx = _fx(spark, sf)
    return rounded(K.compare_stepcounts(fx["step_counts_old"], fx["step_counts_new"]))


@query("compare_default")
def q_compare_default(spark, sf):
    fx = _fx(spark, sf)
    a = collect_runs(fx["default_old"])
    b = collect_runs(fx["default_new"])
    return rounded(K.compare_default(a, b, ("scn", "scn_testdev")))


@query("compare_default_rowwise")
def q_compare_default_rowwise(spark, sf):
    fx = _fx(spark, sf)
    return rounded(K.compare_default_rowwise(collect_runs(fx["default_old"])))


def _release(kind):
    def q(spark, sf):
        fx = _fx(spark, sf)
        if kind == "ip":
            dev, rel = C.ip_pod_totals(fx["ip_baseline"]), C.ip_pod_totals(fx["ip_baseline_release"])
            cols = ["admissions", "beddays"]
            keys = ["dataset", "pod"]
        elif kind == "op":
            dev = C.op_pod_totals(M.add_op_pod(fx["op_baseline"]))
            rel = C.op_pod_totals(M.add_op_pod(fx["op_baseline_release"]))
            cols, keys = ["attendances", "tele_attendances"], ["dataset", "pod"]
        else:
            dev, rel = C.aae_pod_totals(fx["aae_baseline"]), C.aae_pod_totals(fx["aae_baseline_release"])
            cols, keys = ["arrivals"], ["dataset", "pod", "grp"]
        return K.release_check(dev, rel, keys, cols)
    return q


REGISTRY["release_check_ip"] = _release("ip")
REGISTRY["release_check_op"] = _release("op")
REGISTRY["release_check_aae"] = _release("aae")


def _release_mitigators(mitigators, view, keys):
    def q(spark, sf):
        fx = _fx(spark, sf)
        dev, rel = mitigators(fx[view], keys), mitigators(fx[f"{view}_release"], keys)
        return K.release_check(dev, rel, list(keys), [c for c in dev.columns if c not in keys])
    return q


REGISTRY["release_check_op_mitigators"] = _release_mitigators(C.op_mitigators, "op_baseline", ("dataset", "type"))
REGISTRY["release_check_aae_mitigators"] = _release_mitigators(C.aae_mitigators, "aae_baseline", ("dataset", "hsagrp"))


@query("release_verdict")
def q_release_verdict(spark, sf):
    """One verdict per value column over all rows of the three checks."""
    out = None
    for kind in ("ip", "op", "aae"):
        v = K.release_verdict(_release(kind)(spark, sf)).withColumn("activity", F.lit(kind))
        out = v if out is None else out.unionByName(v)
    return out


@query("release_check_mitigators")
def q_release_mit(spark, sf):
    fx = _fx(spark, sf)
    dev, rel = C.strategy_totals(fx["strategies"]), C.strategy_totals(fx["strategies_release"])
    out = K.release_check(dev, rel, ["kind", "strategy"], ["count", "sample_rate"],
                          fill_zero=False, prefix=False)
    out = out.withColumn("count_diff", F.col("count_dev") - F.col("count_release"))
    return rounded(out)


def queries() -> dict[str, Query]:
    from .stored import QUERIES  # queries over stored layouts and row keys that repeat

    return {**REGISTRY, **QUERIES}
