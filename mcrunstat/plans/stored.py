"""Registered queries over stored layouts, parameter files, products kept up to date, and
row numbers that repeat between datasets.

Each writes what Spark derives from the driver's whole tables into a new folder of the shared
place, in the layout in question, and answers from there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cohorts as C
from ..operators import compare as K
from ..operators import measures as M
from ..operators.montecarlo import merge_states, run_state, summarise_state
from ..schema import STANDARD
from ..session import ensure_checkpoint_dir
from ..sources import catalog as G
from ..sources import layout as L
from ..sources import scan as S
from ..sources.fixtures import Fixtures
from ..sources.sink import advance_state, output_base, write_activities
from . import products as P

ROUND = 6
QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, ROUND).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _write_baselines(fx: Fixtures, root: str, version: str) -> None:
    """``{root}/{version}/{activity}/fyear=/dataset=``; years before 1995 were stored
    without ``has_procedure``."""
    year = (F.lit(2000) + F.col("rn") % 3).cast("int")
    ip = fx["ip_baseline"]
    path = f"{root}/{version}"
    L.write_partitioned(ip.where("fyear < 1995").drop("has_procedure"), f"{path}/ip", ["fyear", "dataset"])
    L.write_partitioned(ip.where("fyear >= 1995"), f"{path}/ip", ["fyear", "dataset"], mode="append")
    for activity in ("op", "aae"):
        L.write_partitioned(fx[f"{activity}_baseline"].withColumn("fyear", year), f"{path}/{activity}", ["fyear", "dataset"])


@query
def layout_baseline(spark, sf):
    """Whole activities from their folders, keys from the folder names, schemas merged."""
    root = _folder(spark, "layout")
    _write_baselines(Fixtures(spark, sf), root, "v4.0.1")
    out = None
    for activity, value, pod in (("ip", "speldur", "pod"), ("op", "attendances", "type"), ("aae", "arrivals", "pod")):
        df = L.scan_layout(spark, S.baseline_path(root, "v4.0.1", activity))
        done = F.col("has_procedure") if activity == "ip" else F.lit(None).cast("int")
        df = df.select(F.lit(activity).alias("activity"), "dataset", "fyear", "rn", "sitetret", "age", F.col(pod).alias("pod"), "grp",
                       done.alias("has_procedure"), F.col(value).cast("long").alias("value"))
        out = df if out is None else out.unionByName(df)
    return out


@query
def layout_runs(spark, sf):
    """Every run of an activity from ``model_run=`` folders in one read."""
    root = _folder(spark, "runs")
    L.write_partitioned(Fixtures(spark, sf)["ip_runs"], f"{root}/ip", ["model_run"])
    return S.scan_runs(spark, root, "ip", columns=["rn", "model_run", "speldur", "classpat"])


@query
def layout_datasets(spark, sf):
    """Datasets and years of every activity, from folder names alone."""
    root = _folder(spark, "layout")
    _write_baselines(Fixtures(spark, sf), root, "v4.0.1")
    out = None
    for activity in ("ip", "op", "aae"):
        df = S.list_datasets(L.scan_layout(spark, S.baseline_path(root, "v4.0.1", activity), merge_schema=False))
        df = df.select(F.lit(activity).alias("activity"), "fyear", "dataset")
        out = df if out is None else out.unionByName(df)
    return out


@query
def layout_release_check(spark, sf):
    """S7 + C7: two versions of an activity, each read as a whole folder, checked against each other."""
    fx, root = Fixtures(spark, sf), _folder(spark, "layout")
    for version, view in (("dev", "ip_baseline"), ("v4.1", "ip_baseline_release")):
        L.write_partitioned(fx[view], S.baseline_path(root, version, "ip"), ["fyear", "dataset"])
    dev, release = (C.ip_pod_totals(L.scan_layout(spark, S.baseline_path(root, v, "ip"))) for v in ("dev", "v4.1"))
    return K.release_check(dev, release, ["dataset", "pod"], ["admissions", "beddays"])


@query
def scan_baseline_flat(spark, sf):
    """S3: the older layout, one job over all years and datasets, keys from the file paths."""
    root = _folder(spark, "flat")
    L.write_flat(Fixtures(spark, sf)["ip_baseline"], root, "v3.2", "ip")
    return L.scan_baseline_flat(spark, root, "v3.2", "ip").select(
        "rn", "dataset", "fyear", "sitetret", "age", "pod", "grp", "tretspef", "sushrg", "speldur", "classpat")


@query
def listing_completeness(spark, sf):
    """S15 over the listing of real folders: which scenarios hold every run."""
    fx, root = Fixtures(spark, sf), _folder(spark, "results")
    runs = fx["ip_runs"].join(fx["ip_baseline"].select("rn", "dataset"), "rn")
    L.write_partitioned(runs, f"{root}/_staged", ["dataset", "model_run"])
    L.rename_folders(spark, f"{root}/_staged", 1, lambda d: f"{root}/full-model-results/v4.1/{d}/scn/20250101_100000/ip")
    files = L.list_files(spark, root).where(F.col("path").startswith(G.FULL_ROOT + "/"))
    found = G.run_completeness(files, n_runs=256, file_suffix=".parquet")
    return found.select("prefix", "status", "runs_with_parquet", "all_runs_present")


def _stored_params(spark, sf) -> DataFrame:
    root = _folder(spark, "params")
    L.write_params(G.parse_params(Fixtures(spark, sf)["params_json"]), root)
    return L.read_params_variant(spark, root)


def _fields(params: DataFrame, ndg) -> DataFrame:
    text = F.col("value")
    plain = F.when(text.startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), text, F.lit("}")), "$.v")).otherwise(text)
    return L.param_fields(params).withColumn("value", F.when(F.col("field") == G.NDG, ndg(text)).otherwise(plain))


@query
def params_fields(spark, sf):
    """Every field of every parameter file, without a schema."""
    return _fields(_stored_params(spark, sf), lambda text: F.get_json_object(text, "$.variant"))


@query
def params_upgraded(spark, sf):
    """Old documents upgraded, written back as one file a run, and read again."""
    root = _folder(spark, "params")
    L.write_params(L.upgrade_documents(_stored_params(spark, sf)), root)
    at = lambda path: (lambda text: F.get_json_object(text, path))
    return _fields(L.read_params_variant(spark, root), lambda text: F.concat_ws(
        "/", at("$.variant")(text), at("$.value-type")(text), at("$.values.elective[0]")(text).cast("double").cast("string")))


PRODUCT_KEYS = ["dataset", "fyear"]


@query
def product_refresh(spark, sf):
    """A product kept per dataset and year.  The datasets arrive one after another;
    each call computes only the partitions that are not complete."""
    baseline, root = Fixtures(spark, sf)["ip_baseline"], _folder(spark, "product")

    def build(todo):
        rows = baseline.join(todo, PRODUCT_KEYS, "left_semi")
        return rows.groupBy(*PRODUCT_KEYS, "pod").agg(F.sum(F.col("speldur") + 1).cast("long").alias("beddays"),
                                                      F.count(F.lit(1)).alias("admissions"))

    keys = baseline.select(*PRODUCT_KEYS).distinct()
    for upto in ("D0", "D1", "D9"):
        L.refresh(spark, root, keys.where(F.col("dataset") <= upto), PRODUCT_KEYS, build)
    return L.read_product(spark, root, PRODUCT_KEYS).select(*PRODUCT_KEYS, "pod", "beddays", "admissions")


@query
def results_written(spark, sf):
    """Custom baselines of chosen activities written in chosen formats, largest
    values first; a second call for all activities skips what is complete; each is read by name."""
    fx, root = Fixtures(spark, sf), _folder(spark, "written")
    products = {"ip": P.custom_baseline_ip(fx["ip_baseline"]), "op": P.custom_baseline_op(fx["op_baseline"]),
                "aae": P.custom_baseline_aae(fx["aae_baseline"])}
    order = {a: ["value", "dataset"] for a in products}
    names = (root, "scn", "custom", "standard")
    write_activities(products, *names, activities=("op",), formats=("csv", "parquet"), sort_by=order, descending=("value",))
    late = write_activities(products, *names, formats=("parquet",), sort_by=order, descending=("value",))
    out = {}
    for a in products:
        base = output_base(root, "scn", "custom", a, "standard")
        stored = S.read_parquet(spark, f"{base}.parquet")
        if not late[a]:  # complete before: its CSV must hold the same rows
            stored = spark.read.csv(f"{base}.csv", header=True, schema=stored.schema)
        out[a] = stored.withColumn("written_late", F.lit(late[a]))
    return P._stacked(out)


@query
def runs_in_batches(spark, sf):
    """A5 as runs arrive: 256 runs in 9 batches, each joined to the stored state."""
    cells = ["dataset", "pod", "sitetret", "measure"]
    runs, root = Fixtures(spark, sf)["default_old"].where(F.col("model_run") > 0), _folder(spark, "state")
    for k in range(9):
        batch = runs.where(F.col("model_run").between(k * 256 // 9 + 1, (k + 1) * 256 // 9))
        state = advance_state(run_state(batch, cells), root, lambda states: merge_states(states, cells))
    return summarise_state(state, cells, n_runs=256)


@query
def reconcile_cells(spark, sf):
    """C4 per dataset, year and measure: against matching results, and against results in
    which two datasets have opposite errors."""
    fx = Fixtures(spark, sf)
    detailed = P.detailed_ip(fx["ip_baseline"], fx["ip_runs"], STANDARD)
    default = fx["default_means_year"].select("dataset", "fyear", "measure", "mean")
    wrong = (default.select("dataset", "fyear").distinct().where("dataset in ('D0', 'D1')")
             .select("dataset", "fyear", F.lit("beddays").alias("measure"),
                     F.when(F.col("dataset") == "D0", 5.0).otherwise(-5.0).alias("mean")))
    measures = ["beddays", "admissions"]
    pairs = F.explode(F.array(F.lit("match"), F.lit("opposite")))
    both = default.withColumn("pair", pairs).unionByName(wrong.withColumn("pair", F.lit("opposite")))
    found = K.reconcile_cells(detailed.withColumn("pair", pairs), both, measures, by=("pair", "dataset", "fyear"))
    return found.select("pair", "dataset", "fyear", "measure", *[F.col(c).cast("double").alias(c) for c in ("default", "detailed", "diff")], "ok")


@query
def baseline_levels(spark, sf):
    """P5, P10: four cell definitions of the ip baseline in one scan."""
    levels = {"dataset": ["dataset", "fyear"], "pod": ["dataset", "fyear", "pod"],
              "site": ["dataset", "fyear", "sitetret", "pod"], "hrg": ["dataset", "fyear", "sushrg"]}
    return C.cell_levels(Fixtures(spark, sf)["ip_baseline"], levels, {
        "admissions": F.count(F.lit(1)), "beddays": F.sum(F.col("speldur") + 1).cast("long")})


@query
def national_year(spark, sf):
    """F16: the national results of one year."""
    fx = Fixtures(spark, sf)
    return _rounded(P.national_results(P.national_sample(fx["ip_baseline"], fyear=1995), fx["ip_runs"]))


# Rows numbered anew in every dataset and year: the results are those of unique numbers.
@query
def national_results_renumbered(spark, sf):
    fx = Fixtures(spark, sf)
    return _rounded(P.national_results(P.national_sample(fx["ip_renumbered"]), fx["ip_runs_renumbered"]))


@query
def national_avoided_renumbered(spark, sf):
    fx = Fixtures(spark, sf)
    return _rounded(P.national_avoided(P.national_sample(fx["ip_renumbered"]), fx["ip_avoided_renumbered"]))


@query
def strategy_efficiencies_renumbered(spark, sf):
    fx = Fixtures(spark, sf)
    return C.strategy_efficiencies(fx["strategies_renumbered"].where("kind = 'ef'"), fx["ip_renumbered"])


@query
def strategy_avoidance_renumbered(spark, sf):
    fx = Fixtures(spark, sf)
    return _rounded(C.strategy_avoidance(fx["strategies_renumbered"].where("kind = 'aa'"), fx["ip_renumbered"]))
