"""S9-S16 as jobs over tables of versions, paths and parameter documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Results layout and version grammar.
AGG_ROOT = "aggregated-model-results"
FULL_ROOT = "full-model-results"
PATH_DEPTH = 5
VERSION_RE = r"^v?(\d+)\.(\d+)\.(\d+)(?:[-.+]?[A-Za-z][0-9A-Za-z.-]*)?$"
REQUEST_RE = r"^v?(\d+)(?:\.(\d+))?"
DATETIME_RE = r"^\d{8}_\d{6}$"
NOT_FOUND = "N/A"
NDG_VARIANT = "ndg-test"
NDG_VALUE_TYPE = "year-on-year-growth"


def _parse(col: Column, pattern: str, idx: int) -> Column:
    s = F.regexp_extract(col, pattern, idx)
    return F.when(s != "", s.cast("int"))


def simplify_version(col: Column) -> Column:
    """Drop the patch (``v3.0.0`` -> ``v3.0``); ``dev`` is kept."""
    return F.when(col == "dev", col).otherwise(F.substring_index(col, ".", 2))


def parse_versions(versions: DataFrame, col: str = "version") -> DataFrame:
    """Only ``vX.Y.Z`` folders count as versions; others get null parts."""
    c = F.col(col)
    return versions.select(c.alias("version"), _parse(c, VERSION_RE, 1).alias("major"),
                           _parse(c, VERSION_RE, 2).alias("minor"),
                           _parse(c, VERSION_RE, 3).alias("patch"))


def latest_version(versions: DataFrame, col: str = "version") -> DataFrame:
    """Newest version by numeric (major, minor, patch), not by text."""
    p = parse_versions(versions, col).where(F.col("major").isNotNull())
    return p.agg(F.max_by("version", F.struct("major", "minor", "patch")).alias("latest"))


def resolve_versions(versions: DataFrame, requests: DataFrame, col: str = "version",
                     request_col: str = "requested") -> DataFrame:
    """Per requested ``vM.m``: the newest patch of M.m, else the newest earlier
    minor, else ``N/A`` (D19: unparsable requests such as ``dev`` give ``N/A``).

    Both rules reduce to "the greatest version whose (major, minor) is at most the
    request's".  Versions are first reduced to the newest patch of each minor; each
    distinct request then takes the greatest of the minors of its own major, or the
    greatest of the majors below, so requests are never gathered in one task.
    """
    v = parse_versions(versions, col).where(F.col("major").isNotNull())
    minors = v.groupBy("major", "minor").agg(F.max_by("version", "patch").alias("version"))
    majors = minors.groupBy("major").agg(F.max_by("version", "minor").alias("version"))
    below = majors.agg(F.array_sort(F.collect_list(F.struct("major", "version")))).scalar()  # one entry a major
    r_col = F.col(request_col)
    r = requests.select(r_col.alias("requested"), _parse(r_col, REQUEST_RE, 1).alias("_major"),
                        F.coalesce(_parse(r_col, REQUEST_RE, 2), F.lit(2**31 - 1)).alias("_minor"))
    own = r.distinct().join(minors, (F.col("_major") == F.col("major")) & (F.col("minor") <= F.col("_minor")))
    own = own.groupBy(F.col("requested").alias("_own")).agg(F.max_by("version", "minor").alias("_found"))
    out = r.join(own, r["requested"].eqNullSafe(own["_own"]), "left").withColumn("_majors", below)
    older = F.filter("_majors", lambda x: x["major"] < F.col("_major"))
    out = out.select(
        "requested", F.when(F.col("_major").isNull(), F.lit(NOT_FOUND))
        .otherwise(F.coalesce("_found", F.try_element_at(older, F.lit(-1))["version"], F.lit(NOT_FOUND))).alias("resolved"))
    return out.withColumn("simplified", simplify_version(F.col("requested")))


def parse_paths(paths: DataFrame, col: str = "path", root: str = AGG_ROOT) -> DataFrame:
    """Results path -> version, dataset, scenario, datetime.

    ``valid`` is false when there are fewer than five parts or the root differs;
    ``run_datetime`` is set only for ``YYYYMMDD_HHMMSS``.  Also S13: the matching
    aggregated and full results paths.
    """
    parts = F.split(F.regexp_replace(F.col(col), r"^/+|/+$", ""), "/")
    valid = (F.size(parts) >= PATH_DEPTH) & (F.element_at(parts, 1) == root)

    def part(i: int) -> Column:
        return F.when(valid, F.element_at(parts, i))

    dt = part(5)
    tail = F.concat_ws("/", part(2), part(3), part(4), part(5))
    return paths.select(
        F.col(col).alias("path"), valid.alias("valid"),
        part(2).alias("version"), part(3).alias("dataset"), part(4).alias("scenario"),
        dt.alias("datetime"),
        F.when(dt.rlike(DATETIME_RE), dt).alias("run_datetime"),
        F.when(valid, F.concat_ws("/", F.lit(AGG_ROOT), tail)).alias("aggregated_path"),
        F.when(valid, F.concat_ws("/", F.lit(FULL_ROOT), tail)).alias("full_path"),
    )


def to_aggregated_path(col: Column) -> Column:
    """S13 path rewrite: full results path -> aggregated results path."""
    return F.regexp_replace(col, f"^{FULL_ROOT}/", f"{AGG_ROOT}/")


def run_completeness(listing: DataFrame, col: str = "path", n_runs: int | None = None,
                     group_col: str | None = None, expected: DataFrame | None = None,
                     file_suffix: str = "/0.parquet") -> DataFrame:
    """Per listing (default: per scenario prefix of the path), are full results there?

    ok = some ``model_run=N/0.parquet``; otherwise the first failing check:
    flat (no directory), no ``model_run=`` directory, no parquet in one.  With
    ``n_runs`` also whether every run has its parquet file.  ``group_col`` names
    a listing id column instead of the derived prefix; ``expected`` (one column,
    the listing id) reports listings with no files at all as flat.  A run's file ends in
    ``file_suffix`` (``.parquet`` for folders that Spark wrote).
    """
    p = F.col(col)
    parts = F.split(p, "/")
    if group_col is None:
        key = F.when(F.size(parts) > PATH_DEPTH,
                     F.array_join(F.slice(parts, 1, PATH_DEPTH), "/")).otherwise(p)
    else:
        key = F.col(group_col)
    has_dir = p.contains("/")
    has_run = p.contains("/model_run=")
    has_pq = has_run & p.endswith(file_suffix)
    run_no = F.regexp_extract(p, r"/model_run=(\d+)/", 1)
    g = listing.groupBy(key.alias("prefix")).agg(
        F.bool_or(has_dir).alias("has_directories"),
        F.bool_or(has_run).alias("has_model_run_dirs"),
        F.bool_or(has_pq).alias("has_parquet_in_model_run"),
        F.count_distinct(F.when(has_pq, run_no)).alias("runs_with_parquet"),
    )
    if expected is not None:
        g = expected.select(F.col(expected.columns[0]).alias("prefix")).join(g, "prefix", "left") \
            .na.fill(False, subset=["has_directories", "has_model_run_dirs",
                                    "has_parquet_in_model_run"]).na.fill(0, subset=["runs_with_parquet"])
    complete = F.col("has_directories") & F.col("has_model_run_dirs") & F.col("has_parquet_in_model_run")
    status = (F.when(complete, F.lit("ok"))
              .when(~F.col("has_directories"), F.lit("flat"))
              .when(~F.col("has_model_run_dirs"), F.lit("no_model_run_dirs"))
              .otherwise(F.lit("no_parquet_in_model_run")))
    g = g.withColumn("is_full_results", complete).withColumn("status", status)
    if n_runs is not None:
        g = g.withColumn("all_runs_present", complete & (F.col("runs_with_parquet") == n_runs))
    return g


# S6/S16 parameters
NDG = "non-demographic_adjustment"
NDG_TYPE = T.MapType(T.StringType(), T.ArrayType(T.DoubleType()))
NDG_STRUCT = T.StructType([T.StructField("variant", T.StringType()), T.StructField("value-type", T.StringType()),
                           T.StructField("values", NDG_TYPE)])
PARAMS_SCHEMA = T.StructType([
    T.StructField("scenario", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("app_version", T.StringType()),
    T.StructField("start_year", T.IntegerType()),
    T.StructField("create_datetime", T.StringType()),
    T.StructField("seed", T.LongType()),
    T.StructField("user", T.StringType()),
    T.StructField("viewable", T.BooleanType()),
    T.StructField(NDG, T.StringType()),  # its text: the form differs between versions
])


def read_params(spark, paths) -> DataFrame:
    """Every run's ``params.json`` in one read (one document per file)."""
    return parse_params(spark.read.text(paths, wholetext=True), "value")


def parse_params(docs: DataFrame, col: str = "json") -> DataFrame:
    """S6 over a column of JSON text: the usual fields as columns, the growth map as its
    text, and the whole document as ``document``, so no other parameter is lost."""
    return docs.select(F.from_json(F.col(col), PARAMS_SCHEMA).alias("p"), F.col(col).alias("document")).select(
        "p.*", "document")


def upgrade_ndg(params: DataFrame) -> DataFrame:
    """Old growth map -> ``{variant, value-type, values}`` struct; a document that has
    the struct already keeps it."""
    text = F.col(f"`{NDG}`")
    old = F.struct(F.lit(NDG_VARIANT).alias("variant"), F.lit(NDG_VALUE_TYPE).alias("value-type"),
                   F.from_json(text, NDG_TYPE).alias("values"))
    return params.withColumn(NDG, F.when(F.get_json_object(text, "$.variant").isNotNull(), F.from_json(text, NDG_STRUCT))
                             .otherwise(old.cast(NDG_STRUCT)))
