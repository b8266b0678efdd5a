"""Stored layouts: folders by key, the older one-file layout, listings, parameter files.

A layout is written and read by Spark only; files move by renames of the file system
(metadata), never through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import require_columns
from .catalog import NDG, NDG_VALUE_TYPE, NDG_VARIANT


def write_partitioned(df: DataFrame, path: str, keys: Sequence[str], mode: str = "error") -> None:
    """Folders ``key=value/`` for ``keys``, one file per folder and writing task.

    Rows are dealt by the keys first, so a folder gets few files; AQE splits a key that
    holds much more than the others.
    """
    df.hint("rebalance", *keys).write.mode(mode).partitionBy(*keys).parquet(path)


# ----------------------------------------------------------------- reads
def scan_layout(spark: SparkSession, path: str, merge_schema: bool = True,
                columns: Sequence[str] | None = None) -> DataFrame:
    """Every file under ``path``; partition columns from the folders, and a column that only some
    files have is null in the others (``merge_schema``).  Filters on partition columns prune
    folders before any file is opened."""
    df = spark.read.option("basePath", path).option("mergeSchema", merge_schema).parquet(path)
    if columns is not None:
        require_columns(df, columns, path)
        df = df.select(*columns)
    return df


# ----------------------------------------------------------------- older layout (S3)
def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _folders(fs, path_of, path: str) -> list[str]:
    return sorted(s.getPath().toString() for s in fs.listStatus(path_of(path)) if s.isDirectory())


def rename_folders(spark: SparkSession, path: str, depth: int, name) -> list[str]:
    """Rename every folder ``key=value`` of ``depth`` levels under ``path`` to what ``name`` makes
    of its values; returns the new paths.  One rename per folder, no data is moved."""
    fs, path_of = _files(spark, path)
    leaves = [(path, [])]
    for _ in range(depth):
        leaves = [(f, [*values, f.rsplit("=", 1)[1]]) for leaf, values in leaves for f in _folders(fs, path_of, leaf) if "=" in f]
    out = []
    for leaf, values in leaves:
        target = name(*values)
        fs.mkdirs(path_of(target.rsplit("/", 1)[0]))
        if not fs.rename(path_of(leaf), path_of(target)):
            raise OSError(f"{leaf} could not be renamed to {target}")
        out.append(target)
    return out


def write_flat(df: DataFrame, root: str, version: str, activity: str) -> list[str]:
    """The older layout ``{root}/{version}/{fyear}/{dataset}/{activity}.parquet``."""
    staged = f"{root.rstrip('/')}/_staged_{activity}"
    write_partitioned(df, staged, ["fyear", "dataset"])
    return rename_folders(df.sparkSession, staged, 2,
                          lambda year, dataset: f"{root.rstrip('/')}/{version}/{year}/{dataset}/{activity}.parquet")


def from_path(pattern: str, group: int = 1) -> Column:
    """A part of the file's own path; needs the hidden column ``_metadata``."""
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, group)


def scan_baseline_flat(spark: SparkSession, root: str, version: str, activity: str,
                       dataset: Sequence[str] | None = None, fyear: int | None = None) -> DataFrame:
    """S3: every year and dataset of the older layout in one job; ``fyear`` and ``dataset`` come
    from the file paths.  Given values go into the glob, so other files are not listed."""
    years = "*" if fyear is None else str(int(fyear))
    names = ["*"] if dataset is None else list(dataset)
    paths = [f"{root.rstrip('/')}/{version}/{years}/{d}/{activity}.parquet" for d in names]
    pattern = rf"/([0-9]+)/([^/]+)/{activity}\.parquet/"
    return spark.read.option("mergeSchema", True).parquet(*paths).withColumns(
        {"fyear": from_path(pattern, 1).cast("int"), "dataset": from_path(pattern, 2)})


# ----------------------------------------------------------------- listings
def list_files(spark: SparkSession, root: str) -> DataFrame:
    """path (below ``root``) and length of every file under ``root``: a listing of the file system as a
    table; no file is opened."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
             .select(F.col("path").alias("_path"), "length"))
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/")
    return found.select(F.regexp_replace("_path", rf"^[a-z0-9]*:?/*\Q{base}\E/", "").alias("path"), "length")


# ----------------------------------------------------------------- parameters
PARAM_KEYS = ("dataset", "scenario", "create_datetime")


def write_params(docs: DataFrame, root: str, col: str = "document") -> None:
    """One text file per scenario run: ``dataset=/scenario=/create_datetime=``; ``docs`` has those
    columns and the JSON text ``col``.  Two documents of one run are two lines of its file."""
    (docs.select(*PARAM_KEYS, F.col(col).alias("value")).repartition(*PARAM_KEYS)
     .write.partitionBy(*PARAM_KEYS).text(root))


def read_params_variant(spark: SparkSession, root: str) -> DataFrame:
    """Every parameter file under ``root`` as ``dataset``, ``scenario``, ``create_datetime`` (from the
    folders) and ``document``, a VARIANT: any field can be asked for (``param``) without a schema.
    A file that is not JSON gives a null document."""
    files = spark.read.option("basePath", root).schema(
        "value string, dataset string, scenario string, create_datetime string").text(root)
    return files.select(*PARAM_KEYS, F.try_parse_json("value").alias("document"))


def param(path: str, kind: str, document: str = "document") -> Column:
    """A field of the documents by its path; null where it is missing or of another type."""
    return F.try_variant_get(F.col(document), path, kind)


def param_fields(params: DataFrame) -> DataFrame:
    """Every field of every document: the keys of ``params``, ``field`` and ``value`` (its JSON text)."""
    fields = F.expr("cast(document as map<string, variant>)")
    return params.select(*PARAM_KEYS, F.explode(fields).alias("field", "_value")).select(
        *PARAM_KEYS, "field", F.to_json("_value").alias("value"))


def upgrade_documents(params: DataFrame) -> DataFrame:
    """S16 on whole documents: the old growth map becomes ``{variant, value-type, values}``; every
    other field stays as it is, and so does a document that has the new form or none."""
    fields = F.expr("cast(document as map<string, variant>)")
    old = F.element_at("_fields", F.lit(NDG))
    is_old = F.element_at("_fields", F.lit(NDG)).isNotNull() & F.isnull(F.try_variant_get(old, "$.variant", "string"))
    new = F.parse_json(F.concat(F.lit(f'{{"variant":"{NDG_VARIANT}","value-type":"{NDG_VALUE_TYPE}","values":'), F.to_json(old), F.lit("}")))
    kept = F.map_filter("_fields", lambda k, v: k != F.lit(NDG))
    changed = F.map_concat(kept, F.create_map(F.lit(NDG), new))
    return (params.withColumn("_fields", fields)
            .withColumn("document", F.to_json(F.when(is_old, changed).otherwise(F.col("_fields")))).drop("_fields"))


# ----------------------------------------------------------------- products kept up to date
DONE = "_done"


def finished(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame | None:
    """Keys of the partitions that were written completely; None before the first write."""
    fs, path_of = _files(spark, root)
    done = f"{root.rstrip('/')}/{DONE}"
    return spark.read.parquet(done).select(*keys).distinct() if fs.exists(path_of(done)) else None


def outstanding(wanted: DataFrame, spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """S19 per partition: the ``wanted`` keys that are not complete yet, by an anti-join."""
    done = finished(spark, root, keys)
    wanted = wanted.select(*keys).distinct()
    return wanted if done is None else wanted.join(done, list(keys), "left_anti")


def refresh(spark: SparkSession, root: str, wanted: DataFrame, keys: Sequence[str], build) -> DataFrame:
    """Write the partitions of ``wanted`` that ``root`` lacks, and return their keys.

    ``build(todo)`` gives the product rows of the keys in ``todo`` (with the key columns);
    ``todo`` restricts the inputs by a semi-join, so nothing is computed for the rest.  Only
    the partitions in the rows are replaced (dynamic overwrite).  A key is marked as done after its rows
    are there, so a write that was cut off is done again, and a key without rows is done too.
    """
    todo = outstanding(wanted, spark, root, keys)
    todo = spark.createDataFrame(todo.collect(), todo.schema)  # keys of partitions: a catalogue, not data
    if todo.isEmpty():
        return todo
    rows = build(todo)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(f"{root.rstrip('/')}/rows")
    todo.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{DONE}")
    return todo


def read_product(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """The rows of the complete partitions of a product kept by ``refresh``."""
    rows = spark.read.option("basePath", f"{root.rstrip('/')}/rows").parquet(f"{root.rstrip('/')}/rows")
    return rows.join(finished(spark, root, keys), list(keys), "left_semi")
