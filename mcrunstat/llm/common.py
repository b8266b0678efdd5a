"""Shared helpers: files in the cluster's shared folder, and small column idioms."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mcrunstat.session import ensure_checkpoint_dir

#: A word of the contracts: a run without space, tab, LF, VT, FF or CR.
WORD = r"[^\x20\x09-\x0D]+"


#: Spark's default and ours: texts differ by orders of magnitude in length, and both the
#: JVM and the worker hold whole batches.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_USUAL_BATCH, _OWN_BATCH = "67108864b", "4m"


def ship(spark: SparkSession) -> SparkSession:
    """Send this package's code to the workers once per context, so that tasks can import
    it wherever the driver was started, and bound their batches unless the user has."""
    if spark.conf.get(_BATCH, None) == _USUAL_BATCH:
        spark.conf.set(_BATCH, _OWN_BATCH)
    sc = spark.sparkContext
    if getattr(sc, "_mcrunstat_sent", None) is None:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="mcrunstat-code-")) / "mcrunstat.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(target))
        sc._mcrunstat_sent = str(target)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of one input table; only Spark's reader opens the path."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here, and a
    lost executor costs only the reading tasks it ran."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def n_partitions(spark: SparkSession) -> int:
    """The session's shuffle parallelism, for explicit repartitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would also change other alphabets)."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of words of a text, null counting as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
