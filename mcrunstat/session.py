"""Session helpers: one place for the engine settings the operators assume."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "mcrunstat",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session with AQE on and the web UI off.

    On a cluster the session comes from the launcher; these settings are the ones
    the operators are tuned for (AQE coalescing and skew-join splitting).
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder and register it once per context.

    ``spark.checkpoint.dir`` names the folder that driver and executors share and is
    used as is.  Where it is unset, a scratch folder is chosen for a single-process
    master (``local`` / ``local[n]``, as in tests); any other master raises, because
    its executors could not read a machine-local folder.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError(
                f"spark.checkpoint.dir is not set for master {sc.master}: name a folder that "
                "the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="mcrunstat-ckpt-")
        spark.conf.set("spark.checkpoint.dir", shared)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared)
    return shared.rstrip("/")


def materialize(df):
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Used where a reduced intermediate feeds several consumers (a scalar subquery and
    the main aggregate): the upstream scan and join run once, and lineage is cut so
    a lost executor does not replay them.  Never a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
