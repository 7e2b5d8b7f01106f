"""Session defaults and the shared work folder.

Everything in the library assumes UTC (the source timestamps are epoch
seconds in UTC) and Hive partition values kept as strings (``hr=07`` must
stay ``"07"``).  ``prepare`` applies these runtime settings to whatever
session it is handed, so callers may build their own session.

Intermediate tables (lake layers, snapshots, streaming checkpoints) live
under the folder named by ``spark.checkpoint.dir``: on a cluster that is a
shared, durable location, so written tables survive the loss of an
executor.  Only when the setting is absent and Spark runs in local mode do
we create one (tests, laptops).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "postlake", extra: dict | None = None) -> SparkSession:
    """A session with the library defaults; used by tests and bench."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in {**RUNTIME_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for k, v in RUNTIME_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (session conf or the context's
    checkpoint dir).  Set one only when it is unset and the master is local.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
        if root:
            # getCheckpointDir returns <dir>/<uuid>; use it as is
            pass
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="postlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint root for one job; the writer creates it."""
    return f"{checkpoint_root(spark)}/postlake/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For what several branches of a job read: unlike a cache it needs no
    release and outlives the executors that wrote it.  ``codec`` is Parquet's,
    the session's unless given.
    """
    path = scratch_dir(df.sparkSession, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle parallelism, which users size to their input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
