"""Spark session settings the library relies on.

Everything is UTC wall-clock time, ANSI casts, adaptive execution on.  The
checkpoint folder is read from the session (``spark.checkpoint.dir``); only a
local session that has none gets a scratch folder of its own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Fixed settings every job assumes.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, the bench and command-line runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # remove checkpoint files once their DataFrame is garbage-collected
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
               .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master and master.startswith("local"):
        # keep local runs from creating a warehouse folder in the working directory
        builder = builder.config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), "tidemark-warehouse"))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else built."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only where unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; a local
    session (tests) without one gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster)."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/tidemark-scratch/{tag}-{uuid.uuid4().hex}"


def stage(df, tag: str):
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage (a lost executor re-reads files instead of recomputing
    the upstream plan) and keeps column pruning and filter pushdown for every
    reader, unlike an in-memory cache.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.parquet(path)
