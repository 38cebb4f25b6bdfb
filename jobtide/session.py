"""Spark session defaults and lineage helpers.

Every function in the library takes the caller's session; these helpers
only fill in settings the cluster has not already chosen.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on for exact, comparable results.
REQUIRED_CONF = {
    # Truncation of timestamps to months/weeks must not depend on the host.
    "spark.sql.session.timeZone": "UTC",
}

# Settings fixed when the context starts (no web UI or console progress bar).
STATIC_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Runtime settings used as defaults only: a value the cluster already set
# (spark-defaults, --conf) is kept.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast only sides whose measured size is below this bound.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(master: str | None = None, app: str = "jobtide",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return (or create) a session; library defaults fill only settings the
    cluster left unset, explicit arguments always apply."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**STATIC_CONF, **REQUIRED_CONF}.items():
        builder = builder.config(k, v)
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in explicit.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    cluster = spark.sparkContext.getConf()
    for k, v in DEFAULT_CONF.items():
        if k not in explicit and not cluster.contains(k):
            spark.conf.set(k, v)
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; create a local one only
    when the session has none (local runs and tests)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="jobtide-ckpt-", dir=os.environ.get("JOBTIDE_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return path


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder as Parquet and read again.

    For a table that several passes read: later passes read only their columns, a lost
    executor recomputes nothing, and no cached relation is left behind.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/jobtide-stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used inside iterative plans (recursive forecast, sequential repair) so
    a lost executor recomputes from the checkpoint, not from the scan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
