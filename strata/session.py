"""SparkSession helpers.

Production jobs get their session from the cluster; ``build_session`` only
fills in settings that are unset, so cluster-level configuration (shuffle
partitions, checkpoint directory, memory) always wins.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on for plan quality.  Each one is applied only
# when neither the cluster (spark-submit / defaults file) nor the session has
# set it explicitly.
SQL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
}
# Only settable when the context starts.
STATIC_DEFAULTS = {
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
DEFAULT_CONF = {**SQL_DEFAULTS, **STATIC_DEFAULTS}


def build_session(master: str | None = None, app_name: str = "strata",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session; library defaults fill only settings that the
    cluster and the session left unset.  ``shuffle_partitions`` and ``extra``
    are explicit choices and always applied."""
    from pyspark import SparkConf

    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if SparkSession.getActiveSession() is None:
        submitted = SparkConf()          # spark-submit / defaults-file values
        for k, v in STATIC_DEFAULTS.items():
            if not submitted.contains(k):
                builder = builder.config(k, v)
        for k, v in SQL_DEFAULTS.items():
            if not submitted.contains(k):
                builder = builder.config(k, v)
    explicit = dict(extra or {})
    if shuffle_partitions is not None:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in explicit.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    session_conf = spark._jsparkSession.sessionState().conf()
    context_conf = spark.sparkContext.getConf()
    for k, v in SQL_DEFAULTS.items():
        if not session_conf.contains(k) and not context_conf.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir(spark) or is_local(spark):
        ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names (``spark.checkpoint.dir``)."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.conf.get("spark.checkpoint.dir", None) or None


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process (tests, a single machine)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.  Only a local session may go
    without one: it gets a fresh scratch folder."""
    d = checkpoint_dir(spark)
    if d is None:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="strata-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def parquet_codec(spark: SparkSession) -> str:
    """The codec that cluster or session names, else the library's default."""
    key = "spark.sql.parquet.compression.codec"
    if spark._jsparkSession.sessionState().conf().contains(key):
        return spark.conf.get(key)
    return spark.sparkContext.getConf().get(key, SQL_DEFAULTS[key])


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the
    lineage, survives a lost executor, and gives the planner the real size."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata-stage/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path, compression=parquet_codec(spark))
    return spark.read.schema(df.schema).parquet(path)
