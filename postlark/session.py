"""Session settings every job relies on, and the one way to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # one hot user may own a third of the rows: split its join partition even
    # where that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "postlark", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else built."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def _checkpoint_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. A missing setting is an error: a machine-local folder is lost with its executor."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the cluster's checkpoint folder."""
    spark = df.sparkSession
    folder = _checkpoint_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's checkpoint folder, which every executor can reach."""
    return f"{_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
