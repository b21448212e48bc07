"""Session settings the operators rely on, and durable lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# The operators need UTC (time keys are compared as microseconds) and leave the
# physical choices - join side, partition count, skew splits - to AQE.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app_name: str = "riskframe", master: str | None = None, **extra: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder all executors share. Only a session without other machines may do without."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="riskframe-checkpoint-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint in the folder the cluster names."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint(eager=True)
