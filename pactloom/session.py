"""Session construction and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Only settings every deployment needs; executor sizing and the number of
# shuffle partitions stay with the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The default, INT96, has no statistics: a high-water mark could skip no row group.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

_local_scratch: str | None = None


def build_session(app_name: str = "pactloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """The same settings for a session that somebody else started."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A temporary folder stands in where that setting is absent and everything runs on this machine. On a cluster
    executors would each write to a folder of their own, so there the setting is required.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_scratch
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="pactloom-")
    return _local_scratch


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that a lost executor does not replay its sources."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint(eager=True)
