"""A mart kept by a stream over raw rows, and its freshness as the stream goes."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactloom.contract import PROCESSED, Contract
from pactloom.operators.quality import freshness_breach
from pactloom.operators.staging import stage, with_audit_columns
from pactloom.plans.entity import take_rows
from pactloom.sinks.tables import append_table


def _batch_property(checkpoint: str) -> str:
    return f"pactloom.batch.{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"


def last_batch(spark: SparkSession, table: str, checkpoint: str) -> int:
    """Number of the last batch of a stream that the mart holds, -1 for none."""
    if not spark.catalog.tableExists(table):
        return -1
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return int(found.get(_batch_property(checkpoint), -1))


def take_batch(
    raw: DataFrame, number: int, table: str, contract: Contract, checkpoint: str, *, as_of: str | None = None, alerts: str | None = None
) -> None:
    """Stages a batch of raw rows and merges it into the mart, which then names the batch.

    A batch that the mart names or that is past is left out. Should a run stop after the merge and before its name, the
    batch is merged again, which changes nothing: the mart's row stays where it is newer, and rows without a key are
    added only where they lack. ``alerts`` gets a row for each batch after which the newest row is too old.
    """
    spark = raw.sparkSession
    if number <= last_batch(spark, table, checkpoint):
        return
    # Merging reads the mart several times, and the batch with it.
    staged = with_audit_columns(stage(raw, contract, as_of), as_of).persist()
    try:
        take_rows(staged, table, contract)
    finally:
        staged.unpersist()
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_batch_property(checkpoint)}' = '{number}')")
        if alerts and contract.freshness_hours is not None:
            breach = freshness_breach(spark.table(table).select(PROCESSED), contract.freshness_hours, as_of)
            append_table(breach.withColumn("batch", F.lit(number).cast("bigint")), alerts, partition_by=None)


def keep_mart(
    raw: DataFrame,
    table: str,
    contract: Contract,
    checkpoint: str,
    *,
    as_of: str | None = None,
    alerts: str | None = None,
    continuous: bool = False,
) -> StreamingQuery:
    """Keeps the mart of a stream of raw rows; late rows and batches that come again leave newer rows alone."""

    def take(batch: DataFrame, number: int) -> None:
        take_batch(batch, number, table, contract, checkpoint, as_of=as_of, alerts=alerts)

    writer = raw.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime="1 minute") if continuous else writer.trigger(availableNow=True)
    return writer.start()
