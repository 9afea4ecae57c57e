"""Audit ledgers: one row per file, per operation, per question."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.functions.text import new_id, truncate_error
from pactloom.sinks.tables import append_table

INGESTION_LEDGER = (
    "ingestion_id string, file_name string, file_uri string, status string, row_count bigint, "
    "error_message string, start_time timestamp, end_time timestamp, domain string, target_table string, "
    "data_contracts string, total_records bigint, processed_records bigint, good_records bigint, bad_records bigint"
)
INGESTION_COLUMNS = [c.split()[0] for c in INGESTION_LEDGER.split(", ")]
#: Partitions of the ingestion ledger besides the day: a batch is in one of so many.
LEDGER_KEYS = 256
OPERATIONS_LEDGER = (
    "operation_id string, timestamp timestamp, ai_agent_id string, resource_group string, resource_type string, "
    "resource_id string, action_type string, change_payload string, outcome_status string, reference_link string"
)
QUESTION_LEDGER = "trace_id string, timestamp timestamp, user_intent string, status string, event_log string"


def ingestion_rows(outcomes: DataFrame, start: Column, end: Column) -> DataFrame:
    """Ledger rows of a batch of files.

    ``outcomes`` has one row per file, with counts that are NULL for files that
    were not loaded; those count as zero.
    """
    counts = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("total", "good", "bad")}
    return outcomes.select(
        "ingestion_id",
        "file_name",
        "file_uri",
        "status",
        counts["total"].alias("row_count"),
        truncate_error(F.col("error_message")).alias("error_message"),
        start.alias("start_time"),
        end.alias("end_time"),
        "domain",
        "target_table",
        "data_contracts",
        counts["total"].alias("total_records"),
        counts["total"].alias("processed_records"),
        counts["good"].alias("good_records"),
        counts["bad"].alias("bad_records"),
    )


def audit_ingestion(outcomes: DataFrame, table: str, start: Column, end: Column, batch_id: str | None = None) -> None:
    rows = ingestion_rows(outcomes, start, end)
    if batch_id is None:
        append_table(rows, table, partition_by=None)
    else:
        append_ledger(rows, table, batch_id)


def batch_key(batch_id: str) -> int:
    """The partition of a batch: what looks a batch up reads one of ``LEDGER_KEYS`` of the ledger, whatever its age."""
    return int(hashlib.sha256(batch_id.encode()).hexdigest()[:8], 16) % LEDGER_KEYS


def append_ledger(rows: DataFrame, table: str, batch_id: str) -> None:
    """Ledger rows of a batch, into the partition of its key and of the day it started."""
    day = F.coalesce(F.col("start_time").cast("date"), F.lit("1970-01-01").cast("date"))
    placed = rows.withColumns({"batch_id": F.lit(batch_id), "batch_key": F.lit(batch_key(batch_id)), "started_on": day})
    append_table(placed, table, partition_by=("batch_key", "started_on"))


def batch_records(spark: SparkSession, table: str, batch_id: str) -> DataFrame:
    """What the ledger says of a batch: other partitions aren't read."""
    rows = spark.table(table)
    if "batch_key" not in rows.columns:  # a ledger from before it had partitions
        return rows
    return rows.where((F.col("batch_key") == batch_key(batch_id)) & (F.col("batch_id") == batch_id))


def operation_rows(operations: DataFrame, agent: str, at: Column, payload: list[str]) -> DataFrame:
    """Ledger rows of operations; the columns in ``payload`` become one JSON text."""
    link = F.col("reference_link") if "reference_link" in operations.columns else F.lit(None).cast("string")
    return operations.select(
        new_id().alias("operation_id"),
        at.alias("timestamp"),
        F.lit(agent).alias("ai_agent_id"),
        "resource_group",
        "resource_type",
        "resource_id",
        "action_type",
        F.to_json(F.struct(*payload)).alias("change_payload"),
        "outcome_status",
        link.alias("reference_link"),
    )


def question_rows(questions: DataFrame, at: Column, event: list[str], user: str = "user_email") -> DataFrame:
    payload = F.struct(F.col(user).alias("user"), *event)
    return questions.select(
        "trace_id", at.alias("timestamp"), "user_intent", "status", F.to_json(payload).alias("event_log")
    )


def audit_events(rows: DataFrame, table: str) -> None:
    append_table(rows, table, partition_by=None)


def backfill_link(rows: DataFrame, link: str | None) -> DataFrame:
    """Buffered rows with the link that became known later; a link already there stays."""
    return rows.withColumn("reference_link", F.coalesce("reference_link", F.lit(link).cast("string")))


def flush_operations(buffered: DataFrame, link: str | None, table: str) -> None:
    audit_events(backfill_link(buffered, link), table)
