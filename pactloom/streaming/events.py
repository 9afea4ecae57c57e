"""Drift messages as a stream: decode, deduplicate, classify."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.functions.messages import decode_base64
from pactloom.operators.drift import classify_drift_events

KEY_SHARES = 32
ENVELOPE_SCHEMA = "message struct<data:string, messageId:string, publishTime:timestamp>"


def drift_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages from JSON envelopes whose payload is base64 text; envelopes without one are left out."""
    envelopes = spark.readStream.schema(ENVELOPE_SCHEMA).json(folder)
    return envelopes.where("message.data IS NOT NULL").select(
        F.col("message.publishTime").alias("published_at"),
        decode_base64(F.col("message.data")).alias("value"),
    )


def emitted_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Messages as ``emit_drift_events`` writes them, a JSON text a line, with the time they name."""
    lines = spark.readStream.schema("value string").text(folder)
    return lines.select(F.get_json_object("value", "$.timestamp").try_cast("timestamp").alias("published_at"), "value")


def dedup_events(messages: DataFrame, delay: str = "1 hour", key: str = "trace_id", at: str = "published_at") -> DataFrame:
    """One message per key within ``delay``: delivery is at least once, so copies arrive close together.

    Copies are first dropped within shares of a key, told apart by the time
    they were sent, then among the few that the shares leave: no task sees all
    copies of a message, however many there are.
    """
    share = F.pmod(F.xxhash64(at), F.lit(KEY_SHARES))
    shared = messages.withWatermark(at, delay).withColumn("_share", share)
    return shared.dropDuplicatesWithinWatermark([key, "_share"]).drop("_share").dropDuplicatesWithinWatermark([key])


def drift_requests(messages: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Messages that call for an action, each once."""
    return dedup_events(classify_drift_events(messages), delay)
