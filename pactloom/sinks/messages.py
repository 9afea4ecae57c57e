"""Drift messages out of Spark: a text folder, or Kafka where its package is present."""

from __future__ import annotations

from pyspark.sql import DataFrame


def emit_drift_events(events: DataFrame, folder: str) -> None:
    """One JSON message per line."""
    events.select("value").write.mode("append").text(folder)


def emit_to_kafka(events: DataFrame, servers: str, topic: str) -> None:
    writer = events.select("value").write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()
