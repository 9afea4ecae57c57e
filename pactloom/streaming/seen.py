"""Messages given once, by a table of the keys that were seen: for keys and spans that a stream's state shouldn't hold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactloom.sinks.tables import _overwrite_partitions, expire_partitions


@dataclass(frozen=True)
class SeenKeys:
    """``table`` keeps (key, batch, day) in ``buckets`` files by a hash of the key, ``days`` days long."""

    table: str
    out: str
    key: str = "trace_id"
    at: str = "published_at"
    days: int = 7
    buckets: int = 16


def first_of_each(messages: DataFrame, seen: SeenKeys) -> DataFrame:
    """The earliest message of each key, among equal times the one that sorts first.

    Each task reduces its own messages first, so a message that was sent very often comes to the shuffle once for each
    task, whatever its times. A message without a key is like no other.
    """
    rest = [c for c in messages.columns if c not in (seen.key, seen.at)]
    whole = F.struct(F.col(seen.at), *rest)
    keyed = messages.where(F.col(seen.key).isNotNull()).groupBy(seen.key).agg(F.min(whole).alias("_m"))
    first = keyed.select(seen.key, *(F.col(f"_m.{c}").alias(c) for c in (seen.at, *rest)))
    return first.select(*messages.columns).unionByName(messages.where(F.col(seen.key).isNull()))


def unseen(first: DataFrame, seen: SeenKeys, number: int, day: Column) -> DataFrame:
    """Messages whose key no other batch of the last ``days`` days has seen; older partitions aren't read.

    Both sides are dealt by the same hash, the table as it is stored, so it isn't shuffled.
    """
    spark = first.sparkSession
    if not spark.catalog.tableExists(seen.table):
        return first
    known = spark.table(seen.table).where((F.col("seen_on") > F.date_sub(day, seen.days)) & (F.col("batch") != number))
    return first.join(known.select(seen.key), seen.key, "left_anti")


def take_batch(messages: DataFrame, number: int, seen: SeenKeys, as_of: str | None = None) -> None:
    """Writes a batch's new messages to its partition of ``out`` and its keys to the table.

    A batch delivered again overwrites its partition with the same messages: what it saw itself doesn't count.
    """
    spark = messages.sparkSession
    today = as_of or spark.range(1).select(F.current_date().cast("string")).first()[0]
    day = F.lit(today).cast("date")
    new = unseen(first_of_each(messages, seen), seen, number, day)
    placed = new.withColumn("batch", F.lit(number).cast("bigint"))
    if spark.catalog.tableExists(seen.out):
        _overwrite_partitions(placed.select(*spark.table(seen.out).columns), seen.out)
    else:
        placed.write.partitionBy("batch").format("parquet").saveAsTable(seen.out)
    spark.catalog.refreshTable(seen.out)
    keys = spark.table(seen.out).where((F.col("batch") == number) & F.col(seen.key).isNotNull())
    keys = keys.select(seen.key, F.lit(number).cast("bigint").alias("batch"), day.alias("seen_on")).repartition(seen.buckets, seen.key)
    writer = keys.write.partitionBy("seen_on").bucketBy(seen.buckets, seen.key).format("parquet")
    writer.mode("append").saveAsTable(seen.table)
    expire_partitions(spark, seen.table, today, seen.days, "seen_on")


def dedup_stream(messages: DataFrame, seen: SeenKeys, checkpoint: str, *, as_of: str | None = None, continuous: bool = False) -> StreamingQuery:
    """Gives each message of a stream once, whenever its copies arrive within the days that keys are kept."""

    def take(batch: DataFrame, number: int) -> None:
        take_batch(batch, number, seen, as_of)

    writer = messages.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime="1 minute") if continuous else writer.trigger(availableNow=True)
    return writer.start()


def given(spark: SparkSession, seen: SeenKeys) -> DataFrame:
    spark.catalog.refreshTable(seen.out)
    return spark.table(seen.out).drop("batch")
