"""What each partition of a history may hold: a bitmap over row digests with spans of time, looked at before it is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.contract import BATCH_DATE, PROCESSED
from pactloom.session import cut_lineage
from pactloom.sinks.tables import append_table

#: Address bits of a partition's bitmap: 2^22 bits, in words of 64 of which only those with a bit are kept.
BITS = 22


def _digest(columns: Sequence[str]) -> Column:
    """A hash of a row, for which NULL is a value like others."""
    return F.xxhash64(*[e for c in columns for e in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])


def _words(rows: DataFrame, columns: Sequence[str], *by: str) -> DataFrame:
    slot = F.shiftrightunsigned(_digest(columns), 64 - BITS)
    return rows.select(*by, slot.alias("_slot"), F.col(PROCESSED).alias("_at")).withColumn("word", F.shiftright("_slot", 6).cast("int"))


def table_of(history: str) -> str:
    return f"{history}_sketch"


def _adopt(spark: SparkSession, history: str) -> None:
    """A sketch under the name that it had before, which was that of a leaving, goes on under this one."""
    if spark.catalog.tableExists(f"{history}__sketch") and not spark.catalog.tableExists(table_of(history)):
        spark.sql(f"ALTER TABLE {history}__sketch RENAME TO {table_of(history)}")


def _days(spark: SparkSession, table: str) -> set[str]:
    return {r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def words_of(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The words of the bitmap of ``rows``, each with the span of times of its rows, computed once.

    However many rows there are, a batch date has 2^16 of them at most.
    """
    words = _words(rows, columns, BATCH_DATE).groupBy(BATCH_DATE, "word").agg(
        F.expr("bit_or(shiftleft(1L, CAST(_slot & 63 AS INT)))").alias("mask"),
        F.min("_at").alias("low"),
        F.max("_at").alias("high"),
        F.bool_or(F.col("_at").isNull()).alias("without"),
    )
    return cut_lineage(words.select("word", "mask", "low", "high", "without", F.lit(BITS).alias("bits"), BATCH_DATE))


def add_words(words: DataFrame, history: str) -> None:
    """Adds the words of rows that go to a history to the sketches of their partitions; call it before they are inserted.

    A sketch that knows rows which never came is no fault: it says what may be there.
    """
    append_table(words, table_of(history), partition_by=BATCH_DATE)


def touched_partitions(rows: DataFrame, history: str, columns: Sequence[str], words: DataFrame) -> list:
    """Batch dates of the partitions that may hold a row of ``rows``: all but those whose sketch rules it out.

    A history has a partition for each day that it is kept, so they are few. One without a sketch is read. Most are
    settled by the ``words`` of the rows; the rows themselves are asked for the others only.
    """
    spark = rows.sparkSession
    _adopt(spark, history)
    present = _days(spark, history)
    if not present or not spark.catalog.tableExists(table_of(history)):
        return sorted(present)
    sketch = spark.table(table_of(history)).where(F.col("bits") == BITS)
    asked = words.select("word", *[F.col(c).alias(f"_{c}") for c in ("mask", "low", "high", "without")])
    met = asked.join(sketch, "word").where("mask & _mask <> 0")
    # Of rows whose times all lie in the span of a word they share a bit with, one is a hit whichever has that bit.
    sure = F.expr("(_low IS NULL OR _low >= low AND _high <= high) AND (without OR NOT _without)")
    near = F.expr("_low <= high AND _high >= low OR _without AND without")
    settled = met.groupBy(BATCH_DATE).agg(F.bool_or(sure).alias("sure"), F.bool_or(near).alias("near")).collect()
    found = {str(r[0]) for r in settled if r["sure"]}
    if unsure := [r[0] for r in settled if r["near"] and not r["sure"]]:
        # Distinct slots and times first, so copies of a row ask once.
        hits = _words(rows, columns).distinct().join(sketch.where(F.col(BATCH_DATE).isin(unsure)), "word")
        hits = hits.where("shiftright(mask, CAST(_slot & 63 AS INT)) & 1L = 1L")
        hits = hits.where("_at BETWEEN low AND high OR (_at IS NULL AND without)")
        found |= {str(r[0]) for r in hits.select(BATCH_DATE).distinct().collect()}
    return sorted(found & present | present - _days(spark, table_of(history)))


def drop_partition(spark: SparkSession, history: str, value: str) -> None:
    if spark.catalog.tableExists(table_of(history)):
        spark.sql(f"ALTER TABLE {table_of(history)} DROP IF EXISTS PARTITION ({BATCH_DATE} = '{value}')")
