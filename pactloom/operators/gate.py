"""Checks before a query runs: is it valid, how much does it read, how much does it return."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactloom.functions.text import PRICE_PER_TIB

# Limits past which a query needs a confirmation.
PREVIEW_ROWS = 2000
MAX_COST = 0.05

_UNITS = {"B": 1, "KiB": 2**10, "MiB": 2**20, "GiB": 2**30, "TiB": 2**40, "PiB": 2**50, "EiB": 2**60}


@dataclass(frozen=True)
class DryRun:
    valid: bool
    message: str
    schema: list[dict] = field(default_factory=list)
    bytes_scanned: int = 0
    cost: float = 0.0


@dataclass(frozen=True)
class Gate:
    row_count: int
    cost: float
    needs_confirmation: bool


def estimated_bytes(spark: SparkSession, sql: str) -> int:
    """Size of all relations the optimised plan reads, by Spark's own estimate.

    File relations are counted at full width: the estimate is an upper bound,
    not a bill.
    """
    plan = spark.sql(f"EXPLAIN COST {sql}").first()[0]
    logical = plan.split("== Physical Plan ==")[0]
    sizes = re.findall(r"^[^\n]*Relation [^\n]*Statistics\(sizeInBytes=([\d.]+) (\w+)", logical, re.MULTILINE)
    return int(sum(float(number) * _UNITS[unit] for number, unit in sizes))


def scan_price(bytes_scanned: int) -> float:
    return bytes_scanned / 1024**4 * PRICE_PER_TIB


def dry_run(spark: SparkSession, sql: str) -> DryRun:
    """Analyses a SELECT without running it."""
    try:
        schema = [{"name": f.name, "type": f.dataType.simpleString()} for f in spark.sql(sql).schema]
        scanned = estimated_bytes(spark, sql)
    except PySparkException as error:
        return DryRun(False, str(error))
    return DryRun(True, "Valid", schema, scanned, scan_price(scanned))


def count_rows(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(f"SELECT count(*) AS cnt FROM ({sql})")


def too_large(row_count: Column, cost: Column) -> Column:
    return (row_count > PREVIEW_ROWS) | (cost > MAX_COST)


def size_gate(spark: SparkSession, sql: str) -> Gate:
    """Whether a query needs a confirmation: how many rows it returns, all of them counted, and what it costs."""
    rows = count_rows(spark, sql).first()["cnt"]
    cost = scan_price(estimated_bytes(spark, sql))
    return Gate(rows, cost, rows > PREVIEW_ROWS or cost > MAX_COST)


def preview(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql).limit(PREVIEW_ROWS)


def category_metric(df: DataFrame, dimension: str, amount: str, names: tuple[str, str]) -> DataFrame:
    """Two columns a chart can take as they are: a text category and a float total."""
    label, total = names
    summed = df.groupBy(dimension).agg(F.sum(amount).alias("_total"))
    return summed.select(F.col(dimension).try_cast("string").alias(label), F.col("_total").try_cast("double").alias(total))


def last_turns(turns: DataFrame, keep: int = 5, *, by: Sequence[str] = ("conv_id",), order: str = "turn") -> DataFrame:
    """The last messages of every conversation as one text, oldest first.

    The rank filter runs before the shuffle, so a conversation sends at most
    ``keep`` messages per task and the gathered list stays that short.
    """
    window = Window.partitionBy(*by).orderBy(F.col(order).desc())
    recent = turns.withColumn("_rank", F.row_number().over(window)).where(f"_rank <= {int(keep)}")
    line = F.concat(F.upper("role"), F.lit(": "), F.col("text"))
    listed = F.sort_array(F.collect_list(F.struct(F.col(order), line.alias("line"))))
    return recent.groupBy(*by).agg(F.array_join(F.transform(listed, lambda t: t["line"]), "\n").alias("context"))
