"""Incremental marts and history."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from pactloom.contract import BATCH_DATE, PROCESSED
from pactloom.functions.predicates import any_null
from pactloom.operators.staging import latest_per_key

EPOCH = "1970-01-01 00:00:00"
RETENTION_DAYS = 30
NULL_KEY_TASKS = 256


def high_water(target: DataFrame, column: str = PROCESSED, floor: str = EPOCH) -> Column:
    """Greatest value the target holds, as a scalar subquery; ``floor`` for an empty target."""
    floor_value = F.lit(floor).cast(target.schema[column].dataType)
    return target.agg(F.coalesce(F.max(column), floor_value).alias("high_water")).scalar()


def incremental_filter(
    source: DataFrame,
    target: DataFrame | None,
    column: str = PROCESSED,
    *,
    floor: str = EPOCH,
    lookback: timedelta | None = None,
) -> DataFrame:
    """Source rows past the target's high-water mark; all of them while there is no target.

    The comparison is strict: a row that shares the mark or arrives late is not
    taken. ``lookback`` re-reads a span before the mark and belongs with a merge.
    """
    if target is None:
        return source
    mark = high_water(target, column, floor)
    if lookback is not None:
        mark = mark - F.lit(lookback)
    return source.where(F.col(column) > mark)


def upsert_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the source, and the source rows, the newest of each key.

    Newest is the greatest processing time, where the source has one; among rows of equal time, or without one, the
    row with the greatest other values counts, column by column. Without keys nothing is replaced: all rows of both
    sides stay.

    A NULL key matches nothing, so such rows stay and are added to. Since they
    need no partner they are spread over many tasks, however many there are;
    keys with many rows are left to adaptive skew handling, which splits the
    kept side of an anti join. The keys that are replaced are those of all
    source rows, so finding the newest of each is done once, not for both sides.
    """
    if not keys:
        return target.unionByName(source.select(*target.columns))
    no_key = any_null(keys)
    keyed = source.where(~no_key)
    replaced = keyed.select(*keys).distinct().withColumn("_spread", F.lit(0))
    by_time = [PROCESSED] if PROCESSED in source.columns else []
    rest = [f.name for f in source.schema if f.name not in (*keys, *by_time) and not isinstance(f.dataType, MapType | VariantType)]
    keyed = latest_per_key(keyed, keys, by_time, rest) if by_time or rest else keyed.dropDuplicates([*keys])
    source = keyed.unionByName(source.where(no_key))
    spread = F.when(no_key, 1 + F.pmod(F.spark_partition_id(), F.lit(NULL_KEY_TASKS))).otherwise(0)
    kept = target.withColumn("_spread", spread).join(replaced, [*keys, "_spread"], "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def append_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Bag union by name; a column one side lacks is NULL there."""
    return target.unionByName(batch, allowMissingColumns=True)


def archive_rows(raw: DataFrame, as_of_date: str) -> DataFrame:
    """Raw rows as history rows: the batch date is the day of archiving."""
    return raw.withColumn(BATCH_DATE, F.lit(as_of_date).cast("date"))


def not_yet_archived(raw: DataFrame, history: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raw rows that history lacks, NULL equal to NULL.

    History is reduced to distinct rows first, so many copies of one record
    collapse before the shuffle rather than meet in one task.
    """
    seen = history.select(*[F.col(c).alias(f"_h_{c}") for c in columns]).distinct()
    same = [raw[c].eqNullSafe(seen[f"_h_{c}"]) for c in columns]
    return raw.join(seen, same, "left_anti")


def retained(df: DataFrame, as_of_date: str, days: int = RETENTION_DAYS, column: str = BATCH_DATE) -> DataFrame:
    """Rows of partitions that have not expired; prunes when ``column`` is the partition."""
    return df.where(F.col(column) > F.date_sub(F.lit(as_of_date).cast("date"), days))
