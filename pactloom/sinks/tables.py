"""Table writes: raw loads, rebuilds, incremental marts, history and its expiry."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from datetime import timedelta
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.contract import BATCH_DATE, PROCESSED
from pactloom.operators.mart import RETENTION_DAYS, archive_rows, incremental_filter, not_yet_archived, upsert_by_key

RAW_BATCH_DATE = "9999-12-31"

Result = TypeVar("Result")

# The overwrite mode is a setting of the session: loads that run side by side take turns with it.
_overwriting = threading.RLock()


def _now(as_of: str | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def raw_rows(batch: DataFrame, table_columns: Sequence[str], as_of: str | None = None) -> DataFrame:
    """A batch under the columns of its raw table: text values, audit defaults, NULL for the rest."""
    audit = {BATCH_DATE: F.lit(RAW_BATCH_DATE).cast("date"), PROCESSED: _now(as_of)}
    have = set(batch.columns)

    def value(name: str) -> Column:
        if name in have:
            col = F.col(f"`{name}`")
            return col if name in audit else col.cast("string")
        return audit.get(name, F.lit(None).cast("string"))

    return batch.select(*[value(c).alias(c) for c in table_columns])


def append_raw(batch: DataFrame, table: str, as_of: str | None = None) -> None:
    columns = batch.sparkSession.table(table).columns
    raw_rows(batch, columns, as_of).write.insertInto(table)


def replace_raw(batch: DataFrame, table: str, as_of: str | None = None) -> None:
    """Truncate and load in one write."""
    columns = batch.sparkSession.table(table).columns
    _overwrite_all(raw_rows(batch, columns, as_of), table)


def _overwrite_all(df: DataFrame, table: str) -> None:
    """Replaces every partition, whatever overwrite mode the session is in."""
    _overwrite(df, table, "STATIC")


def _overwrite(df: DataFrame, table: str, how: str) -> None:
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    with _overwriting:
        before = spark.conf.get(mode)
        spark.conf.set(mode, how)
        try:
            df.write.insertInto(table, overwrite=True)
        finally:
            spark.conf.set(mode, before)


def truncate(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def staged_load(batch: DataFrame, table: str, work: Callable[[DataFrame], Result]) -> Result:
    """Stores a batch beside its target, hands it to ``work`` and always drops it.

    Source files are parsed once: counts and the insert both read the stored
    columns.
    """
    spark = batch.sparkSession
    database, _, name = table.rpartition(".")
    staging = f"{database}.staging_{name}_{uuid.uuid4().hex[:8]}" if database else f"staging_{name}_{uuid.uuid4().hex[:8]}"
    try:
        batch.write.saveAsTable(staging, format="parquet", mode="overwrite")
        return work(spark.table(staging))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")


def materialize_table(
    df: DataFrame, table: str, *, partition_by: str | None = BATCH_DATE, cluster_by: Sequence[str] = ()
) -> None:
    """Full rebuild. Rows are ordered within each file, so that readers skip row groups."""
    ordered = df.sortWithinPartitions(*([partition_by] if partition_by else []), *cluster_by) if cluster_by else df
    writer = ordered.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(table)


def append_table(df: DataFrame, table: str, *, partition_by: str | Sequence[str] | None = BATCH_DATE) -> None:
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df.select(*spark.table(table).columns).write.insertInto(table)
        return
    writer = df.write.format("parquet")
    columns = [partition_by] if isinstance(partition_by, str) else list(partition_by or ())
    (writer.partitionBy(*columns) if columns else writer).saveAsTable(table)


def incremental_append(source: DataFrame, table: str, *, column: str = PROCESSED) -> None:
    """Adds the rows past the mart's high-water mark; older versions of a key stay."""
    spark = source.sparkSession
    target = spark.table(table) if spark.catalog.tableExists(table) else None
    append_table(incremental_filter(source, target, column), table)


def incremental_merge(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    *,
    column: str = PROCESSED,
    partition_by: str | None = BATCH_DATE,
    lookback: timedelta | None = None,
) -> None:
    """Takes the rows past the mart's high-water mark, or past ``lookback`` before it, and replaces rows of the same key.

    Without keys nothing can be replaced: the rows past the mark are added.
    """
    spark = source.sparkSession
    if not keys:
        incremental_append(source, table, column=column)
        return
    recover_table(spark, table)
    if not spark.catalog.tableExists(table):
        append_table(source, table, partition_by=partition_by)
        return
    resume_merge(spark, table, keys, partition_by=partition_by)
    batch = incremental_filter(source, spark.table(table), column, lookback=lookback)
    merge_rows(batch, table, keys, partition_by=partition_by)


def merge_rows(
    batch: DataFrame, table: str, keys: Sequence[str], *, partition_by: str | None = BATCH_DATE
) -> None:
    """Upserts ``batch`` into ``table`` by key.

    The batch is stored first, and dropped when the table holds it. A run that
    stopped half-way left it behind for ``resume_merge``, which merges it only
    if the table lacks it: rows without a key would be added once more.
    """
    if not keys:
        raise ValueError(f"merging into {table} needs a key")
    spark = batch.sparkSession
    resume_merge(spark, table, keys, partition_by=partition_by)
    pending = f"{table}__batch"
    batch.select(*spark.table(table).columns).write.saveAsTable(pending, format="parquet", mode="overwrite")
    if spark.table(pending).isEmpty():
        drop_tables(spark, [pending])
        return
    _merge_stored(spark, pending, table, keys, partition_by)


def resume_merge(
    spark: SparkSession, table: str, keys: Sequence[str], *, partition_by: str | None = BATCH_DATE
) -> None:
    """Finishes a merge that was interrupted, if there is one.

    A merge drops its stored batch as soon as the table holds it, and only then what the batch's merge was built in: so
    what stands there without a batch is a leaving, and a replaced table beside a batch says that the batch is in.
    """
    recover_table(spark, table)
    pending, rebuilt, old = f"{table}__batch", f"{table}__rebuilt", f"{table}__old"
    if not spark.catalog.tableExists(pending):
        if left := [t for t in (rebuilt, old) if spark.catalog.tableExists(t)]:
            drop_tables(spark, left)
    elif spark.catalog.tableExists(old):
        drop_tables(spark, [pending, old])
    else:
        _merge_stored(spark, pending, table, keys, partition_by)


def _merge_stored(spark: SparkSession, pending: str, table: str, keys: Sequence[str], partition_by: str | None) -> None:
    batch = spark.table(pending)
    if partition_by:
        _merge_by_partition(batch, table, keys, partition_by)
        drop_tables(spark, [pending, f"{table}__rebuilt"])
    else:
        swap_table(upsert_by_key(spark.table(table), batch, keys), table, keep_old=True)
        drop_tables(spark, [pending, f"{table}__old"])


def _merge_by_partition(batch: DataFrame, table: str, keys: Sequence[str], partition_by: str) -> None:
    """Rewrites only partitions that hold a key of the batch, or that the batch adds to.

    Finding them reads the key columns alone, and none of the partitions that the
    batch adds to; all other partitions stay as they are. The new partitions are stored before they replace the old ones, and a
    run that finds them stored goes on from there: an interrupted replacement
    may have removed rows that exist nowhere else.
    """
    spark = batch.sparkSession
    rebuilt = f"{table}__rebuilt"
    added, touched = {r[0] for r in batch.select(partition_by).distinct().collect()}, None
    elsewhere = ~F.coalesce(_in_partitions(added, partition_by), F.lit(False))
    if not spark.catalog.tableExists(rebuilt):
        target = spark.table(table)
        touched = added | _partitions_with_keys(target.where(elsewhere), batch, keys, partition_by)
        merged = upsert_by_key(target.where(_in_partitions(touched, partition_by)), batch, keys)
        # Few files for each partition, however many tasks the merge had; adaptive execution splits large ones.
        merged = merged.hint("rebalance", F.col(partition_by))
        merged.write.partitionBy(partition_by).saveAsTable(rebuilt, format="parquet", mode="overwrite")
    fresh = spark.table(rebuilt)
    filled = {r[0] for r in fresh.select(partition_by).distinct().collect()}
    _overwrite_partitions(fresh.select(*spark.table(table).columns), table)
    if touched is None:
        touched = added | _partitions_with_keys(spark.table(table).where(elsewhere), batch, keys, partition_by)
    for value in touched - filled:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_by} = {_partition_literal(value)})")


def _partitions_with_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str], partition_by: str) -> set:
    matching = target.select(*keys, partition_by).join(batch.select(*keys).distinct(), list(keys), "left_semi")
    return {r[0] for r in matching.select(partition_by).distinct().collect()}


def _in_partitions(values: set, partition_by: str) -> Column:
    column = F.col(partition_by)
    within = column.isin([v for v in values if v is not None])
    return within | column.isNull() if None in values else within


def _partition_literal(value) -> str:
    return "NULL" if value is None else f"'{value}'"


def _overwrite_partitions(df: DataFrame, table: str) -> None:
    _overwrite(df, table, "DYNAMIC")


def swap_table(df: DataFrame, table: str, *, keep_old: bool = False) -> None:
    """Replaces a table by a result that reads it: written beside it, then renamed."""
    spark = df.sparkSession
    fresh, old = f"{table}__next", f"{table}__old"
    drop_tables(spark, [fresh, old])
    df.write.saveAsTable(fresh, format="parquet", mode="overwrite")
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    if not keep_old:
        drop_tables(spark, [old])


def recover_table(spark: SparkSession, table: str) -> None:
    """Brings back a table whose swap stopped between the two renames."""
    for beside in (f"{table}__next", f"{table}__old"):
        if not spark.catalog.tableExists(table) and spark.catalog.tableExists(beside):
            spark.sql(f"ALTER TABLE {beside} RENAME TO {table}")


def archive_history(
    spark: SparkSession,
    raw_table: str,
    history_table: str,
    as_of_date: str,
    *,
    business_columns: Sequence[str] | None = None,
    up_to: str | None = None,
) -> None:
    """Moves raw rows to history and empties the raw table.

    With ``business_columns`` a rerun adds only rows history lacks. ``up_to``
    bounds the move by the staged high-water mark; rows that landed later stay
    in the raw table.
    """
    _finish_emptying(spark, raw_table)
    raw = spark.table(raw_table)
    leaving = raw if up_to is None else raw.where(F.col(PROCESSED) <= F.lit(up_to).cast("timestamp"))
    if business_columns is not None:
        add_to_history(leaving, history_table, as_of_date, business_columns)
    else:
        archive_rows(leaving, as_of_date).select(*spark.table(history_table).columns).write.insertInto(history_table)
    if up_to is None:
        truncate(spark, raw_table)
        return
    later = raw.where((F.col(PROCESSED) > F.lit(up_to).cast("timestamp")) | F.col(PROCESSED).isNull())
    held = f"{raw_table}__held"
    later.write.saveAsTable(held, format="parquet", mode="overwrite")
    _put_back(spark, held, raw_table)


def snapshot_rows(spark: SparkSession, raw_table: str, snapshot: str) -> DataFrame:
    """The raw rows of the files that ``snapshot (path)`` lists; files that landed later are no part of it."""
    rows = spark.table(raw_table).withColumn("_path", F.col("_metadata.file_path"))
    return rows.join(F.broadcast(spark.table(snapshot)), F.col("_path") == F.col("path"), "left_semi").drop("_path")


def take_snapshot(spark: SparkSession, raw_table: str, snapshot: str) -> None:
    """Writes down which files the raw table has now."""
    spark.catalog.refreshTable(raw_table)
    files = spark.table(raw_table).select(F.col("_metadata.file_path").alias("path")).distinct()
    files.write.saveAsTable(snapshot, format="parquet", mode="overwrite")


def archive_snapshot(
    spark: SparkSession, raw_table: str, history_table: str, snapshot: str, as_of_date: str, business_columns: Sequence[str]
) -> None:
    """Adds the rows of a snapshot to history, those it lacks: a second time adds nothing."""
    add_to_history(snapshot_rows(spark, raw_table, snapshot), history_table, as_of_date, business_columns)


def add_to_history(rows: DataFrame, history_table: str, as_of_date: str, business_columns: Sequence[str]) -> None:
    """Adds the rows that history lacks. Of history only the partitions are read whose sketch says that they may hold one."""
    from pactloom.sinks import sketch

    columns = [*business_columns, PROCESSED]
    history = rows.sparkSession.table(history_table)
    words = sketch.words_of(archive_rows(rows, as_of_date), columns)
    touched = sketch.touched_partitions(rows, history_table, columns, words)
    leaving = not_yet_archived(rows, history.where(F.col(BATCH_DATE).isin(touched)), columns) if touched else rows
    placed = archive_rows(leaving, as_of_date).select(*history.columns)
    sketch.add_words(words, history_table)
    placed.write.insertInto(history_table)


def drop_snapshot(spark: SparkSession, raw_table: str, snapshot: str) -> None:
    """Removes the files of a snapshot from the raw table, in tasks, and then the snapshot.

    Nothing is rewritten, so files that land meanwhile stay as they are. Files that are gone already are no fault.
    """
    files = spark.table(snapshot)
    files.repartition(F.col("path")).mapInArrow(_delete_files, "path string").count()
    spark.catalog.refreshTable(raw_table)
    drop_tables(spark, [snapshot])


def _delete_files(batches: Iterator) -> Iterator:
    import re

    from pyarrow import fs

    for batch in batches:
        for path in batch.column("path").to_pylist():
            uri = re.sub("^file:/*", "file:///", re.sub(r"^s3[an]://", "s3://", path.replace(" ", "%20")))
            system, inner = fs.FileSystem.from_uri(uri)
            if system.get_file_info(inner).is_file:
                system.delete_file(inner)
        yield batch


def _put_back(spark: SparkSession, held: str, raw_table: str) -> None:
    _overwrite_all(spark.table(held).select(*spark.table(raw_table).columns), raw_table)
    drop_tables(spark, [held])


def _finish_emptying(spark: SparkSession, raw_table: str) -> None:
    """Puts back the rows an interrupted archive held, beside those that landed since."""
    held = f"{raw_table}__held"
    recover_table(spark, held)
    if spark.catalog.tableExists(held):
        kept = spark.table(held)
        landed = not_yet_archived(spark.table(raw_table), kept, kept.columns)
        swap_table(kept.unionByName(landed.select(*kept.columns)), held)
        _put_back(spark, held, raw_table)


def expire_partitions(
    spark: SparkSession, table: str, as_of_date: str, days: int = RETENTION_DAYS, column: str = BATCH_DATE
) -> list[str]:
    """Drops whole partitions past their retention; no data is read."""
    limit = spark.range(1).select(F.date_sub(F.lit(as_of_date).cast("date"), days).cast("string")).first()[0]
    values = [r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    expired = [v for v in values if v != "__HIVE_DEFAULT_PARTITION__" and v <= limit]
    from pactloom.sinks import sketch

    for value in expired:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({column} = '{value}')")
        sketch.drop_partition(spark, table, value)
    return expired


def drop_entity(spark: SparkSession, raw_table: str, staging_db: str, marts_db: str) -> None:
    base = raw_table.rsplit(".", 1)[-1].replace("_raw", "")
    drop_tables(spark, [f"{staging_db}.stg_{base}", f"{marts_db}.fct_{base}"])


def drop_tables(spark: SparkSession, names: Iterable[str]) -> None:
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
