"""Raw table to staging, mart, checks and history, for one entity and its contract."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactloom.contract import PROCESSED, Contract, contract_rules
from pactloom.functions.predicates import any_null
from pactloom.operators import quality
from pactloom.operators.mart import not_yet_archived
from pactloom.operators.staging import stage, with_audit_columns
from pactloom.sinks import tables as sinks


@dataclass(frozen=True)
class EntityTables:
    raw: str
    history: str
    staging: str
    mart: str
    checks: str


    @property
    def snapshot(self) -> str:
        """Files of the raw table that the run at work takes."""
        return f"{self.raw}__snapshot"

    @property
    def leaving(self) -> str:
        """Files of the raw table that are in history and are to be removed."""
        return f"{self.raw}__leaving"


def refresh_staging(spark: SparkSession, names: EntityTables, contract: Contract, as_of: str | None = None, *, snapshot: bool = False) -> None:
    """Staging from the raw rows, or with ``snapshot`` from those of the files that it lists."""
    raw = sinks.snapshot_rows(spark, names.raw, names.snapshot) if snapshot else spark.table(names.raw)
    staged = stage(raw, contract, as_of)
    sinks.materialize_table(
        staged, names.staging, partition_by=contract.partition_by, cluster_by=contract.cluster_by
    )


def refresh_mart(
    spark: SparkSession,
    names: EntityTables,
    contract: Contract,
    as_of: str | None = None,
    *,
    merge: bool = True,
    lookback: timedelta | None = None,
) -> None:
    """New staging rows into the mart: replacing rows of the same key, or only added to it."""
    source = with_audit_columns(spark.table(names.staging), as_of)
    if merge:
        sinks.incremental_merge(source, names.mart, contract.key, lookback=lookback)
    else:
        sinks.incremental_append(source, names.mart)


def take_staging(spark: SparkSession, names: EntityTables, contract: Contract, as_of: str | None = None, *, merge: bool = True) -> None:
    """All staging rows into the mart, whatever their time; a second time changes nothing."""
    take_rows(with_audit_columns(spark.table(names.staging), as_of), names.mart, contract, merge=merge)


def take_rows(source: DataFrame, table: str, contract: Contract, *, merge: bool = True) -> None:
    """Staged rows into a mart, in any order and any number of times.

    With ``merge`` a row replaces that of its key unless the mart's is newer, or the same but for the day and time of
    its staging. Rows without a key, or all without
    ``merge``, are added where the mart lacks them, business values and time compared.
    """
    spark = source.sparkSession
    sinks.recover_table(spark, table)
    if not spark.catalog.tableExists(table):
        sinks.append_table(source, table)
        return
    spark.catalog.refreshTable(table)
    columns = [*(c.name for c in contract.business_columns), PROCESSED]
    if not merge or not contract.key:
        sinks.append_table(not_yet_archived(source, spark.table(table), columns), table)
        return
    sinks.resume_merge(spark, table, contract.key)
    mart = spark.table(table)
    no_key = any_null(contract.key)
    keyed = _changing(source.where(~no_key), mart.where(~no_key), contract.key, columns)
    keyless = not_yet_archived(source.where(no_key), mart.where(no_key), columns)
    sinks.merge_rows(keyed.unionByName(keyless), table, contract.key)


def _changing(source: DataFrame, mart: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows of ``source`` that change the mart: theirs is not newer, nor the one row of its key and the same.

    One join of the mart finds both, and a batch that comes again leaves nothing to merge.
    """
    held = mart.select(*[F.col(f"`{c}`").alias(f"_m_{c}") for c in columns])
    held = held.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*[f"_m_{k}" for k in keys])))
    time, have = F.col(PROCESSED), F.col(f"_m_{PROCESSED}")
    newer = (have > time) | (time.isNull() & have.isNotNull())
    same = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_m_{c}`")) for c in columns], F.col("_n") == 1)
    own = reduce(and_, [F.col(f"`{k}`") == F.col(f"`_m_{k}`") for k in keys])
    return source.join(held, own & (newer | same), "left_anti")


def check_report(df: DataFrame, layer: str, contract: Contract, as_of: str | None = None) -> DataFrame:
    """All checks of one table as rows of the quality layer."""
    objectives = quality.Objectives(contract.freshness_hours, contract.completeness_percent)
    report = quality.assertion_report(df, contract_rules(contract), objectives, as_of)
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return report.select(F.lit(layer).alias("table_name"), now.alias("checked_at"), *report.columns)


def run_checks(spark: SparkSession, names: EntityTables, contract: Contract, as_of: str | None = None) -> None:
    """Reports of staging and mart, which are read side by side and added in one write."""
    staging, mart = (check_report(spark.table(t), t, contract, as_of) for t in (names.staging, names.mart))
    sinks.append_table(staging.unionByName(mart), names.checks, partition_by=None)


def begin(spark: SparkSession, names: EntityTables) -> None:
    """Settles which files of the raw table the run takes: those of a run that was stopped, else all there are now."""
    if spark.catalog.tableExists(names.leaving):
        sinks.drop_snapshot(spark, names.raw, names.leaving)
    if not spark.catalog.tableExists(names.snapshot):
        sinks.take_snapshot(spark, names.raw, names.snapshot)


def archive(spark: SparkSession, names: EntityTables, contract: Contract, day: str) -> None:
    """The rows of the snapshot's files into history, and the files out of the raw table.

    The list is renamed once history has its rows; from then on files are only removed.
    """
    columns = [c.name for c in contract.business_columns]
    sinks.archive_snapshot(spark, names.raw, names.history, names.snapshot, day, columns)
    spark.sql(f"ALTER TABLE {names.snapshot} RENAME TO {names.leaving}")
    sinks.drop_snapshot(spark, names.raw, names.leaving)


def run_entity(
    spark: SparkSession,
    names: EntityTables,
    contract: Contract,
    as_of: str | None = None,
    *,
    merge: bool = True,
    lookback: timedelta | None = None,
) -> None:
    """One scheduled run.

    It takes the files that the raw table has when it begins: staging, mart, history and the emptying go by that list,
    not by time, so rows that land while the run is going wait for the next one, whatever their stamp. A run that
    stopped anywhere is finished by the next, with its list. With ``lookback`` the mart takes, as a table that isn't
    emptied would need it, the staging rows past its high-water mark or past so long before it.
    """
    begin(spark, names)
    refresh_staging(spark, names, contract, as_of, snapshot=True)
    if lookback is None:
        take_staging(spark, names, contract, as_of, merge=merge)
    else:
        refresh_mart(spark, names, contract, as_of, merge=merge, lookback=lookback)
    run_checks(spark, names, contract, as_of)
    day = as_of[:10] if as_of else spark.range(1).select(F.current_date().cast("string")).first()[0]
    archive(spark, names, contract, day)
    sinks.expire_partitions(spark, names.history, day)
