"""From drift messages to changed tables: columns added and dropped, tables created, entities dropped, each request once."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactloom.contract import AUDIT_COLUMNS, BATCH_DATE
from pactloom.operators.drift import AUDIT_FIELDS, evolve_schema, evolve_schema_fields
from pactloom.sinks import tables as sinks
from pactloom.sources.tables import column_ddl, create_table

_NAME = re.compile(r"[A-Za-z0-9_]+\.[A-Za-z0-9_]+")

VERSIONS = "table_ref string, version bigint, action string, columns array<string>, added array<string>, removed array<string>, changed_at timestamp"
REQUESTS = "trace_id string, table_ref string, batch string, taken_at timestamp"


@dataclass(frozen=True)
class RepairTargets:
    """Where requests may act: raw tables in ``databases`` and their histories, staging and marts of dropped entities."""

    requests: str
    versions: str
    databases: Sequence[str]
    staging: str | None = None
    marts: str | None = None
    history_suffix: str = "_hist"


def net_changes(requests: DataFrame) -> DataFrame:
    """``table_ref, added, removed, is_deletion``: what a batch of requests comes to for each table.

    Of several requests about one column the last counts, by time and trace id. However many requests a batch has, one
    row for each changed column of a table is left.
    """
    when = F.struct("published_at", "trace_id")
    names = F.concat(
        F.transform("added", lambda c: F.struct(c.alias("name"), F.lit(True).alias("add"))),
        F.transform("removed", lambda c: F.struct(c.alias("name"), F.lit(False).alias("add"))),
    )
    columns = requests.select("table_ref", when.alias("at"), F.explode(names).alias("c")).where("c.name IS NOT NULL AND trim(c.name) != ''")
    last = columns.groupBy("table_ref", "c.name").agg(F.max_by("c.add", "at").alias("add"), F.max("at").alias("at"))
    of = lambda add: F.sort_array(F.collect_list(F.when(F.col("add") == add, F.struct("at", "name"))))
    changed = last.groupBy("table_ref").agg(*(F.transform(of(a), lambda x: x["name"]).alias(n) for n, a in (("added", True), ("removed", False))))
    tables = requests.groupBy("table_ref").agg(F.max("is_deletion").alias("is_deletion"))
    empty = F.array().cast("array<string>")
    return tables.join(changed, "table_ref", "left").withColumns({c: F.coalesce(c, empty) for c in ("added", "removed")})


def _text_field(name: str) -> dict:
    return {"name": name.replace("`", "``"), "type": "STRING", "mode": "NULLABLE", "defaultValueExpression": "NULL"}


def add_columns(spark: SparkSession, table: str, names: Sequence[str]) -> list[str]:
    """Adds text columns that the table lacks; no data is touched. Names that differ in case only are one column."""
    have = {c.lower() for c in spark.table(table).columns}
    new = []
    for name in names:
        if name.lower() not in have:
            new.append(name)
            have.add(name.lower())
    if new:
        # Defaults can't be added to files that exist; a missing text is NULL anyway.
        fields = [column_ddl({**_text_field(n), "defaultValueExpression": None}) for n in new]
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(fields)})")
    return new


def drop_columns(spark: SparkSession, table: str, names: Sequence[str]) -> list[str]:
    """Takes columns out of a raw table: its rows are written under the new schema and the tables change names."""
    sinks.recover_table(spark, table)
    have = spark.table(table).columns
    gone = [c for c in have if c.lower() in {n.lower() for n in names} and c not in AUDIT_COLUMNS]
    if not gone or len(gone) == len(have) - len(AUDIT_COLUMNS):
        return []
    fresh, old = f"{table}__next", f"{table}__old"
    sinks.drop_tables(spark, [fresh, old])
    kept = [c for c in have if c not in (*gone, *AUDIT_COLUMNS)]
    create_table(spark, fresh, [*map(_text_field, kept), *AUDIT_FIELDS], partition_by=BATCH_DATE)
    evolve_schema(spark.table(table), [], gone).select(*spark.table(fresh).columns).write.insertInto(fresh)
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    sinks.drop_tables(spark, [old])
    return gone


def change_table(spark: SparkSession, change: Row, targets: RepairTargets) -> tuple[str, list[str], list[str]]:
    """Brings a table to what ``change`` asks for: the action, and the columns added and dropped. Once done, it's no change.

    History keeps its columns and gains the new ones, so what was archived stays readable.
    """
    table = change["table_ref"]
    if not _NAME.fullmatch(table or "") or table.split(".")[0] not in targets.databases:
        return "refused", [], []
    history = table + targets.history_suffix
    if change["is_deletion"]:
        if targets.staging and targets.marts:
            sinks.drop_entity(spark, table, targets.staging, targets.marts)
        return "drop_entity", [], []
    added, removed = list(change["added"]), list(change["removed"])
    sinks.recover_table(spark, table)
    if not spark.catalog.tableExists(table):
        fields = evolve_schema_fields([], added, removed)
        if len(fields) == len(AUDIT_FIELDS):
            return "none", [], []
        seen: dict[str, dict] = {}
        for field in fields:
            seen.setdefault(field["name"].lower(), field if field in AUDIT_FIELDS else _text_field(field["name"]))
        for name in (table, history):
            create_table(spark, name, seen.values(), partition_by=BATCH_DATE)
        return "create", [f["name"] for f in seen.values()][: -len(AUDIT_FIELDS)], []
    gone = drop_columns(spark, table, removed)
    new = add_columns(spark, table, [c for c in added if c not in AUDIT_COLUMNS])
    if spark.catalog.tableExists(history):
        add_columns(spark, history, [c for c in added if c not in AUDIT_COLUMNS])
    return ("change" if new or gone else "none"), new, gone


def apply_requests(requests: DataFrame, targets: RepairTargets, batch: str) -> int:
    """Applies the requests that the log doesn't have yet, and logs them; gives the number of changed tables.

    Changes come first and the log after them: a stop in between repeats changes that are then none.
    """
    spark = requests.sparkSession
    if spark.catalog.tableExists(targets.requests):
        requests = requests.join(spark.table(targets.requests).select("trace_id").distinct(), "trace_id", "left_anti")
    requests = requests.dropDuplicates(["trace_id"]).persist()
    changed = 0
    try:
        for change in net_changes(requests).orderBy("table_ref").toLocalIterator():
            action, added, removed = change_table(spark, change, targets)
            if action in ("none", "refused"):
                continue
            changed += 1
            table = change["table_ref"]
            columns = spark.table(table).columns if spark.catalog.tableExists(table) else []
            before = 0
            if spark.catalog.tableExists(targets.versions):
                before = spark.table(targets.versions).where(F.col("table_ref") == table).agg(F.max("version")).first()[0] or 0
            row = spark.createDataFrame([(table, before + 1, action, columns, added, removed)], VERSIONS.rpartition(", ")[0])
            sinks.append_table(row.withColumn("changed_at", F.current_timestamp()), targets.versions, partition_by=None)
        log = requests.select("trace_id", "table_ref", F.lit(batch).alias("batch"), F.current_timestamp().alias("taken_at"))
        sinks.append_table(log, targets.requests, partition_by=None)
    finally:
        requests.unpersist()
    return changed


def repair_tables(requests: DataFrame, targets: RepairTargets, checkpoint: str, *, continuous: bool = False) -> StreamingQuery:
    """Applies a stream of requests (see ``drift_requests``) batch by batch; a batch delivered again changes nothing."""

    def apply(batch: DataFrame, number: int) -> None:
        apply_requests(batch, targets, f"{checkpoint}#{number}")

    writer = requests.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime="1 minute") if continuous else writer.trigger(availableNow=True)
    return writer.start()
