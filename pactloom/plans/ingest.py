"""A batch of landed files into raw tables: route, compare, load, count, record."""

from __future__ import annotations

import math
import threading
import uuid
import warnings
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor, wait
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from itertools import chain

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pactloom.functions.predicates import any_blank
from pactloom.functions.text import basename, norm_blank
from pactloom.operators import drift, routing
from pactloom.session import cut_lineage
from pactloom.sinks import moves, tables as sinks
from pactloom.sinks.ledger import audit_ingestion, batch_records, ingestion_rows
from pactloom.sinks.messages import emit_drift_events
from pactloom.sources import files as sources
from pactloom.sources.tables import table_columns

# One load job reads at most this many files; the rest of a group go to further jobs.
FILES_PER_LOAD = 2000
# So many loads run side by side, of different tables.
LOADS_AT_ONCE = 4

_GROUP = (
    "table_ref",
    "file_format",
    "delimiter",
    "quote_char",
    "skip_header_rows",
    "write_disposition",
    "headers",
    "types",
)


@dataclass(frozen=True)
class IngestTargets:
    ledger: str
    events_folder: str | None = None
    bucket: str = "landing"
    archive_root: str | None = None
    #: A table of intents; with it handled files are moved below ``archive_root``.
    moves: str | None = None

    def __post_init__(self) -> None:
        if self.moves and not self.archive_root:
            raise ValueError("files can only be moved to an archive_root")


def plan_files(files: DataFrame, registry: DataFrame) -> DataFrame:
    """Landed files with their rule, format and parse settings."""
    routed = routing.route_files(routing.skip_paths(files), registry)
    return routed.withColumns(
        {
            "file_format": routing.file_format(F.col("file_format"), F.col("file_name")),
            "delimiter": F.coalesce(F.nullif("delimiter", F.lit("")), F.lit(routing.DEFAULT_DELIMITER)),
            "quote_char": F.coalesce(F.nullif("quote_char", F.lit("")), F.lit(routing.DEFAULT_QUOTE)),
            "skip_header_rows": F.coalesce(
                F.col("skip_header_rows").cast("int"), F.lit(routing.DEFAULT_SKIP_ROWS)
            ),
            "write_disposition": F.upper(
                F.coalesce(F.nullif("write_disposition", F.lit("")), F.lit(routing.DEFAULT_DISPOSITION))
            ),
            "data_contracts": norm_blank(F.col("data_contracts")),
            "table_ref": F.concat_ws(".", "target_dataset", "target_table"),
        }
    )


def inspect_files(planned: DataFrame, registry: DataFrame) -> DataFrame:
    """Adds column names, the difference to the target table, and the outcome this leads to.

    Names of JSON files come from every record. A CSV file without a header row takes the names
    of its table.
    """
    spark = planned.sparkSession
    routed = planned.where(F.col("target_table").isNotNull())
    found = planned.join(sources.read_headers(routed), "path", "left")
    found = _with_all_json_keys(cut_lineage(found))
    targets = routing.active_rules(registry).select(F.concat_ws(".", "target_dataset", "target_table"))
    tables = table_columns(spark, [r[0] for r in targets.distinct().collect()])
    headless = (F.col("file_format") == "csv") & (F.col("skip_header_rows") == 0)
    named = found.join(tables, "table_ref", "left").withColumn(
        "headers",
        F.when(headless, F.coalesce(F.filter("columns", lambda c: ~c.isin(*drift.AUDIT_COLUMNS)), "headers")).otherwise(
            F.col("headers")
        ),
    )
    compared = named.withColumns(
        {
            "new_columns": drift.unknown_columns(F.col("headers"), F.col("columns")),
            "deleted_columns": drift.missing_columns(F.col("headers"), F.col("columns")),
        }
    )
    return drift.drift_outcome(compared, error="header_error")


def _with_all_json_keys(found: DataFrame) -> DataFrame:
    spark = found.sparkSession
    json_files = found.where(F.col("file_format").isin("json", "ndjson") & F.col("header_error").isNull())
    chunks = _paths_in_chunks(json_files.where("target_table IS NOT NULL").select("path"))
    keys = [sources.ndjson_columns(spark, paths).withColumnRenamed("headers", "all_keys") for paths in chunks]
    if not keys:
        return found
    joined = found.join(reduce(DataFrame.unionByName, keys), "path", "left")
    return joined.withColumn("headers", F.coalesce("all_keys", "headers")).drop("all_keys")


def _paths_in_chunks(paths: DataFrame):
    chunk: list[str] = []
    for row in paths.toLocalIterator():
        chunk.append(row[0])
        if len(chunk) == FILES_PER_LOAD:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def _load_groups(manifest: DataFrame) -> DataFrame:
    """Files that one read can take together, spread over lists of bounded length.

    Replacing loads come first: what they replace, later appends add to.
    """
    ready = manifest.where(F.col("status") == routing.SUCCESS)
    parts = max(1, math.ceil(ready.count() / FILES_PER_LOAD))
    groups = ready.withColumn("part", F.pmod(F.xxhash64("path"), F.lit(parts))).groupBy(*_GROUP, "part")
    return groups.agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy(F.col("write_disposition").desc())


def _scan(spark: SparkSession, group: Row) -> DataFrame:
    kind = routing.FORMATS[group["file_format"]]
    paths = sources.readable(group["paths"])
    if kind == "csv":
        return sources.scan_csv(
            spark,
            paths,
            group["headers"],
            delimiter=group["delimiter"],
            quote=group["quote_char"],
            skip_rows=group["skip_header_rows"],
            fail_fast=False,
        )
    if kind == "json":
        return sources.scan_ndjson(spark, paths, group["headers"], fail_fast=False)
    return sources.scan_parquet(spark, paths, group["headers"])


def _load_group(spark: SparkSession, group: Row, manifest: DataFrame, replaced: dict, as_of: str) -> DataFrame:
    """Loads one group and returns counts per file.

    A file with an unreadable row is left out whole; the other files of its
    group load. Files count as loaded in the order they landed, so a replacing
    file wipes all that landed before it: ``replaced`` holds, per table, the
    newest replacing file so far.
    """
    rows = _scan(spark, group).withColumn("_bad", any_blank(group["headers"]))
    if sources.CORRUPT not in rows.columns:
        rows = rows.withColumn(sources.CORRUPT, F.lit(None).cast("string"))
    table = group["table_ref"]
    landed = F.struct("modified_at", "path")
    headers = [f"`{c}`" for c in group["headers"]]

    def finish(staged: DataFrame) -> DataFrame:
        per_file = staged.groupBy(F.col(sources.SOURCE_FILE).alias("path")).agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if("_bad").alias("bad"),
            F.count(sources.CORRUPT).alias("unreadable"),
        )
        counts = cut_lineage(per_file.join(manifest.select("path", "modified_at"), "path"))
        before = replaced.get(table)
        if group["write_disposition"] == "WRITE_TRUNCATE":
            newest = counts.where("unreadable = 0").agg(F.max(landed)).first()[0]
            if newest is not None and (before is None or newest > before):
                replaced[table] = newest
                only = staged.where(F.col(sources.SOURCE_FILE) == newest["path"])
                sinks.replace_raw(only.select(*headers), table, as_of)
            return counts
        left_out = F.col("unreadable") > 0
        if before is not None:
            left_out = left_out | (landed <= F.struct(F.lit(before["modified_at"]), F.lit(before["path"])))
        # At most the files of one load, so they fit in the plan; the rows need no join.
        paths = [r[0] for r in counts.where(left_out).select("path").collect()]
        rest = staged.where(~F.col(sources.SOURCE_FILE).isin(paths)) if paths else staged
        sinks.append_raw(rest.select(*headers), table, as_of)
        return counts

    return sinks.staged_load(rows, table, finish)


def _side_by_side(spark: SparkSession, groups: Iterator[Row], load: Callable[[Row], DataFrame]) -> Iterator[DataFrame]:
    """Runs ``load`` for each group, those of different tables side by side, those of one table in their order.

    Each table's jobs are in a scheduler pool of its own, so with fair scheduling a large load doesn't hold up the
    others. Results come as they are ready. A load that fails ends the batch once the others that run are done.
    """
    last: dict[str, Future] = {}
    failed: list[BaseException] = []

    def run(group: Row, before: Future | None):
        if before is not None:
            wait([before])
            if before.exception() is not None:
                return None
        if failed:
            return None
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", group["table_ref"])
        return load(group)

    with ThreadPoolExecutor(LOADS_AT_ONCE) as pool:
        running: set[Future] = set()
        for group in chain(groups, [None]):
            if group is not None:
                table = group["table_ref"]
                last[table] = pool.submit(inheritable_thread_target(spark)(run), group, last.get(table))
                running.add(last[table])
                if len(running) < 2 * LOADS_AT_ONCE:
                    continue
            while running:
                done, running = wait(running, return_when="FIRST_COMPLETED")
                for future in done:
                    if future.exception() is not None:
                        failed.append(future.exception())
                    elif future.result() is not None:
                        yield future.result()
                if group is not None:
                    break
    if failed:
        raise failed[0]


def ingest(
    spark: SparkSession,
    files: DataFrame,
    registry: DataFrame,
    targets: IngestTargets,
    *,
    as_of: str | None = None,
    batch_id: str | None = None,
) -> DataFrame:
    """Ingests a batch of files (path, file_name, modified_at) and returns their outcomes.

    ``batch_id`` names the batch. The ledger is written after every load, and
    files it lists under the same batch are not loaded again: a batch that is
    delivered again after a crash goes on where it stopped. A very large
    backlog is best taken through the file stream, which cuts it into batches.

    Loads of different tables run side by side. With ``targets.moves`` each load writes down which files it took; when
    all are done these are moved, and the ledger names the address they then have. A batch delivered again first
    finishes the moves that are open.
    """
    started = as_of or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    at = F.lit(started).cast("timestamp")
    ended = at if as_of else F.current_timestamp()
    batch_id = batch_id or uuid.uuid4().hex
    _settle(spark, targets, batch_id)
    arrived = files.withColumn("ingestion_id", F.sha2(F.concat_ws("|", F.lit(batch_id), "path"), 256))
    if targets.moves:
        arrived = _with_own_names(arrived)
    manifest = cut_lineage(
        inspect_files(plan_files(_with_records(arrived, targets, batch_id), registry), registry)
        .withColumn("trace_id", F.concat(F.lit("traces/"), F.col("ingestion_id")))
        .withColumn("bucket", F.lit(targets.bucket))
    )
    open_files = manifest.where("recorded IS NULL")
    replaced = _replaced_before(manifest)

    recording = threading.Lock()

    def record(handled: DataFrame) -> None:
        # Two jobs that add to one table's folder would clear each other's temporary files.
        with recording:
            if targets.moves:
                files_ = handled.select("ingestion_id", "path", "place", F.col("file_size").alias("length"))
                moves.intend(ingestion_rows(handled, at, ended).join(files_, "ingestion_id"), targets.moves, batch_id)
            else:
                audit_ingestion(handled, targets.ledger, at, ended, batch_id)

    def load(group: Row) -> DataFrame:
        counts = _load_group(spark, group, open_files, replaced, started)
        loaded = _with_counts(open_files.join(counts.drop("modified_at"), "path"), targets, started)
        record(loaded)
        return loaded

    parts = []
    groups = _load_groups(open_files).toLocalIterator()
    for loaded in _side_by_side(spark, groups, load):
        parts.append(loaded)
    no_counts = {c: F.lit(None).cast("bigint") for c in ("total", "bad", "unreadable")}
    refused = open_files.where(F.col("status") != routing.SUCCESS).withColumns(no_counts)
    refused = _with_counts(refused, targets, started)
    if targets.events_folder:
        emit_drift_events(drift.drift_events(refused, at), targets.events_folder)
    record(refused)
    _settle(spark, targets, batch_id)
    return reduce(DataFrame.unionByName, parts, refused)


def _settle(spark: SparkSession, targets: IngestTargets, batch_id: str) -> None:
    if targets.moves:
        for error in moves.settle(spark, targets.moves, targets.ledger, targets.archive_root, batch_id):
            warnings.warn(f"a file could not be moved: {error}", stacklevel=3)


def _with_own_names(arrived: DataFrame) -> DataFrame:
    """Adds what sets files of one base name apart in the archive, where a batch has several such."""
    name = basename(F.col("file_name"))
    shared = arrived.groupBy(name.alias("_name")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    joined = arrived.join(shared, name == F.col("_name"), "left")
    suffix = F.when(F.col("_n") > 1, F.concat(F.lit("_"), F.substring("ingestion_id", 1, 12))).otherwise(F.lit(""))
    return joined.withColumn("name_suffix", suffix).drop("_name", "_n")


def _with_records(arrived: DataFrame, targets: IngestTargets, batch_id: str) -> DataFrame:
    """Adds the status an earlier delivery of the batch recorded for a file, if it did."""
    spark = arrived.sparkSession
    recorded = []
    if spark.catalog.tableExists(targets.ledger):
        recorded.append(batch_records(spark, targets.ledger, batch_id).select("ingestion_id", "status"))
    if targets.moves and spark.catalog.tableExists(targets.moves):
        recorded.append(spark.table(targets.moves).where(F.col("batch_id") == batch_id).select("ingestion_id", "status"))
    if not recorded:
        return arrived.withColumn("recorded", F.lit(None).cast("string"))
    known = reduce(DataFrame.unionByName, recorded).withColumnRenamed("status", "recorded")
    known = known.join(arrived.select("ingestion_id"), "ingestion_id", "left_semi")
    return arrived.join(known.dropDuplicates(["ingestion_id"]), "ingestion_id", "left")


def _replaced_before(manifest: DataFrame) -> dict:
    """Per table, the newest replacing file an earlier delivery of the batch loaded."""
    done = manifest.where((F.col("recorded") == routing.SUCCESS) & (F.col("write_disposition") == "WRITE_TRUNCATE"))
    newest = done.groupBy("table_ref").agg(F.max(F.struct("modified_at", "path")).alias("newest"))
    return {r["table_ref"]: r["newest"] for r in newest.collect()}


def _with_counts(counted: DataFrame, targets: IngestTargets, started: str) -> DataFrame:
    unreadable = F.coalesce(F.col("unreadable"), F.lit(0)) > 0
    message = F.concat(F.col("unreadable").cast("string"), F.lit(" unreadable rows in "), F.col("file_name"))
    failed = counted.withColumns(
        {
            "status": F.when(unreadable, routing.FAILED).otherwise(F.col("status")),
            "error_message": F.when(unreadable, message).otherwise(F.col("error_message")),
            "total": F.when(~unreadable, F.col("total")),
            "bad": F.when(~unreadable, F.col("bad")),
        }
    )
    root = (targets.archive_root or targets.bucket).rstrip("/")
    place = routing.archive_path(
        routing.archive_folder(F.col("status")), F.col("file_name"), F.lit(started).cast("timestamp")
    )
    if "name_suffix" in counted.columns:
        place = F.concat(place, F.col("name_suffix"))
    return failed.withColumns(
        {
            "good": F.col("total") - F.col("bad"),
            "place": place,
            "file_uri": F.concat(F.lit(root + "/"), place),
            "target_table": F.nullif("table_ref", F.lit("")),
        }
    )
