from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.contract import AUDIT_COLUMNS, orders_contract
from pactloom.functions.messages import encode_base64
from pactloom.operators.drift import AUDIT_FIELDS, classify_drift_events
from pactloom.parity import inputs
from pactloom.parity.case import Case
from pactloom.parity.inputs import AS_OF
from pactloom.parity.ingest import CLASSIFIED, messages
from pactloom.plans import repair
from pactloom.plans.ingest import IngestTargets, ingest
from pactloom.sources.files import list_files
from pactloom.sources.tables import create_table
from pactloom.streaming import arrivals, events, marts, seen


def _text_fields(names: list[str]) -> list[dict]:
    return [{"name": n, "type": "STRING", "defaultValueExpression": "NULL"} for n in names] + list(AUDIT_FIELDS)


def _file_arrival_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders land as delimited text, customers as JSON lines and events as Parquet; rules send each to its table.

    Result: all raw tables as text rows, and the counts of the ledger.
    """
    run = inputs.folder(spark, "file_arrival_stream")
    database = inputs.workspace(spark, "file_arrival_stream")
    orders = inputs.orders_raw(spark, sf_dir).select("order_id", "customer_name", "status")
    orders.write.options(header="true", sep="|").csv(f"{run}/landing/orders")
    inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name").write.json(f"{run}/landing/customer")
    inputs.table(spark, sf_dir, "events").select("event_id", "event_type").write.parquet(f"{run}/landing/events")
    shapes = {
        "orders_raw": ["order_id", "customer_name", "status"],
        "customer_raw": ["c_custkey", "c_name"],
        "events_raw": ["event_id", "event_type"],
    }
    for name, columns in shapes.items():
        create_table(spark, f"{database}.{name}", _text_fields(columns), partition_by="batch_date")
    rules = spark.sql(f"""SELECT * FROM VALUES
      ('orders/.*[.]csv$', '{database}', 'orders_raw', 'sales', '|', true),
      ('customer/.*[.]json$', '{database}', 'customer_raw', 'crm', NULL, true),
      ('events/.*[.]parquet$', '{database}', 'events_raw', 'web', NULL, true)
      AS t(file_pattern, target_dataset, target_table, domain, delimiter, is_active)""")
    rules.write.saveAsTable(f"{database}.ingestion_master", format="parquet", mode="overwrite")
    targets = IngestTargets(ledger=f"{database}.ingestion_log", events_folder=f"{run}/drift")
    stream = arrivals.file_arrivals(spark, f"{run}/landing")
    arrivals.ingest_arrivals(stream, f"{database}.ingestion_master", targets, f"{run}/checkpoint", as_of=AS_OF).awaitTermination()
    loaded = []
    for name, columns in shapes.items():
        rows = spark.table(f"{database}.{name}")
        values = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in columns])
        loaded.append(rows.select(F.lit(name).alias("source"), values.alias("row_text"), *AUDIT_COLUMNS))
    counts = spark.table(f"{database}.ingestion_log").where("status = 'SUCCESS'").groupBy(
        F.element_at(F.split("target_table", r"\."), -1).alias("table_name")
    ).agg(F.sum("good_records").alias("good"), F.sum("bad_records").alias("bad"))
    ledger = counts.select(
        F.concat(F.lit("ledger "), "table_name").alias("source"),
        F.concat_ws("|", "good", "bad").alias("row_text"),
        *[F.lit(None).cast(t).alias(c) for c, t in zip(AUDIT_COLUMNS, ("date", "timestamp"))],
    )
    return loaded[0].unionByName(loaded[1]).unionByName(loaded[2]).unionByName(ledger)


def _landed_orders(spark: SparkSession, sf_dir: str, run: str, database: str, files: int) -> DataFrame:
    """Orders as delimited files, a raw table for them and the rule that leads there."""
    orders = inputs.orders_raw(spark, sf_dir).select("order_id", "customer_name", "status")
    orders.repartition(files, "order_id").write.options(header="true", sep="|").csv(f"{run}/landing/orders")
    create_table(spark, f"{database}.orders_raw", _text_fields(["order_id", "customer_name", "status"]), partition_by="batch_date")
    return spark.sql(f"""SELECT * FROM VALUES ('orders/.*[.]csv$', '{database}', 'orders_raw', 'sales', '|', true)
      AS t(file_pattern, target_dataset, target_table, domain, delimiter, is_active)""")


def _row_text(rows: DataFrame, side: str) -> DataFrame:
    values = [F.coalesce(c, F.lit("")) for c in ("order_id", "customer_name", "status")]
    return rows.select(F.lit(side).alias("side"), F.concat_ws("|", *values).alias("row_text"))


def _archive_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Handled files are moved; the addresses in the ledger lead to the rows that landed, and nothing is left behind."""
    run, database = inputs.folder(spark, "archive_files"), inputs.workspace(spark, "archive_files")
    rules = _landed_orders(spark, sf_dir, run, database, 6)
    targets = IngestTargets(f"{database}.ingestion_log", archive_root=f"{run}/archive", moves=f"{database}.moves")
    ingest(spark, list_files(spark, f"{run}/landing"), rules, targets, as_of=AS_OF, batch_id="b")
    # The ledger of one batch of a few files.
    moved = [r[0] for r in spark.table(f"{database}.ingestion_log").where("status = 'SUCCESS'").select("file_uri").collect()]
    archived = spark.read.options(header="true", sep="|", pathGlobFilter="*").schema("order_id string, customer_name string, status string").csv(moved)
    left = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{run}/landing")
    count = left.agg(F.lit("left").alias("side"), F.count(F.lit(1)).cast("string").alias("row_text"))
    return _row_text(spark.table(f"{database}.orders_raw"), "raw").unionByName(_row_text(archived, "archive")).unionByName(count)


def _ledger_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that got half-way is delivered again, twice; every file is loaded and listed once."""
    run, database = inputs.folder(spark, "ledger_recovery"), inputs.workspace(spark, "ledger_recovery")
    rules = _landed_orders(spark, sf_dir, run, database, 6)
    targets = IngestTargets(f"{database}.ingestion_log")
    files = inputs.stored(list_files(spark, f"{run}/landing"), "listing")
    first = files.orderBy("path").limit(3)
    for part in (first, files, files):
        ingest(spark, part, rules, targets, as_of=AS_OF, batch_id="b")
    log = spark.table(f"{database}.ingestion_log").where("status = 'SUCCESS'")
    listed = log.agg(F.lit("ledger").alias("side"), F.concat_ws("|", F.count(F.lit(1)), F.count_distinct("ingestion_id"), F.sum("good_records"), F.sum("bad_records")).alias("row_text"))
    return _row_text(spark.table(f"{database}.orders_raw"), "raw").unionByName(listed)


def _drift_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files drift or lack a table, the requests that follow change the tables, the files load; a replay changes nothing."""
    run, database = inputs.folder(spark, "drift_repair"), inputs.workspace(spark, "drift_repair")
    rules = _landed_orders(spark, sf_dir, run, database, 4)
    inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_name").write.json(f"{run}/landing/customer")
    rules = rules.unionByName(spark.sql(f"SELECT 'customer/.*[.]json$' AS file_pattern, '{database}' AS target_dataset, 'customer_raw' AS target_table, 'crm' AS domain, NULL AS delimiter, true AS is_active"))
    # The table of the orders knows a column that the files lack, and lacks one of theirs.
    spark.sql(f"DROP TABLE {database}.orders_raw")
    for name in ("orders_raw", "orders_raw_hist"):
        create_table(spark, f"{database}.{name}", _text_fields(["order_id", "customer_name", "coupon"]), partition_by="batch_date")
    targets = IngestTargets(f"{database}.ingestion_log", events_folder=f"{run}/drift")
    listing = inputs.stored(list_files(spark, f"{run}/landing"), "listing")
    first = ingest(spark, listing, rules, targets, as_of=AS_OF, batch_id="b1").groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    refused = first.select(F.concat(F.lit("first "), F.lower("status")).alias("side"), F.when(F.col("n") > 0, "some").alias("row_text"))
    refused = inputs.stored(refused, "refused")
    repairs = repair.RepairTargets(f"{database}.requests", f"{database}.versions", [database])
    for attempt in ("a", "b"):  # the second has no checkpoint and gets all messages again
        requests = events.drift_requests(events.emitted_messages(spark, f"{run}/drift"))
        repair.repair_tables(requests, repairs, f"{run}/checkpoint-{attempt}").awaitTermination()
    second = ingest(spark, listing, rules, targets, as_of=AS_OF, batch_id="b2")
    drifted = second.where("status != 'SUCCESS'").agg(F.lit("left").alias("side"), F.count(F.lit(1)).cast("string").alias("row_text"))
    versions = spark.table(repairs.versions).select(
        F.lit("version").alias("side"),
        F.concat_ws("|", F.element_at(F.split("table_ref", r"\."), -1), "version", "action", F.array_join("added", ","), F.array_join("removed", ",")).alias("row_text"),
    )
    customers = spark.table(f"{database}.customer_raw").select(F.lit("customer").alias("side"), F.concat_ws("|", "c_custkey", "c_name").alias("row_text"))
    parts = [_row_text(spark.table(f"{database}.orders_raw"), "raw"), customers, refused, drifted, versions]
    return reduce(DataFrame.unionByName, parts)


def _envelopes(spark: SparkSession, sf_dir: str, target: str, copies: int) -> None:
    sent = messages(spark, sf_dir).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    sent.select(
        F.struct(
            encode_base64(F.col("value")).alias("data"),
            F.concat_ws("-", F.get_json_object("value", "$.trace_id"), "copy").alias("messageId"),
            F.col("ts").cast("timestamp").alias("publishTime"),
        ).alias("message")
    ).write.json(target)


def _stream_result(stream: DataFrame, run: str) -> DataFrame:
    spark = stream.sparkSession
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{run}/checkpoint")
    writer.trigger(availableNow=True).start(f"{run}/out").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{run}/out")


def _drift_event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    run = inputs.folder(spark, "drift_event_stream")
    _envelopes(spark, sf_dir, f"{run}/in", 1)
    return _stream_result(events.drift_messages(spark, f"{run}/in"), run)


def _dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each message arrives three times; each request is answered once."""
    run = inputs.folder(spark, "dedup_events")
    _envelopes(spark, sf_dir, f"{run}/in", 3)
    requests = events.drift_requests(events.drift_messages(spark, f"{run}/in"))
    flat = requests.withColumns({"added": F.array_join("added", ","), "removed": F.array_join("removed", ",")})
    return _stream_result(flat.drop("published_at"), run)


def _mart_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows land in three parts, newer versions first; other streams bring each part once more."""
    run, database = inputs.folder(spark, "mart_stream"), inputs.workspace(spark, "mart_stream")
    rows = inputs.orders_raw(spark, sf_dir)
    late = F.col("status") != "DELIVERED"
    # Rows whose key is no number have no key in the mart, so their versions are told apart within a batch only.
    part = F.when(~late | F.col("order_id").startswith("X"), 0).when(F.pmod(F.xxhash64("order_id"), F.lit(2)) == 0, 1).otherwise(2)
    table = f"{database}.fct_orders"

    def take(path: str, checkpoint: str) -> None:
        # What has landed since makes a batch, in as many files as tasks wrote.
        stream = spark.readStream.schema(rows.schema).parquet(path)
        marts.keep_mart(stream, table, orders_contract(), f"{run}/checkpoint-{checkpoint}", as_of=AS_OF).awaitTermination()

    parts = [f"{run}/raw/part={i}" for i in range(3)]
    for i, path in enumerate(parts):
        rows.where(part == i).write.parquet(path)
        take(f"{run}/raw/part=*", "a")
    for i, path in enumerate(parts):
        take(path, f"b{i}")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _dedup_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies with equal times, in one batch and in later ones, one message very often; the last batch comes twice."""
    database = inputs.workspace(spark, "dedup_seen")
    keys = seen.SeenKeys(f"{database}.seen", f"{database}.requests")
    sent = messages(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("published_at"), "value")
    requests = inputs.stored(classify_drift_events(sent), "requests")
    often = F.when(F.col("trace_id") == "t3", 5000).otherwise(2)
    copies = requests.withColumn("copy", F.explode(F.sequence(F.lit(1), often))).drop("copy")
    odd = requests.where(F.pmod(F.xxhash64("trace_id"), F.lit(2)) == 1)
    for number, batch in enumerate((odd, copies, copies)):
        seen.take_batch(batch, min(number, 1), keys, "2024-01-07")
    flat = seen.given(spark, keys).withColumns({"added": F.array_join("added", ","), "removed": F.array_join("removed", ",")})
    return flat.drop("published_at")


_BLANK = "coalesce(order_id, '') = '' OR coalesce(customer_name, '') = '' OR coalesce(status, '') = ''"
_TEXT = "concat(coalesce(order_id, ''), '|', coalesce(customer_name, ''), '|', coalesce(status, ''))"
_AUDIT = f"DATE '9999-12-31' AS batch_date, TIMESTAMP '{AS_OF}' AS processed_dttm"

CASES = [
    Case("file_arrival_stream", _file_arrival_stream, inputs.WITH_RAW + f"""
        SELECT 'orders_raw' AS source, concat(coalesce(order_id, ''), '|', coalesce(customer_name, ''), '|', coalesce(status, '')) AS row_text, {_AUDIT} FROM orders_raw
        UNION ALL SELECT 'customer_raw', concat(CAST(c_custkey AS VARCHAR), '|', c_name), {_AUDIT} FROM customer
        UNION ALL SELECT 'events_raw', concat(CAST(event_id AS VARCHAR), '|', event_type), {_AUDIT} FROM events
        UNION ALL SELECT 'ledger orders_raw', concat(CAST(count(*) FILTER (NOT ({_BLANK})) AS VARCHAR), '|', CAST(count(*) FILTER ({_BLANK}) AS VARCHAR)), NULL, NULL FROM orders_raw
        UNION ALL SELECT 'ledger customer_raw', concat(CAST(count(*) AS VARCHAR), '|0'), NULL, NULL FROM customer
        UNION ALL SELECT 'ledger events_raw', concat(CAST(count(*) AS VARCHAR), '|0'), NULL, NULL FROM events"""),
    Case("archive_files", _archive_files, inputs.WITH_RAW + f"""SELECT s.side, {_TEXT} AS row_text FROM orders_raw, (VALUES ('raw'), ('archive')) s(side)
        UNION ALL SELECT 'left', '0'"""),
    Case("drift_repair", _drift_repair, inputs.WITH_RAW + f"""SELECT 'raw' AS side, {_TEXT} AS row_text FROM orders_raw
        UNION ALL SELECT 'customer', concat(CAST(c_custkey AS VARCHAR), '|', c_name) FROM customer
        UNION ALL SELECT * FROM (VALUES ('first drift_detected', 'some'), ('first table_missing', 'some'), ('left', '0'),
          ('version', 'orders_raw|1|change|status|coupon'), ('version', 'customer_raw|1|create|c_custkey,c_name|')) v"""),
    Case("ledger_recovery", _ledger_recovery, inputs.WITH_RAW + f"""SELECT 'raw' AS side, {_TEXT} AS row_text FROM orders_raw
        UNION ALL SELECT 'ledger', concat('6|6|', CAST(count(*) FILTER (NOT ({_BLANK})) AS VARCHAR), '|', CAST(count(*) FILTER ({_BLANK}) AS VARCHAR)) FROM orders_raw"""),
    Case("drift_event_stream", _drift_event_stream, f"WITH {CLASSIFIED} SELECT date_trunc('millisecond', ts) AS published_at, value FROM messages"),
    Case("mart_stream", _mart_stream, inputs.WITH_STG + "SELECT * FROM stg_orders"),
    Case("dedup_seen", _dedup_seen, f"WITH {CLASSIFIED} SELECT * EXCLUDE (ts) FROM requests"),
    Case("dedup_events", _dedup_events, f"WITH {CLASSIFIED} SELECT * EXCLUDE (ts) FROM requests"),
]
