from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.functions import variant
from pactloom.operators import drift, routing
from pactloom.parity import inputs
from pactloom.parity.case import Case
from pactloom.parity.inputs import AS_OF, FILES, HEADERS, ROUTED, SUPPLIER_REGISTRY
from pactloom.sinks import ledger, tables as sinks
from pactloom.sinks.messages import emit_drift_events


def _kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.skip_paths(inputs.landed_files(spark, sf_dir))


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.route_files(_kept(spark, sf_dir), inputs.rules(spark))


def _skip_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept(spark, sf_dir).select("event_id", "file_name")


def _resolve_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    fmt = routing.file_format(F.col("file_format"), F.col("file_name"))
    return _routed(spark, sf_dir).select(
        "event_id", "file_name", fmt.alias("resolved"), routing.supported_format(fmt).alias("supported")
    )


def _route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).select("event_id", "file_name", "file_pattern", "target_dataset", "target_table", "domain")


def _first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).groupBy("target_table").agg(F.count(F.lit(1)).alias("files"))


def _filter_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.active_rules(inputs.supplier_registry(spark, sf_dir))


def _registry_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per order line, routed by a registry with a rule per nation; rules of one region are off."""
    n = F.col("n_nationkey").cast("string")
    registry = inputs.table(spark, sf_dir, "nation").select(
        F.concat(F.lit("^in/nation_"), n, F.lit("_")).alias("file_pattern"),
        F.lit("raw").alias("target_dataset"),
        F.concat(F.lit("nation_"), n).alias("target_table"),
        F.concat(F.lit("region_"), F.col("n_regionkey").cast("string")).alias("domain"),
        (F.col("n_regionkey") != 2).alias("is_active"),
    )
    nation = (F.col("l_suppkey") % 25).cast("string")
    line = F.concat_ws("_", nation, F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    names = F.concat(F.lit("in/nation_"), line, F.lit(".csv")).alias("file_name")
    routed = routing.route_files(inputs.table(spark, sf_dir, "lineitem").select(names), registry)
    return routed.groupBy("target_table", "domain").agg(F.count(F.lit(1)).alias("files"))


def _registry_routing_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule for each customer, a file for each order; customers in debt are switched off."""
    customers = inputs.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("c"), "c_acctbal")
    registry = customers.select(
        F.concat(F.lit("^in/customer_"), "c", F.lit("_")).alias("file_pattern"),
        F.lit("raw").alias("target_dataset"),
        F.concat(F.lit("customer_"), "c").alias("target_table"),
        F.lit("sales").alias("domain"),
        (F.col("c_acctbal") > 0).alias("is_active"),
    )
    names = F.concat(F.lit("in/customer_"), F.col("o_custkey").cast("string"), F.lit("_"), F.col("o_orderkey").cast("string"), F.lit(".csv"))
    routed = routing.route_files(inputs.table(spark, sf_dir, "orders").select(names.alias("file_name")), registry)
    return routed.groupBy("target_table").agg(F.count(F.lit(1)).alias("files"))


def _audit_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of the operations as VARIANT, some of them cut short; bad ones are kept apart with their text."""
    cut = F.when(F.col("resource_id") == "raw.error", F.substring("change_payload", 1, 9)).otherwise(F.col("change_payload"))
    rows = _operations(spark, sf_dir).select("resource_id", cut.alias("payload"))
    parsed = rows.withColumns({"v": variant.as_variant("payload"), "is_bad": variant.is_bad_json("payload")})
    named = variant.variant_fields(parsed, "v", {"event_id": ("$.event_id", "bigint"), "user_id": ("$.user_id", "bigint"), "absent": ("$.nothing", "string")})
    return named.select("resource_id", "is_bad", F.when(F.col("is_bad"), F.col("payload")).alias("bad_payload"), "event_id", "user_id", "absent")


def _schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    diff = drift.schema_diff(inputs.file_headers(spark, sf_dir), inputs.table_columns(spark, sf_dir))
    return diff.select(
        "event_id",
        F.array_join("new_columns", ",").alias("new_columns"),
        F.array_join("deleted_columns", ",").alias("deleted_columns"),
    )


def _schema_diff_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = inputs.file_headers(spark, sf_dir).select("event_id", "table_ref", F.explode("headers").alias("column_name"))
    columns = inputs.table_columns(spark, sf_dir).select("table_ref", F.explode("columns").alias("column_name"))
    return drift.schema_diff_rows(names, columns, ["event_id"]).select("event_id", "column_name", "change")


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of outcome: no rule, unknown format, no table, drift, success."""
    fmt = routing.file_format(F.col("file_format"), F.col("file_name"))
    planned = _routed(spark, sf_dir).withColumns(
        {
            "headers": inputs.headers(),
            "table_ref": F.concat_ws(".", "target_dataset", "target_table"),
            "header_error": F.when(~routing.supported_format(fmt), F.concat(F.lit("Unsupported file format: "), fmt)),
        }
    )
    names = F.array(*[F.lit(c) for c in [*inputs.BUSINESS, "batch_date", "processed_dttm"]])
    exists = F.col("table_ref").isin("raw.clicks_any", "raw.views")
    diffed = planned.withColumn("columns", F.when(exists, names)).withColumns(
        {
            "new_columns": drift.unknown_columns(F.col("headers"), F.col("columns")),
            "deleted_columns": drift.missing_columns(F.col("headers"), F.col("columns")),
        }
    )
    return drift.drift_outcome(diffed, error="header_error")


def _drift_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes(spark, sf_dir).select("event_id", "status", "error_message", "archive_folder")


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = F.create_map(
        F.lit("order_id"), F.col("event_id").cast("string"), F.lit("coupon"), F.concat(F.lit("C"), F.col("event_id"))
    )
    return outcomes(spark, sf_dir).withColumn("samples", F.array(row))


def _drift_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    drifted = _samples(spark, sf_dir).where(F.col("status") == routing.DRIFT_DETECTED)
    return drifted.select("event_id", F.to_json(drift.drift_samples(F.col("samples"), F.col("new_columns"))).alias("samples"))


def _emit_drift_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the messages, reads them back and takes them apart."""
    target = inputs.folder(spark, "emit_drift_event")
    named = _samples(spark, sf_dir).withColumns(
        {"trace_id": F.concat(F.lit("t"), F.col("event_id")), "bucket": F.lit("landing")}
    )
    spark.createDataFrame([], "value string").write.mode("overwrite").text(target)
    emit_drift_events(drift.drift_events(named, F.lit(AS_OF).cast("timestamp")), target)
    field = lambda path: F.get_json_object("value", f"$.{path}")
    return spark.read.text(target).select(
        *[field(c).alias(c) for c in ("event_type", "trace_id", "bucket", "file_name", "table_ref", "domain")],
        field("timestamp").alias("sent_at"),
        F.size(F.from_json(field("new_column_headers"), "array<string>")).alias("new_columns"),
        F.size(F.from_json(field("deleted_column_headers"), "array<string>")).alias("deleted_columns"),
        field("sample_data_rows[0].order_id").alias("sample_order"),
    )


def _archive_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = routing.archive_path(F.col("archive_folder"), F.col("file_name"), F.col("ts").cast("timestamp"))
    return outcomes(spark, sf_dir).select("event_id", path.alias("archive_path"))


def _audit_ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger rows of all files; counts exist only for files that were loaded."""
    loaded = F.col("status") == routing.SUCCESS
    counted = outcomes(spark, sf_dir).withColumns(
        {
            "ingestion_id": F.sha2(F.col("event_id").cast("string"), 256),
            "file_uri": F.concat(F.lit("landing/"), "file_name"),
            "total": F.when(loaded, F.col("user_id")),
            "bad": F.when(loaded, F.col("user_id") % 3),
            "good": F.when(loaded, F.col("user_id") - F.col("user_id") % 3),
            "target_table": F.nullif("table_ref", F.lit("")),
        }
    )
    name = f"{inputs.workspace(spark, 'audit_ingestion')}.ingestion_log"
    at = F.lit(AS_OF).cast("timestamp")
    ledger.audit_ingestion(counted, name, at, at)
    return spark.table(name).drop("data_contracts")


def _operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.table(spark, sf_dir, "events").select(
        F.lit("warehouse").alias("resource_group"),
        F.lit("table").alias("resource_type"),
        F.concat(F.lit("raw."), "event_type").alias("resource_id"),
        F.upper("event_type").alias("action_type"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("outcome_status"),
        F.when(F.col("event_type") == "signup", F.concat(F.lit("link/"), "event_id")).alias("reference_link"),
        "event_id",
        "user_id",
    )
    return ledger.operation_rows(events, "repairer", F.lit(AS_OF).cast("timestamp"), ["event_id", "user_id"])


def _audit_event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{inputs.workspace(spark, 'audit_event_log')}.ai_ops_log"
    ledger.audit_events(_operations(spark, sf_dir), name)
    return spark.table(name).drop("operation_id")


def _audit_question_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = inputs.table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("trace_id"),
        F.concat(F.lit("ask "), F.length("text").cast("string")).alias("user_intent"),
        F.lit("EXECUTED").alias("status"),
        F.col("role").alias("user_email"),
        "turn",
    )
    return ledger.question_rows(turns, F.lit(AS_OF).cast("timestamp"), ["turn"])


def _audit_backfill_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = ledger.backfill_link(_operations(spark, sf_dir), "link/late")
    return filled.select("resource_id", "change_payload", "reference_link")


# One text for both engines: messages of every shape, {S} being the text type.
MESSAGES = """CASE event_id % 8
  WHEN 0 THEN concat('{{"trace_id":"t', CAST(event_id AS {S}), '","table_ref":"raw.orders_raw","added_columns":["a","b"]}}')
  WHEN 1 THEN concat('{{"trace_id":"t', CAST(event_id AS {S}), '","new_column_headers":["c"],"deleted_column_headers":["d","e"]}}')
  WHEN 2 THEN concat('{{"trace_id":"t', CAST(event_id AS {S}), '","sample_data_rows":[{{"x":"1","y":"2"}},{{"z":"3"}}]}}')
  WHEN 3 THEN concat('{{"trace_id":"t', CAST(event_id AS {S}), '","error_message":"please DROP it","data_contracts":" nan "}}')
  WHEN 4 THEN concat('{{"trace_id":"t', CAST(event_id AS {S}), '","protoPayload":{{"status":{{}}}}}}')
  WHEN 5 THEN concat('{{"trace_id":"t', CAST(event_id AS {S}), '","data_contracts":" orders.yaml ","domain":"sales"}}')
  WHEN 6 THEN concat('{{"trace_id":"t', CAST(event_id AS {S}), '","error_message":"nothing to see"}}')
  ELSE concat('{{"trace_id":"t', CAST(event_id AS {S}), '","added_columns":[],"new_column_headers":["k"],"is_deletion":false}}')
END"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").select("ts", F.expr(MESSAGES.format(S="STRING")).alias("value"))


def _classify_drift_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drift.classify_drift_events(messages(spark, sf_dir).select("value"))
    return kept.withColumns({"added": F.array_join("added", ","), "removed": F.array_join("removed", ",")})


CLASSIFIED = f"""messages AS (SELECT ts, {MESSAGES.format(S="VARCHAR")} AS value FROM events),
parsed AS (
SELECT ts, value ->> '$.trace_id' AS trace_id, coalesce(value ->> '$.table_ref', 'unknown_table') AS table_ref,
       coalesce(value ->> '$.domain', 'unknown_domain') AS domain,
       CASE WHEN lower(trim(value ->> '$.data_contracts')) NOT IN ('', 'nan') THEN trim(value ->> '$.data_contracts') END AS data_contracts,
       CASE WHEN json_exists(value, '$.protoPayload')
            THEN coalesce(value ->> '$.protoPayload.status.message', 'BigQuery/Dataform Error Intercepted')
            ELSE coalesce(value ->> '$.error_message', 'Schema drift or general anomaly detected') END AS error_context,
       coalesce(CASE WHEN json_exists(value, '$.added_columns') THEN CAST(json_extract(value, '$.added_columns') AS VARCHAR[])
            ELSE CAST(json_extract(value, '$.new_column_headers') AS VARCHAR[]) END, []) AS listed,
       coalesce(CAST(coalesce(json_extract(value, '$.removed_columns'), json_extract(value, '$.deleted_column_headers')) AS VARCHAR[]), []) AS removed,
       coalesce(json_keys(json_extract(value, '$.sample_data_rows[0]')), []) AS sample_keys,
       coalesce(CAST(value ->> '$.is_deletion' AS BOOLEAN), false) AS flag
FROM messages
), judged AS (
SELECT *, CASE WHEN len(listed) = 0 AND len(removed) = 0 THEN sample_keys ELSE listed END AS added,
       flag OR regexp_matches(lower(error_context), 'delete|drop') AS is_deletion FROM parsed
), requests AS (
SELECT ts, trace_id, table_ref, domain, data_contracts, error_context, array_to_string(added, ',') AS added,
       array_to_string(removed, ',') AS removed, is_deletion
FROM judged WHERE len(added) > 0 OR len(removed) > 0 OR data_contracts IS NOT NULL
  OR contains(lower(error_context), 'dataform') OR is_deletion
)"""

_OUTCOMES = f"""{HEADERS}, {ROUTED}, changes AS (
SELECT event_id,
       coalesce(string_agg(column_name, ',' ORDER BY column_name) FILTER (change = 'unknown'), '') AS new_columns,
       coalesce(string_agg(column_name, ',' ORDER BY column_name) FILTER (change = 'missing'), '') AS deleted_columns,
       count(*) FILTER (change = 'unknown') AS n_new, count(*) FILTER (change = 'missing') AS n_deleted
FROM diff GROUP BY event_id
), formats AS (
SELECT *, lower(replace(CASE WHEN rule_format <> '' THEN rule_format
                             ELSE regexp_extract(file_name, '[.]([^./]*)$', 1) END, '.', '')) AS resolved,
       target_dataset || '.' || target_table AS table_ref FROM first_rule
), decided AS (
SELECT f.*, c.new_columns, c.deleted_columns, coalesce(c.n_new, 0) AS n_new, coalesce(c.n_deleted, 0) AS n_deleted,
       CASE WHEN target_table IS NULL THEN 'SKIPPED'
            WHEN resolved NOT IN ('csv', 'json', 'ndjson', 'parquet') THEN 'FAILED'
            WHEN table_ref NOT IN ('raw.clicks_any', 'raw.views') THEN 'TABLE_MISSING'
            WHEN c.event_id IS NOT NULL THEN 'DRIFT_DETECTED' ELSE 'SUCCESS' END AS status
FROM formats f LEFT JOIN changes c ON c.event_id = f.event_id
), outcomes AS (
SELECT *, CASE status WHEN 'SUCCESS' THEN 'processed' WHEN 'DRIFT_DETECTED' THEN 'schema_pending'
                      WHEN 'TABLE_MISSING' THEN 'schema_pending' ELSE 'exempted' END AS archive_folder,
       CASE status WHEN 'SKIPPED' THEN 'No matching routing rule'
                   WHEN 'FAILED' THEN 'Unsupported file format: ' || resolved
                   WHEN 'TABLE_MISSING' THEN 'Table Missing: Target table ''' || table_ref || ''' does not exist.'
                   WHEN 'DRIFT_DETECTED' THEN 'Drift Detected: Added=['
                     || CASE WHEN new_columns = '' THEN '' ELSE '''' || replace(new_columns, ',', ''', ''') || '''' END || '], Deleted=['
                     || CASE WHEN deleted_columns = '' THEN '' ELSE '''' || replace(deleted_columns, ',', ''', ''') || '''' END || ']'
       END AS error_message
FROM decided)"""

_OPERATIONS = f"""SELECT TIMESTAMP '{AS_OF}' AS timestamp, 'repairer' AS ai_agent_id, 'warehouse' AS resource_group, 'table' AS resource_type,
  concat('raw.', event_type) AS resource_id, upper(event_type) AS action_type,
  concat('{{"event_id":', CAST(event_id AS VARCHAR), ',"user_id":', CAST(user_id AS VARCHAR), '}}') AS change_payload,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS outcome_status,
  CASE WHEN event_type = 'signup' THEN concat('link/', CAST(event_id AS VARCHAR)) END AS reference_link FROM events"""

CASES = [
    Case("skip_paths", _skip_paths, f"WITH {FILES} SELECT event_id, file_name FROM kept_files"),
    Case("resolve_format", _resolve_format, f"""WITH {_OUTCOMES} SELECT event_id, file_name, resolved,
        resolved IN ('csv', 'json', 'ndjson', 'parquet') AS supported FROM formats"""),
    Case("route_files", _route_files, f"WITH {ROUTED} SELECT event_id, file_name, file_pattern, target_dataset, target_table, domain FROM first_rule"),
    Case("first_match", _first_match, f"WITH {ROUTED} SELECT target_table, count(*) AS files FROM first_rule GROUP BY target_table"),
    Case("filter_active", _filter_active, f"WITH {SUPPLIER_REGISTRY} SELECT * FROM registry WHERE is_active"),
    Case("registry_routing", _registry_routing, """SELECT CASE WHEN n_regionkey <> 2 THEN concat('nation_', CAST(n_nationkey AS VARCHAR)) END AS target_table,
        CASE WHEN n_regionkey <> 2 THEN concat('region_', CAST(n_regionkey AS VARCHAR)) END AS domain, count(*) AS files
        FROM lineitem LEFT JOIN nation ON n_nationkey = l_suppkey % 25 GROUP BY ALL"""),
    Case("registry_routing_large", _registry_routing_large, """SELECT CASE WHEN c_acctbal > 0 THEN concat('customer_', CAST(c_custkey AS VARCHAR)) END AS target_table,
        count(*) AS files FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY ALL"""),
    Case("audit_variant", _audit_variant, f"""SELECT resource_id, resource_id = 'raw.error' AS is_bad,
        CASE WHEN resource_id = 'raw.error' THEN substring(change_payload, 1, 9) END AS bad_payload,
        CASE WHEN resource_id <> 'raw.error' THEN CAST(change_payload ->> '$.event_id' AS BIGINT) END AS event_id,
        CASE WHEN resource_id <> 'raw.error' THEN CAST(change_payload ->> '$.user_id' AS BIGINT) END AS user_id, CAST(NULL AS VARCHAR) AS absent
        FROM ({_OPERATIONS}) o"""),
    Case("schema_diff", _schema_diff, f"""WITH {HEADERS} SELECT e.event_id,
        coalesce(string_agg(d.column_name, ',' ORDER BY d.column_name) FILTER (d.change = 'unknown'), '') AS new_columns,
        coalesce(string_agg(d.column_name, ',' ORDER BY d.column_name) FILTER (d.change = 'missing'), '') AS deleted_columns
        FROM events e LEFT JOIN diff d ON d.event_id = e.event_id GROUP BY e.event_id"""),
    Case("schema_diff_rows", _schema_diff_rows, f"WITH {HEADERS} SELECT event_id, column_name, change FROM diff"),
    Case("drift_outcome", _drift_outcome, f"WITH {_OUTCOMES} SELECT event_id, status, error_message, archive_folder FROM outcomes"),
    Case("drift_samples", _drift_samples, f"""WITH {_OUTCOMES} SELECT event_id, CASE WHEN contains(new_columns, 'coupon')
        THEN concat('[{{"coupon":"C', CAST(event_id AS VARCHAR), '"}}]') ELSE '[{{}}]' END AS samples
        FROM outcomes WHERE status = 'DRIFT_DETECTED'"""),
    Case("emit_drift_event", _emit_drift_event, f"""WITH {_OUTCOMES}, widths AS (SELECT event_id, count(*) AS n FROM file_columns GROUP BY event_id)
        SELECT 'SCHEMA_DRIFT_AI' AS event_type, concat('t', CAST(o.event_id AS VARCHAR)) AS trace_id, 'landing' AS bucket, file_name, table_ref, domain,
        '2024-01-07T12:00:00.000000+00:00' AS sent_at,
        CAST(CASE status WHEN 'TABLE_MISSING' THEN w.n ELSE n_new END AS INT) AS new_columns,
        CAST(CASE status WHEN 'TABLE_MISSING' THEN 0 ELSE n_deleted END AS INT) AS deleted_columns,
        CASE status WHEN 'TABLE_MISSING' THEN CAST(o.event_id AS VARCHAR) END AS sample_order
        FROM outcomes o JOIN widths w ON w.event_id = o.event_id WHERE status IN ('DRIFT_DETECTED', 'TABLE_MISSING')"""),
    Case("archive_path", _archive_path, f"""WITH {_OUTCOMES} SELECT event_id, concat(archive_folder, '/', regexp_extract(file_name, '([^/]*)$', 1), '_',
        strftime(ts, '%Y%m%d%H%M%S')) AS archive_path FROM outcomes"""),
    Case("audit_ingestion", _audit_ingestion, f"""WITH {_OUTCOMES}, counted AS (
        SELECT o.*, CASE WHEN status = 'SUCCESS' THEN e.user_id ELSE 0 END AS n FROM outcomes o JOIN events e ON e.event_id = o.event_id)
        SELECT sha256(CAST(event_id AS VARCHAR)) AS ingestion_id, file_name, concat('landing/', file_name) AS file_uri, status, n AS row_count,
        error_message, TIMESTAMP '{AS_OF}' AS start_time, TIMESTAMP '{AS_OF}' AS end_time, domain, table_ref AS target_table,
        n AS total_records, n AS processed_records, n - n % 3 AS good_records, n % 3 AS bad_records FROM counted"""),
    Case("audit_event_log", _audit_event_log, _OPERATIONS),
    Case("audit_question_log", _audit_question_log, f"""SELECT concat(CAST(conv_id AS VARCHAR), '-', CAST(turn AS VARCHAR)) AS trace_id,
        TIMESTAMP '{AS_OF}' AS timestamp, concat('ask ', CAST(length(text) AS VARCHAR)) AS user_intent, 'EXECUTED' AS status,
        concat('{{"user":"', role, '","turn":', CAST(turn AS VARCHAR), '}}') AS event_log FROM conversations"""),
    Case("audit_backfill_link", _audit_backfill_link, f"""SELECT resource_id, change_payload, coalesce(reference_link, 'link/late') AS reference_link
        FROM ({_OPERATIONS}) o"""),
    Case("classify_drift_event", _classify_drift_event, f"WITH {CLASSIFIED} SELECT * EXCLUDE (ts) FROM requests"),
]
