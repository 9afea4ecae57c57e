from __future__ import annotations

from dataclasses import replace
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.contract import orders_contract
from pactloom.operators import staging
from pactloom.operators.drift import evolve_schema
from pactloom.parity import inputs
from pactloom.parity.case import Case
from pactloom.parity.inputs import AS_OF, AS_OF_DATE, BUSINESS, WITH_RAW, WITH_STG
from pactloom.sinks import tables as sinks
from pactloom.sources import files, tables


def stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage(inputs.orders_raw(spark, sf_dir), orders_contract(), AS_OF)


def _safe_cast_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.cast_project(inputs.orders_raw(spark, sf_dir), orders_contract(), AS_OF)


def _latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.latest_per_key(inputs.orders_raw(spark, sf_dir), ["order_id"])


def _latest_per_key_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = inputs.orders_raw(spark, sf_dir).withColumn("batch_date", F.col("processed_dttm").cast("date"))
    return staging.latest_per_key(dated, ["order_id"], ["batch_date"], tie_break=["processed_dttm"])


def _latest_status_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed keys and a tie-break: the dearest of the newest orders of each warehouse and status."""
    typed = staging.cast_project(inputs.orders_raw(spark, sf_dir), orders_contract(), AS_OF)
    newest = staging.latest_per_key(typed, ["warehouse_id", "status"], ["order_date"], ["amount", "order_id"])
    return newest.select("warehouse_id", "status", "order_date", "amount", "order_id")


def _explicit_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.explicit_projection(inputs.orders_raw(spark, sf_dir), orders_contract(), ["processed_dttm"])


def _audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return staging.with_audit_columns(orders, AS_OF)


def _contract_to_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stg_orders(spark, sf_dir)
    return staged.select("order_id", "amount", "order_date", "batch_date")


def _materialize_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{inputs.workspace(spark, 'materialize_table')}.stg_orders"
    contract = orders_contract()
    sinks.materialize_table(
        stg_orders(spark, sf_dir), name, partition_by=contract.partition_by, cluster_by=contract.cluster_by
    )
    return spark.table(name)


def _scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{inputs.workspace(spark, 'scan_table')}.orders"
    tables.declare_table(spark, name, f"{sf_dir}/orders.parquet")
    return tables.scan_table(spark, name)


def _scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = files.scan_parquet(spark, f"{sf_dir}/orders.parquet")
    return rows.drop(files.SOURCE_FILE)


def _scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the raw orders as delimited text and reads them back by position."""
    target = inputs.folder(spark, "scan_csv")
    raw = inputs.orders_raw(spark, sf_dir).select(*BUSINESS)
    raw.write.mode("overwrite").options(sep="|", header="true").csv(target)
    return files.scan_csv(spark, target, BUSINESS, delimiter="|").drop(files.SOURCE_FILE)


def _scan_csv_preamble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three lines before the records of each file, one of them empty."""
    target = inputs.folder(spark, "scan_csv_preamble")
    lines = inputs.orders_raw(spark, sf_dir).select(F.to_csv(F.struct(*BUSINESS), {"sep": "|", "nullValue": "", "emptyValue": '""'}).alias("value"))
    head = pa.RecordBatch.from_pylist([{"value": line} for line in ("export of orders", "", "|".join(BUSINESS))])
    # Each task writes a file of its own.
    lines.mapInArrow(lambda batches: chain([head], batches), "value string").write.text(target)
    return files.scan_csv(spark, target, BUSINESS, delimiter="|", skip_rows=3).drop(files.SOURCE_FILE)


def keyless_contract():
    contract = orders_contract()
    return replace(contract, columns=tuple(replace(c, primary_key=False, unique=False) for c in contract.columns))


def _stage_without_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract without a key has no versions: every raw row is staged."""
    return staging.stage(inputs.orders_raw(spark, sf_dir), keyless_contract(), AS_OF)


def _scan_ndjson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second record has a nested value, which arrives as its JSON text."""
    target = inputs.folder(spark, "scan_ndjson")
    events = inputs.table(spark, sf_dir, "events")
    nested = events.select(
        "event_id",
        "event_type",
        F.when(F.col("event_id") % 2 == 0, F.struct("user_id", "event_type")).alias("detail"),
        F.lit("not wanted").alias("other"),
    )
    nested.write.mode("overwrite").json(target)
    return files.scan_ndjson(spark, target, ["event_id", "event_type", "detail"]).drop(files.SOURCE_FILE)


def _sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.sample_rows(inputs.table(spark, sf_dir, "orders"))


def _scan_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{inputs.workspace(spark, 'scan_registry')}.ingestion_master"
    inputs.supplier_registry(spark, sf_dir).write.mode("overwrite").saveAsTable(name, format="parquet")
    return tables.scan_registry(spark, name)


def _evolve_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evolve_schema(inputs.orders_raw(spark, sf_dir), ["coupon", "amount", "channel"], ["status"])


RAW_COLUMNS = ", ".join([*BUSINESS, "batch_date", "processed_dttm"])

CASES = [
    Case("latest_per_key", _latest_per_key, WITH_RAW + f"""SELECT {RAW_COLUMNS} FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY processed_dttm DESC) AS rn FROM orders_raw) t WHERE rn = 1"""),
    Case("latest_per_key_by_date", _latest_per_key_by_date, WITH_RAW + f"""SELECT {', '.join(BUSINESS)}, batch_date, processed_dttm FROM (
        SELECT * EXCLUDE (batch_date, d), d AS batch_date,
               row_number() OVER (PARTITION BY order_id ORDER BY d DESC, processed_dttm DESC) AS rn
        FROM (SELECT *, CAST(processed_dttm AS DATE) AS d FROM orders_raw) s) t WHERE rn = 1"""),
    Case("latest_per_key_tie_break", _latest_status_per_customer, WITH_RAW + """, typed AS (
        SELECT TRY_CAST(order_id AS BIGINT) AS order_id, TRY_CAST(amount AS DECIMAL(38,9)) AS amount, status,
               TRY_CAST(order_date AS DATE) AS order_date, TRY_CAST(warehouse_id AS BIGINT) AS warehouse_id FROM orders_raw)
        SELECT warehouse_id, status, order_date, amount, order_id FROM (
          SELECT *, row_number() OVER (PARTITION BY warehouse_id, status
            ORDER BY order_date DESC NULLS LAST, amount DESC NULLS LAST, order_id DESC NULLS LAST) AS rn FROM typed) t
        WHERE rn = 1"""),
    Case("staging_build", stg_orders, WITH_STG + "SELECT * FROM stg_orders"),
    Case("contract_to_select", _contract_to_select, WITH_STG + "SELECT order_id, amount, order_date, batch_date FROM stg_orders"),
    Case("safe_cast_project", _safe_cast_project, WITH_RAW + f"""SELECT TRY_CAST(order_id AS BIGINT) AS order_id, customer_name,
        TRY_CAST(amount AS DECIMAL(38,9)) AS amount, status, TRY_CAST(order_date AS DATE) AS order_date,
        TRY_CAST(warehouse_id AS BIGINT) AS warehouse_id, DATE '{AS_OF_DATE}' AS batch_date, processed_dttm,
        TIMESTAMP '{AS_OF}' AS updated_dttm FROM orders_raw"""),
    Case("explicit_projection", _explicit_projection, WITH_RAW + f"SELECT {', '.join(BUSINESS)}, processed_dttm FROM orders_raw"),
    Case("audit_columns", _audit_columns, f"""SELECT o_orderkey, o_orderstatus, DATE '{AS_OF_DATE}' AS batch_date,
        TIMESTAMP '{AS_OF}' AS updated_dttm FROM orders"""),
    Case("materialize_table", _materialize_table, WITH_STG + "SELECT * FROM stg_orders"),
    Case("scan_table", _scan_table, "SELECT * FROM orders"),
    Case("scan_parquet", _scan_parquet, """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
        o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
        o_orderpriority FROM orders"""),
    Case("scan_csv", _scan_csv, WITH_RAW + f"SELECT {', '.join(BUSINESS)} FROM orders_raw"),
    Case("scan_csv_preamble", _scan_csv_preamble, WITH_RAW + f"SELECT {', '.join(BUSINESS)} FROM orders_raw"),
    Case("stage_without_key", _stage_without_key, WITH_RAW + f"""SELECT TRY_CAST(order_id AS BIGINT) AS order_id, customer_name,
        TRY_CAST(amount AS DECIMAL(38,9)) AS amount, status, TRY_CAST(order_date AS DATE) AS order_date, TRY_CAST(warehouse_id AS BIGINT) AS warehouse_id,
        DATE '{AS_OF_DATE}' AS batch_date, processed_dttm, TIMESTAMP '{AS_OF}' AS updated_dttm FROM orders_raw"""),
    Case("scan_ndjson", _scan_ndjson, """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
        CASE WHEN event_id % 2 = 0 THEN concat('{"user_id":', CAST(user_id AS VARCHAR), ',"event_type":"', event_type, '"}') END AS detail
        FROM events"""),
    Case("sample_rows", _sample_rows),
    Case("scan_registry", _scan_registry, f"WITH {inputs.SUPPLIER_REGISTRY} SELECT * FROM registry WHERE is_active"),
    Case("evolve_schema", _evolve_schema, WITH_RAW + """SELECT order_id, customer_name, amount, order_date, warehouse_id,
        CAST(NULL AS VARCHAR) AS coupon, CAST(NULL AS VARCHAR) AS channel, batch_date, processed_dttm FROM orders_raw"""),
]
