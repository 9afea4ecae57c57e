"""Inputs derived from the test tables: for Spark as DataFrames, for the check as SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.session import scratch_root

AS_OF = "2024-01-07 12:00:00"
AS_OF_DATE = "2024-01-07"
STALE = "2024-01-09 00:00:00"
SECOND_LOAD = "2024-01-03 00:00:00"

BUSINESS = ["order_id", "customer_name", "amount", "status", "order_date", "warehouse_id"]

ACCEPTED = "('COMPLETED', 'PENDING', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'RETURNED')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession, name: str) -> str:
    """A new database for one run of a query that writes tables, under the shared folder."""
    database = f"pactloom_{name}_{uuid.uuid4().hex[:8]}"
    location = f"{scratch_root(spark)}/warehouse/{database}.db"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    return database


def folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run of a query that writes files."""
    return f"{scratch_root(spark)}/files/{name}-{uuid.uuid4().hex[:8]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table, for queries that read it more than once, as they would in use."""
    target = folder(df.sparkSession, name)
    df.write.parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty text rows of the orders; every tenth order has a later version."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    k, v = F.col("o_orderkey"), F.col("v")
    versions = F.when(k % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    hours = k % 48 + F.when(v == 2, 100).otherwise(0)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    joined = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return joined.withColumn("v", F.explode(versions)).select(
        F.when(k % 97 == 0, F.concat(F.lit("X"), k.cast("string"))).otherwise(k.cast("string")).alias("order_id"),
        F.when(k % 53 == 0, None).when(k % 59 == 0, "").otherwise(F.col("c_name")).alias("customer_name"),
        F.when(k % 41 == 0, "N/A")
        .when(k % 43 == 0, "-5.00")
        .when(k % 47 == 0, "2000000.00")
        .otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .alias("amount"),
        F.when(v == 2, "DELIVERED")
        .when(k % 61 == 0, "UNKNOWN")
        .when(k % 67 == 0, "completed")
        .when(F.col("o_orderstatus") == "F", "COMPLETED")
        .when(F.col("o_orderstatus") == "O", "PENDING")
        .otherwise("SHIPPED")
        .alias("status"),
        F.when(k % 71 == 0, "2024-13-45").otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("order_date"),
        (F.col("o_custkey") % 10).cast("string").alias("warehouse_id"),
        F.lit("9999-12-31").cast("date").alias("batch_date"),
        F.timestamp_add("HOUR", hours.cast("int"), start).alias("processed_dttm"),
    )


ORDERS_RAW = """orders_raw AS (
SELECT CASE WHEN k % 97 = 0 THEN concat('X', CAST(k AS VARCHAR)) ELSE CAST(k AS VARCHAR) END AS order_id,
       CASE WHEN k % 53 = 0 THEN NULL WHEN k % 59 = 0 THEN '' ELSE c_name END AS customer_name,
       CASE WHEN k % 41 = 0 THEN 'N/A' WHEN k % 43 = 0 THEN '-5.00' WHEN k % 47 = 0 THEN '2000000.00'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
       CASE WHEN v = 2 THEN 'DELIVERED' WHEN k % 61 = 0 THEN 'UNKNOWN' WHEN k % 67 = 0 THEN 'completed'
            WHEN o_orderstatus = 'F' THEN 'COMPLETED' WHEN o_orderstatus = 'O' THEN 'PENDING'
            ELSE 'SHIPPED' END AS status,
       CASE WHEN k % 71 = 0 THEN '2024-13-45' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
       CAST(o_custkey % 10 AS VARCHAR) AS warehouse_id,
       DATE '9999-12-31' AS batch_date,
       TIMESTAMP '2024-01-01 00:00:00'
         + INTERVAL '1' HOUR * CAST(k % 48 + CASE WHEN v = 2 THEN 100 ELSE 0 END AS INT) AS processed_dttm
FROM (SELECT o.o_orderkey AS k, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, c.c_name, r.v
      FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
      JOIN (SELECT 1 AS v UNION ALL SELECT 2) r ON r.v = 1 OR o.o_orderkey % 10 = 0) z
)"""


def typed_sql(name: str, source: str, as_of: str = AS_OF) -> str:
    """Newest version of each raw key of ``source``, cast to the contract's types."""
    return f"""{name} AS (
SELECT TRY_CAST(order_id AS BIGINT) AS order_id, customer_name, TRY_CAST(amount AS DECIMAL(38,9)) AS amount, status,
       TRY_CAST(order_date AS DATE) AS order_date, TRY_CAST(warehouse_id AS BIGINT) AS warehouse_id,
       DATE '{as_of[:10]}' AS batch_date, processed_dttm, TIMESTAMP '{as_of}' AS updated_dttm
FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY processed_dttm DESC) AS rn FROM {source}) t
WHERE rn = 1
)"""


STG_ORDERS = typed_sql("stg_orders", "orders_raw")
WITH_RAW = f"WITH {ORDERS_RAW}\n"
WITH_STG = f"WITH {ORDERS_RAW}, {STG_ORDERS}\n"


def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file name per event, some in folders of handled files, with mixed extensions."""
    e = F.col("event_id")
    place = F.when(e % 29 == 0, "processed/").when(e % 31 == 0, "myprocessed/").otherwise("in/")
    ending = (
        F.when(e % 37 == 0, "/").when(e % 5 == 0, ".json").when(e % 7 == 0, ".PARQUET").when(e % 17 == 0, ".avro")
    ).otherwise(".csv")
    name = F.concat(place, "event_type", F.lit("_"), e.cast("string"), ending)
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", name.alias("file_name"))


FILES = """files AS (
SELECT event_id, ts, concat(
         CASE WHEN event_id % 29 = 0 THEN 'processed/' WHEN event_id % 31 = 0 THEN 'myprocessed/' ELSE 'in/' END,
         event_type, '_', CAST(event_id AS VARCHAR),
         CASE WHEN event_id % 37 = 0 THEN '/' WHEN event_id % 5 = 0 THEN '.json' WHEN event_id % 7 = 0 THEN '.PARQUET'
              WHEN event_id % 17 = 0 THEN '.avro' ELSE '.csv' END) AS file_name
FROM events
), kept_files AS (
SELECT * FROM files
WHERE file_name <> '' AND NOT ends_with(file_name, '/') AND NOT contains(file_name, 'processed/')
  AND NOT contains(file_name, 'exempted/') AND NOT contains(file_name, 'schema_pending/')
)"""

# The routing rules of the check, in both dialects.
RULES_VALUES = """(VALUES
  ('click_[0-9]+[.]csv$',       'raw', 'clicks',     'web',   NULL,  true),
  ('click_',                    'raw', 'clicks_any', 'web',   NULL,  true),
  ('purchase_.*[.](csv|json)$', 'raw', 'purchases',  'sales', 'csv', true),
  ('^in/view_',                 'raw', 'views',      'web',   NULL,  true),
  ('signup_',                   'raw', 'signups',    'crm',   NULL,  false)
) AS t(file_pattern, target_dataset, target_table, domain, file_format, is_active)"""


def rules(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM {RULES_VALUES}")


RULES = f"rules AS (SELECT * FROM {RULES_VALUES})"

ROUTED = f"""{FILES}, {RULES}, routed AS (
SELECT f.event_id, f.ts, f.file_name, r.file_pattern, r.target_dataset, r.target_table, r.domain,
       r.file_format AS rule_format,
       row_number() OVER (PARTITION BY f.event_id ORDER BY r.file_pattern) AS rn
FROM kept_files f LEFT JOIN rules r ON r.is_active AND regexp_matches(f.file_name, r.file_pattern)
), first_rule AS (SELECT * EXCLUDE (rn) FROM routed WHERE rn = 1)"""


def supplier_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry with one rule per supplier; suppliers in debt are switched off."""
    s = F.col("s_suppkey").cast("string")
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("^in/supplier_"), s, F.lit("_")).alias("file_pattern"),
        F.lit("raw").alias("target_dataset"),
        F.concat(F.lit("supplier_"), s, F.lit("_raw")).alias("target_table"),
        F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string")).alias("domain"),
        (F.col("s_acctbal") > 0).alias("is_active"),
    )


SUPPLIER_REGISTRY = """registry AS (
SELECT concat('^in/supplier_', CAST(s_suppkey AS VARCHAR), '_') AS file_pattern, 'raw' AS target_dataset,
       concat('supplier_', CAST(s_suppkey AS VARCHAR), '_raw') AS target_table,
       concat('nation_', CAST(s_nationkey AS VARCHAR)) AS domain, s_acctbal > 0 AS is_active
FROM supplier
)"""


def headers(event_id: str = "event_id") -> Column:
    """Column names of the file of an event: some gain ``coupon`` or ``Amount``, some lose ``status``."""
    e = F.col(event_id)
    names = [F.lit(c) for c in BUSINESS if c != "status"]
    optional = [
        F.when(e % 13 == 0, F.lit("coupon")),
        F.when(e % 19 == 0, F.lit("Amount")),
        F.when(e % 11 != 0, F.lit("status")),
    ]
    return F.array_compact(F.array(*names, *optional))


def file_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    table_ref = F.concat(F.lit("raw."), "event_type").alias("table_ref")
    return table(spark, sf_dir, "events").select("event_id", table_ref, headers().alias("headers"))


def table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table per event type, all with the columns of the orders."""
    names = [F.lit(c) for c in [*BUSINESS, "batch_date", "processed_dttm"]]
    kinds = table(spark, sf_dir, "events").select("event_type").distinct()
    return kinds.select(F.concat(F.lit("raw."), "event_type").alias("table_ref"), F.array(*names).alias("columns"))


HEADERS = """file_columns AS (
SELECT e.event_id, c.column_name
FROM events e CROSS JOIN (VALUES ('order_id'), ('customer_name'), ('amount'), ('status'), ('order_date'),
                                 ('warehouse_id'), ('coupon'), ('Amount')) AS c(column_name)
WHERE (c.column_name <> 'coupon' OR e.event_id % 13 = 0)
  AND (c.column_name <> 'Amount' OR e.event_id % 19 = 0)
  AND (c.column_name <> 'status' OR e.event_id % 11 <> 0)
), table_columns AS (
SELECT * FROM (VALUES ('order_id'), ('customer_name'), ('amount'), ('status'), ('order_date'), ('warehouse_id')) AS t(column_name)
), diff AS (
SELECT f.event_id, f.column_name, 'unknown' AS change FROM file_columns f
WHERE f.column_name NOT IN (SELECT column_name FROM table_columns)
UNION ALL
SELECT e.event_id, t.column_name, 'missing' AS change FROM events e CROSS JOIN table_columns t
WHERE NOT EXISTS (SELECT 1 FROM file_columns f WHERE f.event_id = e.event_id AND f.column_name = t.column_name)
)"""
