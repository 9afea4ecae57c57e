from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.contract import orders_contract
from pactloom.operators import mart
from pactloom.operators.drift import AUDIT_FIELDS
from pactloom.operators.staging import stage, with_audit_columns
from pactloom.parity import inputs
from pactloom.parity.case import Case
from pactloom.parity.inputs import AS_OF, AS_OF_DATE, BUSINESS, ORDERS_RAW, SECOND_LOAD, STG_ORDERS, WITH_RAW, typed_sql
from pactloom.parity.staging import keyless_contract, stg_orders
from pactloom.plans import entity
from pactloom.sinks import tables as sinks
from pactloom.sources.tables import create_table

FIRST_AS_OF = "2024-01-03 12:00:00"
FIRST_DATE = FIRST_AS_OF[:10]

RAW_FIELDS = [{"name": c, "type": "STRING", "mode": "NULLABLE", "defaultValueExpression": "NULL"} for c in BUSINESS]
RAW_FIELDS += list(AUDIT_FIELDS)


def first_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mart as the first load left it."""
    first = inputs.orders_raw(spark, sf_dir).where(F.col("processed_dttm") < F.lit(SECOND_LOAD).cast("timestamp"))
    return stage(first, orders_contract(), FIRST_AS_OF)


def _second_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_audit_columns(stg_orders(spark, sf_dir), AS_OF)


def _incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.incremental_filter(stg_orders(spark, sf_dir), first_mart(spark, sf_dir))


def _incremental_filter_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.incremental_filter(stg_orders(spark, sf_dir), first_mart(spark, sf_dir).where("false"))


def _incremental_filter_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.incremental_filter(
        stg_orders(spark, sf_dir), first_mart(spark, sf_dir), "batch_date", floor="1970-01-01"
    )


def _incremental_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = mart.high_water(first_mart(spark, sf_dir))
    return stg_orders(spark, sf_dir).select("order_id", "processed_dttm", mark.alias("high_water"))


def _mart_table(spark: SparkSession, sf_dir: str, name: str) -> str:
    table = f"{inputs.workspace(spark, name)}.fct_orders"
    sinks.materialize_table(first_mart(spark, sf_dir), table, cluster_by=orders_contract().cluster_by)
    return table


def _incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _mart_table(spark, sf_dir, "incremental_append")
    sinks.incremental_append(_second_load(spark, sf_dir), table)
    return spark.table(table)


def _incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _mart_table(spark, sf_dir, "incremental_merge")
    sinks.incremental_merge(_second_load(spark, sf_dir), table, orders_contract().key)
    return spark.table(table)


def _upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = inputs.stored(first_mart(spark, sf_dir), "upsert_target")
    batch = inputs.stored(mart.incremental_filter(stg_orders(spark, sf_dir), target), "upsert_batch")
    return mart.upsert_by_key(target, batch, ["order_id"])


def _raw_table(spark: SparkSession, database: str, name: str = "orders_raw") -> str:
    table = f"{database}.{name}"
    create_table(spark, table, RAW_FIELDS, partition_by="batch_date")
    return table


def _raw_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.orders_raw(spark, sf_dir).select(*BUSINESS)


def _append_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches into one raw table; the second lacks a column."""
    table = _raw_table(spark, inputs.workspace(spark, "append_raw"))
    sinks.append_raw(_raw_batch(spark, sf_dir), table, FIRST_AS_OF)
    sinks.append_raw(_raw_batch(spark, sf_dir).drop("status"), table, AS_OF)
    return spark.table(table)


def _replace_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _raw_table(spark, inputs.workspace(spark, "replace_raw"))
    sinks.append_raw(_raw_batch(spark, sf_dir), table, FIRST_AS_OF)
    sinks.replace_raw(_raw_batch(spark, sf_dir), table, AS_OF)
    return spark.table(table)


def _staged_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _raw_table(spark, inputs.workspace(spark, "staged_load"))
    sinks.staged_load(_raw_batch(spark, sf_dir), table, lambda staged: sinks.append_raw(staged, table, AS_OF))
    return spark.table(table)


def _create_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns an insert leaves out take the defaults of the table schema."""
    table = _raw_table(spark, inputs.workspace(spark, "create_table"))
    inputs.orders_raw(spark, sf_dir).select("order_id", "amount").createOrReplaceTempView("pactloom_new_orders")
    spark.sql(f"INSERT INTO {table} (order_id, amount) SELECT order_id, amount FROM pactloom_new_orders")
    filled = F.col("processed_dttm").isNotNull().alias("has_time")
    return spark.table(table).select("order_id", "amount", "status", "batch_date", filled)


def _history(spark: SparkSession, sf_dir: str, name: str, business: list[str] | None) -> DataFrame:
    """History after the first rows were archived and all raw rows came back once more."""
    database = inputs.workspace(spark, name)
    raw, history = _raw_table(spark, database), _raw_table(spark, database, "orders_raw_hist")
    rows = inputs.orders_raw(spark, sf_dir)
    early = rows.where(F.col("processed_dttm") < F.lit(SECOND_LOAD).cast("timestamp"))
    sinks.raw_rows(early, spark.table(raw).columns).write.insertInto(raw)
    sinks.archive_history(spark, raw, history, FIRST_DATE, business_columns=business)
    sinks.raw_rows(rows, spark.table(raw).columns).write.insertInto(raw)
    sinks.archive_history(spark, raw, history, AS_OF_DATE, business_columns=business)
    return spark.table(history).unionByName(spark.table(raw))


def _archive_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, "archive_history", None)


def _archive_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(spark, sf_dir, "archive_idempotent", BUSINESS)


def _entity_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs; rows with the stamps of those taken land between all steps of the first, older ones too."""
    database = inputs.workspace(spark, "entity_run")
    contract = orders_contract()
    names = entity.EntityTables(*(f"{database}.{n}" for n in ("orders_raw", "orders_raw_hist", "stg_orders", "fct_orders", "checks")))
    for name in (names.raw, names.history):
        create_table(spark, name, RAW_FIELDS, partition_by="batch_date")
    part = (F.coalesce(F.expr("try_cast(order_id AS BIGINT)"), F.lit(0)) % 5).cast("int")
    parted = inputs.orders_raw(spark, sf_dir).withColumn("part", part)
    landing = inputs.folder(spark, "entity_rows")
    # By part, so that each landing reads its own rows.
    parted.write.partitionBy("part").parquet(landing)
    rows = spark.read.schema(parted.schema).parquet(landing)

    def land(i: int) -> None:
        sinks.raw_rows(rows.where(F.col("part") == i), spark.table(names.raw).columns).write.insertInto(names.raw)

    land(0)
    entity.begin(spark, names)
    land(1)
    entity.refresh_staging(spark, names, contract, AS_OF, snapshot=True)
    land(2)
    entity.take_staging(spark, names, contract, AS_OF)
    land(3)
    entity.run_checks(spark, names, contract, AS_OF)
    land(4)
    entity.archive(spark, names, contract, AS_OF_DATE)
    entity.run_entity(spark, names, contract, AS_OF)
    text = F.concat_ws("|", F.coalesce(F.col("order_id").cast("string"), F.lit("")), "status").alias("row_text")
    sides = [spark.table(t).select(F.lit(s).alias("side"), text, "batch_date", "processed_dttm") for s, t in (("mart", names.mart), ("history", names.history), ("raw", names.raw))]
    return sides[0].unionByName(sides[1]).unionByName(sides[2])


def _incremental_merge_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows up to two days before the mark are taken once more, and replace those of their keys."""
    table = _mart_table(spark, sf_dir, "incremental_merge_lookback")
    sinks.incremental_merge(_second_load(spark, sf_dir), table, orders_contract().key, lookback=timedelta(hours=30))
    return spark.table(table)


def _upsert_duplicate_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with all versions of a key: the newest counts."""
    target = inputs.stored(first_mart(spark, sf_dir), "upsert_target")
    raw = inputs.orders_raw(spark, sf_dir)
    every = stage(raw, keyless_contract(), AS_OF)
    return mart.upsert_by_key(target, inputs.stored(every, "upsert_batch"), ["order_id"])


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 60).cast("int"))
    return inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", day.alias("batch_date"))


def _partition_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"{inputs.workspace(spark, 'partition_retention')}.orders_hist"
    sinks.materialize_table(_dated_orders(spark, sf_dir), table)
    sinks.expire_partitions(spark, table, "2024-03-01")
    return spark.table(table)


def _retained_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart.retained(_dated_orders(spark, sf_dir), "2024-03-01")


def _union_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = stg_orders(spark, sf_dir)
    return mart.append_rows(target, inputs.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id")))


STG = "order_id, customer_name, amount, status, order_date, warehouse_id, batch_date, processed_dttm, updated_dttm"
_FIRST_RAW = f"first_raw AS (SELECT * FROM orders_raw WHERE processed_dttm < TIMESTAMP '{SECOND_LOAD}')"
WITH_MART = f"WITH {ORDERS_RAW}, {STG_ORDERS}, {_FIRST_RAW}, {typed_sql('fct_orders', 'first_raw', FIRST_AS_OF)}\n"
_MARK = "(SELECT COALESCE(MAX(processed_dttm), TIMESTAMP '1970-01-01 00:00:00') FROM fct_orders)"
_NEW = f"SELECT {STG} FROM stg_orders WHERE processed_dttm > {_MARK}"
_MERGED = f"""SELECT {STG} FROM fct_orders t
    WHERE NOT EXISTS (SELECT 1 FROM ({_NEW}) s WHERE s.order_id = t.order_id) UNION ALL {_NEW}"""
_B = ", ".join(BUSINESS)
_DATED = "SELECT o_orderkey, o_custkey, CAST(DATE '2024-01-01' + CAST(o_orderkey % 60 AS INT) AS DATE) AS batch_date FROM orders"
_KEPT = f"SELECT * FROM ({_DATED}) t WHERE batch_date > DATE '2024-03-01' - INTERVAL '30' DAY"


def _loaded(as_of: str, columns: str = _B) -> str:
    return f"SELECT {columns}, DATE '9999-12-31' AS batch_date, TIMESTAMP '{as_of}' AS processed_dttm FROM orders_raw"


CASES = [
    Case("incremental_filter", _incremental_filter, WITH_MART + _NEW),
    Case("incremental_filter_empty_target", _incremental_filter_empty, WITH_MART + f"SELECT {STG} FROM stg_orders WHERE processed_dttm > TIMESTAMP '1970-01-01 00:00:00'"),
    Case("incremental_filter_by_date", _incremental_filter_by_date, WITH_MART + f"SELECT {STG} FROM stg_orders WHERE batch_date > (SELECT MAX(batch_date) FROM fct_orders)"),
    Case("incremental_scalar", _incremental_scalar, WITH_MART + f"SELECT order_id, processed_dttm, {_MARK} AS high_water FROM stg_orders"),
    Case("incremental_append", _incremental_append, WITH_MART + f"SELECT {STG} FROM fct_orders UNION ALL {_NEW}"),
    Case("incremental_merge", _incremental_merge, WITH_MART + _MERGED),
    Case("upsert_by_key", _upsert_by_key, WITH_MART + _MERGED),
    Case("append_raw", _append_raw, WITH_RAW + _loaded(FIRST_AS_OF) + " UNION ALL "
         + _loaded(AS_OF, _B.replace("status", "CAST(NULL AS VARCHAR) AS status"))),
    Case("replace_raw", _replace_raw, WITH_RAW + _loaded(AS_OF)),
    Case("staged_load", _staged_load, WITH_RAW + _loaded(AS_OF)),
    Case("create_table", _create_table, WITH_RAW + "SELECT order_id, amount, CAST(NULL AS VARCHAR) AS status, DATE '9999-12-31' AS batch_date, true AS has_time FROM orders_raw"),
    Case("archive_history", _archive_history, WITH_MART + f"""SELECT {_B}, DATE '{FIRST_DATE}' AS batch_date, processed_dttm FROM first_raw
        UNION ALL SELECT {_B}, DATE '{AS_OF_DATE}', processed_dttm FROM orders_raw"""),
    Case("archive_idempotent", _archive_idempotent, WITH_MART + f"""SELECT {_B}, DATE '{FIRST_DATE}' AS batch_date, processed_dttm FROM first_raw
        UNION ALL SELECT {_B}, DATE '{AS_OF_DATE}', processed_dttm FROM orders_raw WHERE processed_dttm >= TIMESTAMP '{SECOND_LOAD}'"""),
    Case("entity_run", _entity_run, WITH_RAW.rstrip() + f""", {STG_ORDERS}
        SELECT 'mart' AS side, concat(coalesce(CAST(order_id AS VARCHAR), ''), '|', status) AS row_text, batch_date, processed_dttm FROM stg_orders
        UNION ALL SELECT 'history', concat(order_id, '|', status), DATE '{AS_OF_DATE}', processed_dttm FROM orders_raw"""),
    Case("incremental_merge_lookback", _incremental_merge_lookback, WITH_MART + _MERGED.replace(_NEW, _NEW.replace(_MARK, f"{_MARK} - INTERVAL '30' HOUR"))),
    Case("upsert_duplicate_batch", _upsert_duplicate_batch, WITH_MART + f"""SELECT {STG} FROM stg_orders WHERE order_id IS NOT NULL
        UNION ALL SELECT {STG} FROM fct_orders WHERE order_id IS NULL
        UNION ALL SELECT TRY_CAST(order_id AS BIGINT), customer_name, TRY_CAST(amount AS DECIMAL(38,9)), status, TRY_CAST(order_date AS DATE),
          TRY_CAST(warehouse_id AS BIGINT), DATE '{AS_OF_DATE}', processed_dttm, TIMESTAMP '{AS_OF}' FROM orders_raw WHERE TRY_CAST(order_id AS BIGINT) IS NULL"""),
    Case("partition_retention", _partition_retention, _KEPT),
    Case("retained_rows", _retained_rows, _KEPT),
    Case("union_append", _union_append, WITH_MART + f"""SELECT {STG} FROM stg_orders
        UNION ALL BY NAME SELECT o_orderkey AS order_id FROM orders"""),
]
