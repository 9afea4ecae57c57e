from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.contract import Rules, contract_rules, orders_contract
from pactloom.functions import predicates
from pactloom.operators import profile, quality
from pactloom.parity import inputs
from pactloom.parity.case import Case
from pactloom.parity.inputs import ACCEPTED, AS_OF, BUSINESS, STALE, WITH_RAW, WITH_STG
from pactloom.parity.staging import stg_orders
from pactloom.plans.entity import check_report

RULES = contract_rules
NON_NULL = ["order_id", "customer_name", "amount", "order_date", "warehouse_id", "batch_date", "processed_dttm"]
BLANK = " OR ".join(f"COALESCE(CAST({c} AS VARCHAR), '') = ''" for c in BUSINESS)
STG = "order_id, customer_name, amount, status, order_date, warehouse_id, batch_date, processed_dttm, updated_dttm"


def _rules():
    return contract_rules(orders_contract())


def _where(condition):
    return lambda spark, sf_dir: stg_orders(spark, sf_dir).where(condition())


def _raw_where(condition):
    return lambda spark, sf_dir: inputs.orders_raw(spark, sf_dir).where(condition())


def _quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_counts(inputs.orders_raw(spark, sf_dir), BUSINESS)


def _quality_counts_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_counts(inputs.orders_raw(spark, sf_dir), BUSINESS, by=["warehouse_id"])


def _global_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.orders_raw(spark, sf_dir).agg(F.max("processed_dttm").alias("newest"))


def _freshness(as_of: str):
    return lambda spark, sf_dir: quality.freshness_breach(stg_orders(spark, sf_dir), 24, as_of)


def _completeness_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.orders_raw(spark, sf_dir)
    return quality.completeness(raw, ~predicates.any_blank(BUSINESS))


def _assert_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.orders_raw(spark, sf_dir)
    return quality.completeness_breach(raw, ~predicates.any_blank(BUSINESS), 98.0)


def _unique_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(inputs.orders_raw(spark, sf_dir), ["order_id"])


def _assert_unique_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(stg_orders(spark, sf_dir), _rules().unique_keys[0])


def _assert_non_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failing_non_null(stg_orders(spark, sf_dir), NON_NULL)


def _assert_row_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failing_conditions(stg_orders(spark, sf_dir), _rules())


def _assert_custom_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.failing_sql(stg_orders(spark, sf_dir), "status <> 'DELIVERED' OR processed_dttm >= '2024-01-06'")


def _assertion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assertion_report(inputs.stored(stg_orders(spark, sf_dir), "assertion_report"), _rules())


def _assert_unique_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two unique columns, each checked on its own."""
    contract = orders_contract()
    named = ("order_id", "customer_name")
    columns = tuple(replace(c, primary_key=False, unique=c.name in named, not_null=False, tests=()) for c in contract.columns)
    rules = contract_rules(replace(contract, columns=columns))
    staged = inputs.stored(stg_orders(spark, sf_dir), "assert_unique_each")
    return quality.assertion_report(staged, rules).where("rule_type = 'uniqueKey'")


def _report_unique_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that are a key and nothing else."""
    return quality.assertion_report(inputs.orders_raw(spark, sf_dir), Rules((), (("order_id",),), ()))


def _check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = inputs.stored(stg_orders(spark, sf_dir), "check_report")
    return check_report(staged, "stg_orders", orders_contract(), STALE)


def _quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = quality.quarantine_split(inputs.orders_raw(spark, sf_dir), BUSINESS)
    return good.withColumn("side", F.lit("good")).unionByName(bad.withColumn("side", F.lit("bad")))


def _column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = profile.column_stats(inputs.orders_raw(spark, sf_dir), BUSINESS)
    return stats.drop("approx_distinct", "float64", "timestamp")


def _profile_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract drafted for the orders as text, as a table."""
    orders = inputs.table(spark, sf_dir, "orders")
    text = orders.select(
        F.concat(F.lit("ORD-"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("order_ref"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("amount"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
        F.when(F.col("o_custkey") % 5 == 0, "").otherwise(F.col("o_custkey").cast("string")).alias("buyer"),
    )
    return profile.contract_rows(text, profile.profile_contract(text, "orders_text"))


def _report_sql() -> str:
    parts = [f"SELECT 'nonNull' AS rule_type, '{c}' AS rule_name, count(*) FILTER ({c} IS NULL) AS failing_rows FROM stg_orders" for c in NON_NULL]
    conditions = [
        ("amount >= 0 AND amount <= 1000000", "amount >= 0 AND amount <= 1000000"),
        ("status IN " + ACCEPTED, "status IN " + ACCEPTED),
    ]
    for name, condition in conditions:
        quoted = name.replace("'", "''")
        parts.append(f"SELECT 'rowCondition', '{quoted}', count(*) FILTER (NOT ({condition})) FROM stg_orders")
    parts.append("""SELECT 'uniqueKey', 'order_id', (SELECT count(*) FROM
        (SELECT order_id FROM stg_orders GROUP BY order_id HAVING count(*) > 1) d)""")
    return "\nUNION ALL ".join(parts)


def _stats_sql() -> str:
    parts = []
    for c in BUSINESS:
        v = f"(CASE WHEN lower(trim({c})) NOT IN ('', 'nan') THEN trim({c}) END)"
        parts.append(f"""SELECT '{c}' AS column_name, count(*) AS row_count, count({v}) AS filled,
          count(CASE WHEN regexp_full_match({v}, '[+-]?[0-9]+') THEN TRY_CAST({v} AS BIGINT) END) AS int64,
          count(TRY_CAST({v} AS DECIMAL(38,9))) AS "numeric",
          count(CASE WHEN lower({v}) IN ('true', 'false') THEN 1 END) AS bool, count(TRY_CAST({v} AS DATE)) AS date,
          min(TRY_CAST({v} AS DECIMAL(38,9))) AS min_number, max(TRY_CAST({v} AS DECIMAL(38,9))) AS max_number
          FROM orders_raw""")
    return f"""SELECT *, CASE WHEN filled = 0 THEN 'STRING' WHEN int64 = filled THEN 'INT64' WHEN "numeric" = filled THEN 'NUMERIC'
      WHEN bool = filled THEN 'BOOL' WHEN date = filled THEN 'DATE' ELSE 'STRING' END AS inferred_type
      FROM ({' UNION ALL '.join(parts)}) s"""


_PROFILE_SQL = """
WITH t AS (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END AS buyer FROM orders)
SELECT 'order_ref' AS column_name, 'STRING' AS type, true AS primary_key, true AS not_null, true AS is_unique,
       'regex ^ORD-[0-9]{9,9}$' AS tests, false AS is_partition FROM t HAVING count(*) = count(DISTINCT o_orderkey)
UNION ALL SELECT 'order_id', 'INT64', false, true, true,
       concat('range ', CAST(min(o_orderkey) AS VARCHAR), '..', CAST(max(o_orderkey) AS VARCHAR)), false FROM t
UNION ALL SELECT 'priority', 'STRING', false, true, false, concat('values ', string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority)), false FROM t
UNION ALL SELECT 'amount', 'NUMERIC', false, true, false,
       concat('range ', rtrim(rtrim(CAST(min(amount) AS VARCHAR), '0'), '.'), '..', rtrim(rtrim(CAST(max(amount) AS VARCHAR), '0'), '.')), false FROM t
UNION ALL SELECT 'order_date', 'DATE', false, true, false, '', true FROM t HAVING count(o_orderdate) = count(*)
UNION ALL SELECT 'buyer', 'INT64', false, false, false,
       concat('range ', CAST(min(buyer) AS VARCHAR), '..', CAST(max(buyer) AS VARCHAR)), false FROM t
"""

_BREACH = "'Freshness Breach: Max processed_dttm is older than 24 hours' AS failure_reason, MAX(processed_dttm) AS last_processed_at"

CASES = [
    Case("quality_counts", _quality_counts, WITH_RAW + f"""SELECT count(*) AS total, count(*) FILTER ({BLANK}) AS bad,
        count(*) - count(*) FILTER ({BLANK}) AS good FROM orders_raw"""),
    Case("quality_counts_by", _quality_counts_by, WITH_RAW + f"""SELECT warehouse_id, count(*) AS total, count(*) FILTER ({BLANK}) AS bad,
        count(*) - count(*) FILTER ({BLANK}) AS good FROM orders_raw GROUP BY warehouse_id"""),
    Case("global_max", _global_max, WITH_RAW + "SELECT max(processed_dttm) AS newest FROM orders_raw"),
    Case("having_global", _freshness(STALE), WITH_STG + f"""SELECT {_BREACH} FROM stg_orders
        HAVING MAX(processed_dttm) < TIMESTAMP '{STALE}' - INTERVAL 24 HOUR"""),
    Case("assert_freshness", _freshness(AS_OF), WITH_STG + f"""SELECT {_BREACH} FROM stg_orders
        HAVING MAX(processed_dttm) < TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR"""),
    Case("completeness_ratio", _completeness_ratio, WITH_RAW + f"""SELECT count(*) AS total, count(*) FILTER (NOT ({BLANK})) AS good,
        CAST(count(*) FILTER (NOT ({BLANK})) AS DOUBLE) * 100.0::DOUBLE / count(*) AS good_percent FROM orders_raw"""),
    Case("assert_completeness", _assert_completeness, WITH_RAW + f"""SELECT
        'Completeness Breach: share of good records is below the objective' AS failure_reason, total, good, good_percent
        FROM (SELECT count(*) AS total, count(*) FILTER (NOT ({BLANK})) AS good,
          CAST(count(*) FILTER (NOT ({BLANK})) AS DOUBLE) * 100.0::DOUBLE / count(*) AS good_percent FROM orders_raw) t
        WHERE good_percent < 98.0"""),
    Case("unique_key_check", _unique_key_check, WITH_RAW + "SELECT order_id, count(*) AS row_count FROM orders_raw GROUP BY order_id HAVING count(*) > 1"),
    Case("assert_unique_key", _assert_unique_key, WITH_STG + "SELECT order_id, count(*) AS row_count FROM stg_orders GROUP BY order_id HAVING count(*) > 1"),
    Case("assert_non_null", _assert_non_null, WITH_STG + f"""SELECT {STG}, concat_ws(',', {', '.join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in NON_NULL)}) AS failed_columns
        FROM stg_orders WHERE {' OR '.join(f'{c} IS NULL' for c in NON_NULL)}"""),
    Case("assert_row_conditions", _assert_row_conditions, WITH_STG + f"""SELECT * FROM (SELECT {STG}, concat_ws('; ',
        CASE WHEN NOT (amount >= 0 AND amount <= 1000000) THEN 'amount >= 0 AND amount <= 1000000' END,
        CASE WHEN NOT (status IN {ACCEPTED}) THEN 'status IN {ACCEPTED.replace("'", "''")}' END) AS failed_rules
        FROM stg_orders) t WHERE failed_rules <> ''"""),
    Case("assert_custom_sql", _assert_custom_sql, WITH_STG + f"""SELECT {STG} FROM stg_orders
        WHERE NOT (status <> 'DELIVERED' OR processed_dttm >= TIMESTAMP '2024-01-06 00:00:00')"""),
    Case("assertion_report", _assertion_report, WITH_STG + _report_sql()),
    Case("assert_unique_each", _assert_unique_each, WITH_STG + " UNION ALL ".join(f"""SELECT 'uniqueKey' AS rule_type, '{c}' AS rule_name,
        (SELECT count(*) FROM (SELECT {c} FROM stg_orders GROUP BY {c} HAVING count(*) > 1) d) AS failing_rows""" for c in ("order_id", "customer_name"))),
    Case("assertion_report_unique_only", _report_unique_only, WITH_RAW + """SELECT 'uniqueKey' AS rule_type, 'order_id' AS rule_name,
        (SELECT count(*) FROM (SELECT order_id FROM orders_raw GROUP BY order_id HAVING count(*) > 1) d) AS failing_rows"""),
    Case("contract_to_assertions", _check_report, WITH_STG + f"""SELECT 'stg_orders' AS table_name, TIMESTAMP '{STALE}' AS checked_at, * FROM (
        {_report_sql()}
        UNION ALL SELECT 'sla', 'freshness', 1 FROM stg_orders HAVING MAX(processed_dttm) < TIMESTAMP '{STALE}' - INTERVAL 24 HOUR
        UNION ALL SELECT 'sla', 'completeness', 1 FROM stg_orders
          HAVING count(*) FILTER ({' AND '.join(f'{c} IS NOT NULL' for c in NON_NULL)}) * 100.0 / count(*) < 98.0) r"""),
    Case("pred_any_blank", _raw_where(lambda: predicates.any_blank(BUSINESS)), WITH_RAW + f"SELECT * FROM orders_raw WHERE {BLANK}"),
    Case("pred_range", _where(lambda: predicates.in_range(F.col("amount"), 0, 1000000)), WITH_STG + f"SELECT {STG} FROM stg_orders WHERE amount >= 0 AND amount <= 1000000"),
    Case("pred_accepted_values", _where(lambda: _rules().row_conditions[1].condition), WITH_STG + f"SELECT {STG} FROM stg_orders WHERE status IN {ACCEPTED}"),
    Case("pred_regex", _raw_where(lambda: predicates.matches(F.col("order_id"), "^X[0-9]{2,4}$")), WITH_RAW + "SELECT * FROM orders_raw WHERE regexp_matches(order_id, '^X[0-9]{2,4}$')"),
    Case("pred_not_null", _where(lambda: predicates.no_nulls(NON_NULL)), WITH_STG + f"SELECT {STG} FROM stg_orders WHERE {' AND '.join(f'{c} IS NOT NULL' for c in NON_NULL)}"),
    Case("semantic_status_match", lambda spark, sf_dir: inputs.orders_raw(spark, sf_dir).select(
            "order_id", "processed_dttm", "status",
            predicates.status_matches(F.col("status")).alias("by_pattern"),
            predicates.status_in_words(F.col("status")).alias("by_word"),
        ).where("by_pattern OR by_word"),
        WITH_RAW + """SELECT * FROM (SELECT order_id, processed_dttm, status,
            regexp_matches(lower(status), 'complete|done|success') AS by_pattern,
            lower(status) IN ('complete', 'completed', 'done', 'shipped') AS by_word FROM orders_raw) t WHERE by_pattern OR by_word"""),
    Case("quarantine_split", _quarantine_split, WITH_RAW + f"SELECT *, CASE WHEN {BLANK} THEN 'bad' ELSE 'good' END AS side FROM orders_raw"),
    Case("profile_columns", _column_stats, WITH_RAW + _stats_sql()),
    Case("profile_contract", _profile_contract, _PROFILE_SQL),
]
