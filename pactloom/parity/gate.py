from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.operators import gate
from pactloom.parity import inputs
from pactloom.parity.case import Case

QUESTIONS = {
    "all_lines": "SELECT * FROM pactloom_lineitem",
    "dear_orders": "SELECT o_orderkey FROM pactloom_orders WHERE o_totalprice > 400000",
    "by_priority": "SELECT o_orderpriority, sum(o_totalprice) AS total FROM pactloom_orders GROUP BY o_orderpriority",
}


def _views(spark: SparkSession, sf_dir: str) -> None:
    for name in ("orders", "lineitem", "customer"):
        inputs.table(spark, sf_dir, name).createOrReplaceTempView(f"pactloom_{name}")


def _count_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir)
    return gate.count_rows(spark, QUESTIONS["dear_orders"])


def _size_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's verdict on three questions."""
    _views(spark, sf_dir)
    verdicts = [(name, gate.size_gate(spark, sql)) for name, sql in QUESTIONS.items()]
    rows = [(name, g.row_count, g.needs_confirmation) for name, g in verdicts]
    return spark.createDataFrame(rows, "question string, row_count bigint, needs_confirmation boolean")


def _group_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per ship mode of a table of results: how many rows, and whether that needs a confirmation."""
    counted = inputs.table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return counted.withColumn("needs_confirmation", gate.too_large(F.col("row_count"), F.lit(0.0)))


def _preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    _views(spark, sf_dir)
    return gate.preview(spark, "SELECT c_mktsegment, c_nationkey, count(*) AS buyers FROM pactloom_customer GROUP BY 1, 2")


def _category_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = inputs.table(spark, sf_dir, "orders").withColumn("amount", F.col("o_totalprice").cast("decimal(18,2)"))
    return gate.category_metric(orders, "o_orderpriority", "amount", ("priority", "total_sales"))


def _last_n_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate.last_turns(inputs.table(spark, sf_dir, "conversations"))


CASES = [
    Case("count_subquery", _count_subquery, "SELECT count(*) AS cnt FROM (SELECT o_orderkey FROM orders WHERE o_totalprice > 400000) q"),
    Case("size_gate", _size_gate, """SELECT question, row_count, row_count > 2000 AS needs_confirmation FROM (
        SELECT 'all_lines' AS question, count(*) AS row_count FROM lineitem
        UNION ALL SELECT 'dear_orders', count(*) FROM orders WHERE o_totalprice > 400000
        UNION ALL SELECT 'by_priority', count(DISTINCT o_orderpriority) FROM orders) q"""),
    Case("size_gate_by_group", _group_gate, """SELECT l_returnflag, l_linestatus, count(*) AS row_count, count(*) > 2000 AS needs_confirmation
        FROM lineitem GROUP BY ALL"""),
    Case("preview_limit", _preview_limit, "SELECT c_mktsegment, c_nationkey, count(*) AS buyers FROM customer GROUP BY 1, 2"),
    Case("category_metric", _category_metric, """SELECT CAST(o_orderpriority AS VARCHAR) AS priority,
        CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales FROM orders GROUP BY o_orderpriority"""),
    Case("last_n_turns", _last_n_turns, """SELECT conv_id, string_agg(line, chr(10) ORDER BY turn) AS context FROM (
        SELECT conv_id, turn, concat(upper(role), ': ', text) AS line,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn FROM conversations) t WHERE rn <= 5 GROUP BY conv_id"""),
]
