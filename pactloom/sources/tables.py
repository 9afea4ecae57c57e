"""Warehouse tables: scans, the rule registry, the catalog, and schema files."""

from __future__ import annotations

import json
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactloom.functions.casts import spark_type
from pactloom.operators.routing import active_rules

COLUMNS_SHOWN = 20


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def declare_table(spark: SparkSession, name: str, location: str, fmt: str = "parquet") -> DataFrame:
    """Makes files that already exist known to the catalog, without copying them."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=location, source=fmt)
    return spark.table(name)


def scan_registry(spark: SparkSession, name: str) -> DataFrame:
    return active_rules(spark.table(name))


def table_columns(spark: SparkSession, names: Iterable[str]) -> DataFrame:
    """(table_ref, columns) of the tables that exist, as they are now; a missing one gives no row.

    A session remembers a table as it first saw it, and another one may have changed its columns since.
    """
    present = [n for n in sorted(set(names)) if spark.catalog.tableExists(n)]
    for name in present:
        spark.catalog.refreshTable(name)
    rows = [(n, spark.table(n).columns) for n in present]
    return spark.createDataFrame(rows, "table_ref string, columns array<string>")


def catalog_columns(spark: SparkSession, database: str, shown: int = COLUMNS_SHOWN) -> DataFrame:
    """The first columns of every table of a database, in declared order."""
    tables = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    rows = [
        (table, i, column.name)
        for table in tables
        for i, column in enumerate(spark.catalog.listColumns(f"{database}.{table}"))
    ]
    listed = spark.createDataFrame(rows, "table_name string, position int, column_name string")
    return columns_per_table(listed, shown)


def columns_per_table(columns: DataFrame, shown: int = COLUMNS_SHOWN) -> DataFrame:
    """Gathers catalog rows (table_name, position, column_name), cut to the first ``shown``."""
    kept = columns.where(F.col("position") < shown)
    ordered = F.sort_array(F.collect_list(F.struct("position", "column_name")))
    return kept.groupBy("table_name").agg(ordered.alias("c")).select(
        "table_name", F.transform("c", lambda x: x["column_name"]).alias("columns")
    )


def read_schema_file(path: str | Path) -> list[dict]:
    return json.loads(Path(path).read_text(encoding="utf-8"))


def struct_from_fields(fields: Iterable[dict]) -> T.StructType:
    return T.StructType(
        [
            T.StructField(
                f["name"],
                spark_type(f["type"]),
                f.get("mode", "NULLABLE") != "REQUIRED",
                {"comment": f["description"]} if f.get("description") else {},
            )
            for f in fields
        ]
    )


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column_ddl(field: dict) -> str:
    parts = [f"`{field['name']}` {spark_type(field['type']).simpleString()}"]
    if field.get("mode") == "REQUIRED":
        parts.append("NOT NULL")
    default = field.get("defaultValueExpression")
    if default:
        parts.append(f"DEFAULT {default}")
    if field.get("description"):
        parts.append(f"COMMENT {_literal(field['description'])}")
    return " ".join(parts)


def create_table(
    spark: SparkSession, name: str, fields: Iterable[dict], *, partition_by: str | None = None, location: str | None = None
) -> None:
    """An empty table from its JSON schema; raw and history tables share one schema."""
    clauses = [f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(column_ddl(f) for f in fields)}) USING parquet"]
    if partition_by:
        clauses.append(f"PARTITIONED BY (`{partition_by}`)")
    if location:
        clauses.append(f"LOCATION {_literal(location)}")
    spark.sql(" ".join(clauses))
