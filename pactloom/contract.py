"""Data contracts: a YAML document turned into Spark columns and rules."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactloom.functions import predicates
from pactloom.functions.casts import safe_cast, spark_type

# Columns every layer carries besides the entity's own.
BATCH_DATE = "batch_date"
PROCESSED = "processed_dttm"
UPDATED = "updated_dttm"
AUDIT_COLUMNS = (BATCH_DATE, PROCESSED)

_PERIOD_HOURS = {"m": 1 / 60, "h": 1, "d": 24, "w": 168}


@dataclass(frozen=True)
class ColumnTest:
    kind: str
    low: object = None
    high: object = None
    values: tuple = ()
    pattern: str | None = None
    sql: str | None = None


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str = "STRING"
    description: str = ""
    primary_key: bool = False
    not_null: bool = False
    unique: bool = False
    default: str | None = None
    classification: str | None = None
    tests: tuple[ColumnTest, ...] = ()


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[ContractColumn, ...]
    version: str = "1.0.0"
    partition_by: str | None = BATCH_DATE
    cluster_by: tuple[str, ...] = ()
    freshness_hours: float | None = None
    completeness_percent: float | None = None
    properties: dict = field(default_factory=dict)

    @property
    def business_columns(self) -> list[ContractColumn]:
        return [c for c in self.columns if c.name not in (*AUDIT_COLUMNS, UPDATED)]

    @property
    def key(self) -> list[str]:
        keys = [c.name for c in self.columns if c.primary_key]
        return keys or [c.name for c in self.columns if c.unique]


@dataclass(frozen=True)
class RowRule:
    """A condition every row must meet, with the text it was declared as."""

    name: str
    condition: Column


@dataclass(frozen=True)
class Rules:
    non_null: tuple[str, ...]
    unique_keys: tuple[tuple[str, ...], ...]
    row_conditions: tuple[RowRule, ...]


def _period_hours(text) -> float:
    found = re.fullmatch(r"\s*(\d+(?:\.\d+)?)\s*([mhdw])\s*", str(text))
    if not found:
        raise ValueError(f"cannot read period {text!r}; expected for example 24h")
    return float(found[1]) * _PERIOD_HOURS[found[2]]


def _test(raw) -> ColumnTest:
    kind = raw["type"]
    if kind == "range":
        return ColumnTest(kind, low=raw.get("min"), high=raw.get("max"))
    if kind == "accepted_values":
        return ColumnTest(kind, values=tuple(raw["values"]))
    if kind == "regex":
        return ColumnTest(kind, pattern=raw["pattern"])
    if kind in ("custom_sql", "sql"):
        return ColumnTest("custom_sql", sql=raw.get("sql") or raw.get("expression"))
    raise ValueError(f"unknown contract test {kind!r}")


def _column(raw: dict) -> ContractColumn:
    constraints = raw.get("constraints") or {}
    return ContractColumn(
        name=raw["column"],
        type=raw.get("type", "STRING"),
        description=raw.get("description", ""),
        primary_key=bool(raw.get("primary_key")),
        not_null=bool(constraints.get("not_null")),
        unique=bool(constraints.get("unique")),
        default=raw.get("default"),
        classification=raw.get("classification"),
        tests=tuple(_test(t) for t in raw.get("tests") or ()),
    )


def _short_column(raw: dict) -> ContractColumn:
    """Column of the compact layout: ``assertions`` is a list of words and SQL texts."""
    words = list(raw.get("assertions") or ())
    custom = [w for w in words if w not in ("not_null", "unique")]
    return ContractColumn(
        name=raw["name"],
        type=raw.get("bq_type") or raw.get("type") or "STRING",
        description=raw.get("description", ""),
        not_null="not_null" in words or raw.get("nullable") is False,
        unique="unique" in words,
        tests=tuple(ColumnTest("custom_sql", sql=w) for w in custom),
    )


def parse_contract(text: str) -> Contract:
    doc = yaml.safe_load(text)
    if "columns" in doc:
        threshold = doc.get("completeness_threshold")
        return Contract(
            name=doc.get("table") or doc.get("name"),
            columns=tuple(_short_column(c) for c in doc["columns"]),
            version=str(doc.get("version", "1.0")),
            partition_by=doc.get("partition_by", BATCH_DATE),
            cluster_by=tuple(doc.get("cluster_by") or ()),
            freshness_hours=doc.get("freshness_slo_hours"),
            completeness_percent=None if threshold is None else float(threshold) * 100.0,
            properties={k: doc[k] for k in ("domain", "owner") if k in doc},
        )
    sla = doc.get("service_level_agreement") or {}
    freshness = (sla.get("freshness") or {}).get("period")
    return Contract(
        name=doc["name"],
        columns=tuple(_column(c) for c in doc.get("schema") or ()),
        version=str(doc.get("version", "1.0.0")),
        partition_by=doc.get("partition_by"),
        cluster_by=tuple(doc.get("cluster_by") or ()),
        freshness_hours=None if freshness is None else _period_hours(freshness),
        completeness_percent=(sla.get("completeness") or {}).get("percentage"),
        properties={k: doc[k] for k in ("id", "owner", "status", "description", "dataset") if k in doc},
    )


def load_contract(path: str | Path) -> Contract:
    return parse_contract(Path(path).read_text(encoding="utf-8"))


def orders_contract() -> Contract:
    return load_contract(Path(__file__).parent / "contracts" / "orders.yaml")


def default_contract(name: str, columns: list[str]) -> Contract:
    """The contract of a table nothing is known about: all text, partitioned by batch."""
    names = columns or ["id"]
    return Contract(name=name, columns=tuple(ContractColumn(c) for c in names))


def contract_select(contract: Contract, as_of: str | None = None) -> list[Column]:
    """Typed columns of a staging table, in contract order, plus the audit columns.

    ``as_of`` is the load time; the clock of the query is used when it is None.
    """
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    typed = [
        safe_cast(F.col(f"`{c.name}`"), c.type).alias(c.name, metadata=column_metadata(c))
        for c in contract.business_columns
    ]
    return [
        *typed,
        now.cast("date").alias(BATCH_DATE),
        F.col(PROCESSED).try_cast("timestamp").alias(PROCESSED),
        now.alias(UPDATED),
    ]


def column_metadata(column: ContractColumn) -> dict:
    given = {"comment": column.description, "classification": column.classification}
    return {k: v for k, v in given.items() if v}


def contract_schema(contract: Contract) -> T.StructType:
    return T.StructType(
        [T.StructField(c.name, spark_type(c.type), not c.not_null, column_metadata(c)) for c in contract.columns]
    )


def _row_rule(column: ContractColumn, test: ColumnTest) -> RowRule:
    col = F.col(f"`{column.name}`")
    if test.kind == "range":
        parts = []
        if test.low is not None:
            parts.append(f"{column.name} >= {test.low}")
        if test.high is not None:
            parts.append(f"{column.name} <= {test.high}")
        return RowRule(" AND ".join(parts), predicates.in_range(col, test.low, test.high))
    if test.kind == "accepted_values":
        listed = ", ".join(f"'{v}'" for v in test.values)
        return RowRule(f"{column.name} IN ({listed})", predicates.accepted_values(col, test.values))
    if test.kind == "regex":
        return RowRule(f"REGEXP_CONTAINS({column.name}, r'{test.pattern}')", predicates.matches(col, test.pattern))
    return RowRule(test.sql, F.expr(test.sql))


def contract_rules(contract: Contract) -> Rules:
    """The same checks serve the staging and the mart table of an entity.

    Each unique column is a key of its own, and the primary key is one, be it of one column or of several.
    """
    primary = tuple(c.name for c in contract.columns if c.primary_key)
    return Rules(
        non_null=tuple(c.name for c in contract.columns if c.not_null),
        unique_keys=tuple(dict.fromkeys([*[(c.name,) for c in contract.columns if c.unique], *filter(None, [primary])])),
        row_conditions=tuple(_row_rule(c, t) for c in contract.columns for t in c.tests),
    )
