"""Quality counts, contract checks and service-level checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactloom.contract import PROCESSED, Rules
from pactloom.functions.predicates import any_blank, any_null, no_nulls

# Reasons as the check reports have them.
FRESHNESS_REASON = "Freshness Breach: Max processed_dttm is older than {hours:g} hours"
COMPLETENESS_REASON = "Completeness Breach: share of good records is below the objective"


def _now(as_of: str | None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def quality_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows in total, with a blank in any of ``columns``, and without one."""
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(any_blank(columns)).alias("bad"),
    )
    return counted.withColumn("good", F.col("total") - F.col("bad"))


def failing_non_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    names = F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in columns]))
    return df.where(any_null(columns)).withColumn("failed_columns", F.array_join(names, ","))


def failing_conditions(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows that break a row condition; a condition that is NULL counts as met."""
    broken = [F.when(~r.condition, F.lit(r.name)) for r in rules.row_conditions]
    names = F.array_compact(F.array(*broken))
    return df.withColumn("failed_rules", F.array_join(names, "; ")).where("failed_rules <> ''")


def failing_sql(df: DataFrame, condition: str) -> DataFrame:
    return df.where(~F.expr(condition))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row; all NULL keys make one group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


@dataclass(frozen=True)
class Objectives:
    """Service levels of a table; None leaves one out."""

    freshness_hours: float | None = None
    completeness_percent: float | None = None


def assertion_report(
    df: DataFrame, rules: Rules, objectives: Objectives = Objectives(), as_of: str | None = None
) -> DataFrame:
    """Failing rows per rule, and one row for every objective that is missed.

    All row rules and objectives come from one scan, uniqueness from one of
    each key's columns. A row counts as complete when it meets the not-null rules.
    """
    checks = [("nonNull", c, F.col(f"`{c}`").isNull()) for c in rules.non_null]
    checks += [("rowCondition", r.name, ~r.condition) for r in rules.row_conditions]
    facts = df.agg(
        *[F.count_if(failed).alias(f"n{i}") for i, (_, _, failed) in enumerate(checks)],
        F.max(PROCESSED).alias("newest"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(no_nulls(rules.non_null)).alias("complete"),
    )
    lines = [(kind, name, F.col(f"n{i}")) for i, (kind, name, _) in enumerate(checks)]
    if objectives.freshness_hours is not None:
        lines.append(("sla", "freshness", _missed(_is_stale(F.col("newest"), objectives.freshness_hours, as_of))))
    if objectives.completeness_percent is not None:
        short = _percent(F.col("complete"), F.col("total")) < objectives.completeness_percent
        lines.append(("sla", "completeness", _missed(short)))
    rows = [
        F.struct(F.lit(kind).alias("rule_type"), F.lit(name).alias("rule_name"), failing.alias("failing_rows"))
        for kind, name, failing in lines
    ]
    if rows:
        report = facts.select(F.inline(F.array(*rows))).where("failing_rows IS NOT NULL")
    else:
        report = df.sparkSession.createDataFrame([], "rule_type string, rule_name string, failing_rows bigint")
    for key in rules.unique_keys:
        unique = duplicate_keys(df, key).agg(F.count(F.lit(1)).alias("failing_rows"))
        name = F.lit(",".join(key)).alias("rule_name")
        report = report.unionByName(unique.select(F.lit("uniqueKey").alias("rule_type"), name, "failing_rows"))
    return report


def _missed(condition: Column) -> Column:
    return F.when(condition, F.lit(1).cast("bigint"))


def _is_stale(newest: Column, hours: float, as_of: str | None) -> Column:
    return newest < _now(as_of) - F.make_dt_interval(mins=F.lit(int(round(hours * 60))))


def _percent(part: Column, total: Column) -> Column:
    return part * 100.0 / F.nullif(total, F.lit(0))


def freshness_breach(
    df: DataFrame,
    hours: float = 24,
    as_of: str | None = None,
    column: str = PROCESSED,
    *,
    fail_on_empty: bool = False,
) -> DataFrame:
    """One row when the newest record is older than the objective, else none.

    An empty table passes, since it has no newest record, unless
    ``fail_on_empty`` is set.
    """
    stale = _is_stale(F.col("last_processed_at"), hours, as_of)
    if fail_on_empty:
        stale = stale | F.col("last_processed_at").isNull()
    reason = F.lit(FRESHNESS_REASON.format(hours=hours)).alias("failure_reason")
    return df.agg(F.max(column).alias("last_processed_at")).where(stale).select(reason, "last_processed_at")


def completeness(df: DataFrame, good: Column) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(good).alias("good"))
    return counted.withColumn("good_percent", _percent(F.col("good"), F.col("total")))


def completeness_breach(df: DataFrame, good: Column, percent: float = 98.0) -> DataFrame:
    return (
        completeness(df, good)
        .where(F.col("good_percent") < percent)
        .select(F.lit(COMPLETENESS_REASON).alias("failure_reason"), "total", "good", "good_percent")
    )


def tag_bad(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Good and bad rows told apart by ``is_bad``, ready for one partitioned write."""
    return df.withColumn("is_bad", any_blank(columns))


def quarantine_split(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    bad = any_blank(columns)
    return df.where(~bad), df.where(bad)
