"""Drafts a data contract from the data itself."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from pactloom.contract import BATCH_DATE, ColumnTest, Contract, ContractColumn, default_contract
from pactloom.functions.casts import safe_cast
from pactloom.functions.text import norm_blank

# Narrowest first: a column gets the first type all of its values fit.
CANDIDATE_TYPES = ("INT64", "NUMERIC", "FLOAT64", "BOOL", "DATE", "TIMESTAMP")
MAX_LISTED_VALUES = 20
NUMBERED = r"^([A-Za-z_#-]+)([0-9]+)$"


def _pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table as (column_name, value) rows: the work per row does not depend on how many columns there are."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), norm_blank(F.col(f"`{c}`").cast("string")).alias("value"))
        for c in columns
    ]
    return df.select(F.inline(F.array(*pairs)))


def _inferred_type() -> Column:
    fits = F.when(F.col("filled") == 0, "STRING")
    for t in CANDIDATE_TYPES:
        fits = fits.when(F.col(t.lower()) == F.col("filled"), t)
    return fits.otherwise("STRING")


def _shape(value: Column) -> list[Column]:
    prefix = F.regexp_extract(value, NUMBERED, 1)
    digits = F.length(F.regexp_extract(value, NUMBERED, 2))
    return [
        F.count_if(value.rlike(NUMBERED)).alias("numbered"),
        F.min(prefix).alias("first_prefix"),
        F.max(prefix).alias("last_prefix"),
        F.min(digits).alias("min_digits"),
        F.max(digits).alias("max_digits"),
    ]


def column_stats(df: DataFrame, columns: Sequence[str] | None = None, shapes: bool = False) -> DataFrame:
    """One row of facts per column, from a single pass over the table; ``shapes`` adds those of numbered texts."""
    value = F.col("value")
    casts = {t.lower(): safe_cast(value, t) for t in CANDIDATE_TYPES}
    cast = _pairs(df, list(columns or df.columns)).select("column_name", "value", *[c.alias(n) for n, c in casts.items()])
    facts = cast.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("value").alias("filled"),
        F.min("numeric").alias("min_number"),
        F.max("numeric").alias("max_number"),
        F.approx_count_distinct("value").alias("approx_distinct"),
        *[F.count(n).alias(n) for n in casts],
        *(_shape(value) if shapes else []),
    )
    return facts.withColumn("inferred_type", _inferred_type())


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct values and the highest repeat of each column.

    Counting by (column, value) combines before the shuffle and spreads wide columns.
    """
    counted = _pairs(df, columns).where("value IS NOT NULL")
    repeats = counted.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return repeats.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"), F.max("n").alias("max_repeat"))


def listed_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The values of ``columns``, sorted; for columns known to have few."""
    values = _pairs(df, columns).where("value IS NOT NULL").distinct()
    return values.groupBy("column_name").agg(F.sort_array(F.collect_list("value")).alias("listed_values"))


def _tests(stats: Row, listed: Sequence[str]) -> tuple[ColumnTest, ...]:
    if stats["inferred_type"] in ("INT64", "NUMERIC") and stats["filled"]:
        return (ColumnTest("range", low=stats["min_number"].normalize(), high=stats["max_number"].normalize()),)
    if stats["inferred_type"] != "STRING" or not stats["filled"]:
        return ()
    if listed:
        return (ColumnTest("accepted_values", values=tuple(listed)),)
    if stats["numbered"] == stats["filled"] and stats["first_prefix"] == stats["last_prefix"]:
        low, high = stats["min_digits"], stats["max_digits"]
        return (ColumnTest("regex", pattern=f"^{stats['first_prefix']}[0-9]{{{low},{high}}}$"),)
    return ()


def profile_contract(
    df: DataFrame, name: str, columns: Sequence[str] | None = None, max_listed: int = MAX_LISTED_VALUES
) -> Contract:
    """A contract that the data meets: types, constraints, tests, key and partition column.

    The first pass reads every column once. Values of texts, and of columns that may be a key, are then counted
    exactly, however many there are; a text's values are listed where it has at most ``max_listed``.
    """
    names = list(columns or df.columns)
    stats = {r["column_name"]: r for r in column_stats(df, names, shapes=True).collect()}
    if not stats:
        return default_contract(name, names)
    full = [c for c in names if stats[c]["filled"] == stats[c]["row_count"] > 0]
    texts = [c for c in names if stats[c]["inferred_type"] == "STRING" and stats[c]["filled"]]
    candidates = [c for c in full if stats[c]["inferred_type"] in ("INT64", "STRING")]
    exact = list(dict.fromkeys([*candidates, *texts]))
    counts = {r["column_name"]: r for r in value_counts(df, exact).collect()} if exact else {}
    few = [c for c in texts if counts[c]["distinct_values"] <= max_listed]
    listed = {r["column_name"]: r["listed_values"] for r in listed_values(df, few).collect()} if few else {}
    unique = [c for c in candidates if counts[c]["max_repeat"] == 1]
    key = next(iter(unique), None)
    drafted = tuple(
        ContractColumn(
            name=c,
            type=stats[c]["inferred_type"],
            primary_key=c == key,
            not_null=c in full,
            unique=c in unique,
            tests=_tests(stats[c], listed.get(c, ())),
        )
        for c in names
    )
    dates = [c.name for c in drafted if c.type == "DATE"]
    partition = BATCH_DATE if BATCH_DATE in names or not dates else dates[0]
    return Contract(
        name=name,
        columns=drafted,
        partition_by=partition,
        cluster_by=(key,) if key else (),
        freshness_hours=24.0,
        completeness_percent=98.0,
    )


def relax(contract: Contract) -> Contract:
    """The same contract without value tests, for data that is still growing its domain."""
    return replace(contract, columns=tuple(replace(c, tests=()) for c in contract.columns))


def contract_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """A contract as a table: one row per column."""
    rows = [
        (c.name, c.type, c.primary_key, c.not_null, c.unique, _tests_text(c), c.name == contract.partition_by)
        for c in contract.columns
    ]
    schema = (
        "column_name string, type string, primary_key boolean, not_null boolean, "
        "is_unique boolean, tests string, is_partition boolean"
    )
    return df.sparkSession.createDataFrame(rows, schema)


def _tests_text(column: ContractColumn) -> str:
    texts = []
    for t in column.tests:
        if t.kind == "range":
            texts.append(f"range {t.low:f}..{t.high:f}")
        elif t.kind == "accepted_values":
            texts.append("values " + "|".join(t.values))
        else:
            texts.append(f"regex {t.pattern}")
    return "; ".join(texts)
