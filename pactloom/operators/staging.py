"""Raw text rows to typed rows, newest version of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactloom.contract import BATCH_DATE, PROCESSED, UPDATED, Contract, contract_select
from pactloom.functions.casts import safe_cast


def _as_column(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    order_by: Sequence[str | Column] = (PROCESSED,),
    tie_break: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per key: the one with the greatest ``order_by``, NULLs last. Without keys every row stays.

    The rank filter becomes a group limit on both sides of the shuffle, so each
    task sends at most one row per key however many versions a key has.
    """
    if not keys:
        return df
    ordering = [_as_column(c).desc_nulls_last() for c in (*order_by, *tie_break)]
    window = Window.partitionBy(*[_as_column(k) for k in keys]).orderBy(*ordering)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def explicit_projection(df: DataFrame, contract: Contract, extra: Sequence[str] = ()) -> DataFrame:
    return df.select(*[c.name for c in contract.business_columns], *extra)


def cast_project(df: DataFrame, contract: Contract, as_of: str | None = None) -> DataFrame:
    return df.select(*contract_select(contract, as_of))


def with_audit_columns(df: DataFrame, as_of: str | None = None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.withColumns({BATCH_DATE: now.cast("date"), UPDATED: now})


def stage(
    raw: DataFrame,
    contract: Contract,
    as_of: str | None = None,
    *,
    typed_key: bool = False,
    tie_break: Sequence[str | Column] = (),
) -> DataFrame:
    """The staging table of an entity.

    Versions are compared on the raw key text, so ``7`` and ``007`` are two
    keys; ``typed_key`` compares the cast values instead. Casts run after the
    versions are settled and so only on rows that stay. A contract without a key has no versions: all rows stay.
    """
    types = {c.name: c.type for c in contract.columns}
    keys = [safe_cast(F.col(f"`{k}`"), types[k]) if typed_key else F.col(f"`{k}`") for k in contract.key]
    newest = latest_per_key(raw, keys, [F.col(PROCESSED).try_cast("timestamp")], tie_break)
    return cast_project(newest, contract, as_of)
