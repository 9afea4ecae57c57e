"""Row predicates used by quality counts, contract tests and filters."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words a free-text status search treats as "finished".
STATUS_PATTERN = "complete|done|success"
STATUS_WORDS = ("complete", "completed", "done", "shipped")


def _any(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def any_blank(columns: Iterable[str]) -> Column:
    """True when a listed column is NULL or ``''``; white space is a value."""
    return _any(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) == "" for c in columns)


def any_null(columns: Iterable[str]) -> Column:
    return _any(F.col(f"`{c}`").isNull() for c in columns)


def no_nulls(columns: Iterable[str]) -> Column:
    return _all(F.col(f"`{c}`").isNotNull() for c in columns)


def in_range(col: Column, low=None, high=None) -> Column:
    bounds = []
    if low is not None:
        bounds.append(col >= F.lit(low))
    if high is not None:
        bounds.append(col <= F.lit(high))
    return _all(bounds) if bounds else F.lit(True)


def accepted_values(col: Column, values: Iterable) -> Column:
    return col.isin(list(values))


def matches(col: Column, pattern: str) -> Column:
    return col.rlike(pattern)


def status_matches(col: Column) -> Column:
    return F.lower(col).rlike(STATUS_PATTERN)


def status_in_words(col: Column) -> Column:
    return F.lower(col).isin(*STATUS_WORDS)
