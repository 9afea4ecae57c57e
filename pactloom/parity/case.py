from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    """``sql`` is None where no SQL can say the same."""

    name: str
    build: Build
    sql: str | None = None
