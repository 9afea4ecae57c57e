"""JSON texts as VARIANT: parsed once, read by path, with bad texts told apart."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_variant(text: Column | str) -> Column:
    """The JSON of a text; NULL where it is NULL or no JSON."""
    return F.try_parse_json(text)


def is_bad_json(text: Column | str) -> Column:
    """A text that is there and no JSON."""
    text = F.col(text) if isinstance(text, str) else text
    return text.isNotNull() & as_variant(text).isNull()


def variant_fields(df: DataFrame, column: str, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``df`` with a column for each of ``fields`` (name: path and type) of a VARIANT; NULL where it is absent or doesn't fit."""
    return df.withColumns({name: F.try_variant_get(column, path, kind) for name, (path, kind) in fields.items()})


def variant_schema(df: DataFrame, column: str) -> DataFrame:
    """One row with the schema that all values of a VARIANT column have together."""
    return df.agg(F.schema_of_variant_agg(column).alias("schema"))
