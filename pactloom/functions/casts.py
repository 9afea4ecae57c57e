"""Casts that turn a bad value into NULL, never into an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Warehouse type names and the Spark types that carry them.
TYPES: dict[str, T.DataType] = {
    "STRING": T.StringType(),
    "INT64": T.LongType(),
    "INTEGER": T.LongType(),
    "NUMERIC": T.DecimalType(38, 9),
    "FLOAT64": T.DoubleType(),
    "FLOAT": T.DoubleType(),
    "BOOL": T.BooleanType(),
    "BOOLEAN": T.BooleanType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "JSON": T.StringType(),
}


def spark_type(name: str) -> T.DataType:
    try:
        return TYPES[name.strip().upper()]
    except KeyError:
        raise ValueError(f"unknown column type {name!r}; expected one of {sorted(TYPES)}") from None


# A failed number parse raises an error inside Spark and costs some fifty times
# what these looks at the text do, so only texts that will parse are cast.
_INTEGER = r"^[+-]?[0-9]{1,19}$"
_LONG_INTEGER = r"^[+-]?0*[0-9]{1,19}$"
_HEXADECIMAL = r"^[+-]?0[xX][0-9a-fA-F]{1,16}$"
_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_SPECIAL = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity", "nan")


def _has_full_date(text: Column) -> Column:
    # Spark alone would also read 'now', '2024', '2024-01' and '12:30'.
    return (F.substring(text, 5, 1) == "-") & (F.locate("-", text, 6) > 0)


def _to_int64(text: Column) -> Column:
    magnitude = F.conv(F.substring_index(F.lower(text), "x", -1), 16, 10)
    signed = F.when(text.startswith("-"), F.concat(F.lit("-"), magnitude)).otherwise(magnitude)
    return (
        F.when(text.rlike(_INTEGER), text.try_cast("bigint"))
        .when(text.rlike(_HEXADECIMAL), signed.try_cast("bigint"))
        .when(text.rlike(_LONG_INTEGER), text.try_cast("bigint"))
    )


def _to_numeric(text: Column, target: T.DataType) -> Column:
    return F.when(text.rlike(_NUMBER), text.try_cast(target))


def _to_float64(text: Column) -> Column:
    special = F.lower(text).isin(*_SPECIAL)
    return F.when(text.rlike(_NUMBER) | special, text.try_cast("double"))


def _to_date(text: Column) -> Column:
    # Past ten characters Spark ignores whatever follows the day.
    long_form = text.try_cast("timestamp").cast("date")
    short_form = text.try_cast("date")
    return F.when(_has_full_date(text), F.when(F.length(text) <= 10, short_form).otherwise(long_form))


def safe_cast(col: Column, type_name: str, *, from_text: bool = True) -> Column:
    """``SAFE_CAST``: ``col`` as ``type_name``, NULL where the value does not fit.

    ``from_text`` adds the guards a text value needs; pass False for a column
    that already has a type.
    """
    target = spark_type(type_name)
    name = type_name.strip().upper()
    if not from_text or name == "STRING":
        return col.try_cast(target)
    text = F.trim(col.cast("string"))
    if name in ("INT64", "INTEGER"):
        return _to_int64(text)
    if name in ("FLOAT64", "FLOAT"):
        return _to_float64(text)
    if name in ("BOOL", "BOOLEAN"):
        low = F.lower(text)
        return F.when(low.isin("true", "false"), low == "true")
    if name == "DATE":
        return _to_date(text)
    if name == "TIMESTAMP":
        return F.when(_has_full_date(text), text.try_cast("timestamp"))
    if name == "JSON":
        return F.when(F.try_parse_json(col.cast("string")).isNotNull(), col.cast("string"))
    return _to_numeric(text, target)


def safe_parse_date(col: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.try_to_date(col, pattern)


def safe_parse_timestamp(col: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.try_to_timestamp(col, F.lit(pattern))
