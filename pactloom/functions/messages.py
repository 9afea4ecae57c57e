"""Decoding of drift messages and audit payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactloom.functions.text import norm_blank

EVENT_SCHEMA = """
  event_type string, trace_id string, bucket string, file_name string, table_ref string,
  domain string, data_contracts string,
  new_column_headers array<string>, deleted_column_headers array<string>,
  added_columns array<string>, removed_columns array<string>,
  sample_data_rows array<map<string,string>>, timestamp string,
  error_message string, is_deletion boolean,
  protoPayload struct<status:struct<message:string>>
"""

# Texts used where a message leaves a field out.
DEFAULT_PLATFORM_ERROR = "BigQuery/Dataform Error Intercepted"
DEFAULT_ERROR = "Schema drift or general anomaly detected"
UNKNOWN_TABLE = "unknown_table"
UNKNOWN_DOMAIN = "unknown_domain"
PLATFORM_WORD = "dataform"


def decode_base64(col: Column) -> Column:
    return F.decode(F.unbase64(col), "UTF-8")


def encode_base64(col: Column) -> Column:
    return F.base64(F.encode(col, "UTF-8"))


def has_key(message: Column, key: str) -> Column:
    return F.coalesce(F.array_contains(F.json_object_keys(message), key), F.lit(False))


def _either_key(event: Column, keys: Column, first: str, second: str) -> Column:
    chosen = F.when(F.array_contains(keys, first), event[first]).otherwise(event[second])
    return F.coalesce(chosen, F.array().cast("array<string>"))


def read_messages(messages: DataFrame, value: str) -> DataFrame:
    """Named columns of JSON drift messages, defaults filled in; other columns stay.

    The generator makes each message parse once: as a plain expression it would
    be parsed again for every field and every later filter. A message without
    a trace id gets one made from its text.
    """
    kept = [c for c in messages.columns if c != value]
    parsed = F.struct(
        F.json_object_keys(value).alias("_keys"),
        F.from_json(value, EVENT_SCHEMA).alias("_event"),
        F.concat(F.lit("unknown-"), F.md5(value)).alias("_stand_in"),
    )
    event, keys = F.col("_event"), F.col("_keys")
    platform_error = F.coalesce(event["protoPayload"]["status"]["message"], F.lit(DEFAULT_PLATFORM_ERROR))
    plain_error = F.coalesce(event["error_message"], F.lit(DEFAULT_ERROR))
    named = {
        "trace_id": F.coalesce(event["trace_id"], F.col("_stand_in")),
        "table_ref": F.coalesce(event["table_ref"], F.lit(UNKNOWN_TABLE)),
        "domain": F.coalesce(event["domain"], F.lit(UNKNOWN_DOMAIN)),
        "data_contracts": norm_blank(event["data_contracts"]),
        "error_context": F.when(F.array_contains(keys, "protoPayload"), platform_error).otherwise(plain_error),
        "added": _either_key(event, keys, "added_columns", "new_column_headers"),
        "removed": _either_key(event, keys, "removed_columns", "deleted_column_headers"),
        "sample_rows": event["sample_data_rows"],
        "deletion_flag": F.coalesce(event["is_deletion"], F.lit(False)),
    }
    rows = messages.select(*kept, F.inline(F.array(parsed)))
    return rows.where(keys.isNotNull()).select(*kept, *[c.alias(n) for n, c in named.items()])


def first_sample_keys(rows: Column) -> Column:
    return F.coalesce(F.map_keys(F.try_element_at(rows, F.lit(1))), F.array().cast("array<string>"))
