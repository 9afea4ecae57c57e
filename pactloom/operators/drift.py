"""Schema drift: differences between files and tables, and what follows from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactloom.contract import AUDIT_COLUMNS, BATCH_DATE, PROCESSED
from pactloom.functions.messages import PLATFORM_WORD, first_sample_keys, read_messages
from pactloom.operators import routing

# The event type here, and the message texts in ``drift_outcome``, which readers of the messages know.
EVENT_TYPE = "SCHEMA_DRIFT_AI"


def _without_audit(columns: Column) -> Column:
    return F.array_except(columns, F.array(*[F.lit(c) for c in AUDIT_COLUMNS]))


def unknown_columns(headers: Column, table_columns: Column) -> Column:
    return F.sort_array(F.array_except(headers, _without_audit(table_columns)))


def missing_columns(headers: Column, table_columns: Column) -> Column:
    return F.sort_array(F.array_except(_without_audit(table_columns), headers))


def type_changes(file_types: Column, table_types: Column) -> Column:
    """Columns both sides have under different types, as a map from name to the file's type.

    Drift itself looks at names only, since raw tables hold text; this is for
    callers that want to know more.
    """
    return F.map_filter(
        file_types, lambda name, kind: F.coalesce(F.try_element_at(table_types, name) != kind, F.lit(False))
    )


def schema_diff(files: DataFrame, tables: DataFrame, on: Sequence[str] = ("table_ref",)) -> DataFrame:
    """Per file, the names only the file has and those only its table has.

    ``files`` holds ``headers`` and ``tables`` holds ``columns``, both arrays of
    names, so the comparison itself needs no shuffle. Names are compared as
    they are written, in any order, without types.
    """
    joined = files.join(tables, list(on), "left")
    return joined.withColumns(
        {
            "new_columns": unknown_columns(F.col("headers"), F.col("columns")),
            "deleted_columns": missing_columns(F.col("headers"), F.col("columns")),
        }
    )


def schema_diff_rows(file_columns: DataFrame, table_columns: DataFrame, file_keys: Sequence[str]) -> DataFrame:
    """The same comparison where names come as rows, for sources too wide to gather.

    ``file_columns`` is (file_keys..., table_ref, column_name) and
    ``table_columns`` (table_ref, column_name). One count per (file, column)
    decides, and that pair spreads evenly however many columns a file has.
    """
    keys = list(file_keys)
    business = table_columns.where(~F.col("column_name").isin(*AUDIT_COLUMNS))
    seen = file_columns.select(*keys, "table_ref", "column_name", F.lit(1).alias("side"))
    files = file_columns.select(*keys, "table_ref").distinct()
    expected = files.join(business, "table_ref").select(*keys, "table_ref", "column_name", F.lit(2).alias("side"))
    sides = seen.unionByName(expected).groupBy(*keys, "table_ref", "column_name").agg(F.bit_or("side").alias("sides"))
    change = F.when(F.col("sides") == 1, "unknown").when(F.col("sides") == 2, "missing")
    return sides.withColumn("change", change).where("change IS NOT NULL").drop("sides")


def _quoted_list(names: Column) -> Column:
    quoted = F.transform(names, lambda n: F.concat(F.lit("'"), n, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def drift_outcome(diffed: DataFrame, error: str | None = None) -> DataFrame:
    """Status, message and archive folder of each routed and compared file.

    ``error`` names a column with the text of a failure met before the
    comparison, if there is one.
    """
    failure = F.col(error) if error else F.lit(None).cast("string")
    drifted = (F.size("new_columns") > 0) | (F.size("deleted_columns") > 0)
    status = (
        F.when(F.col("target_table").isNull(), routing.SKIPPED)
        .when(failure.isNotNull(), routing.FAILED)
        .when(F.col("columns").isNull(), routing.TABLE_MISSING)
        .when(drifted, routing.DRIFT_DETECTED)
        .otherwise(routing.SUCCESS)
    )
    message = (
        F.when(F.col("status") == routing.SKIPPED, F.lit("No matching routing rule"))
        .when(F.col("status") == routing.FAILED, failure)
        .when(
            F.col("status") == routing.TABLE_MISSING,
            F.concat(F.lit("Table Missing: Target table '"), F.col("table_ref"), F.lit("' does not exist.")),
        )
        .when(
            F.col("status") == routing.DRIFT_DETECTED,
            F.concat(
                F.lit("Drift Detected: Added="),
                _quoted_list(F.col("new_columns")),
                F.lit(", Deleted="),
                _quoted_list(F.col("deleted_columns")),
            ),
        )
    )
    with_status = diffed.withColumn("status", status)
    return with_status.withColumns(
        {"error_message": message, "archive_folder": routing.archive_folder(F.col("status"))}
    )


def drift_samples(rows: Column, new_columns: Column) -> Column:
    """Sample rows (an array of maps) cut down to the new columns."""
    return F.transform(rows, lambda r: F.map_filter(r, lambda k, _: F.array_contains(new_columns, k)))


def drift_events(outcomes: DataFrame, at: Column) -> DataFrame:
    """One JSON message for every file that drifted or has no table.

    For a missing table every column counts as new and every sample value is kept.
    """
    table_missing = F.col("status") == routing.TABLE_MISSING
    no_names = F.array().cast("array<string>")
    columns = set(outcomes.columns)
    samples = F.col("samples") if "samples" in columns else F.array().cast("array<map<string,string>>")
    contracts = F.col("data_contracts") if "data_contracts" in columns else F.lit(None).cast("string")
    event = F.struct(
        F.lit(EVENT_TYPE).alias("event_type"),
        F.col("trace_id"),
        F.col("bucket"),
        F.col("file_name"),
        F.col("table_ref"),
        F.col("domain"),
        contracts.alias("data_contracts"),
        F.when(table_missing, F.col("headers")).otherwise(F.col("new_columns")).alias("new_column_headers"),
        F.when(table_missing, no_names).otherwise(F.col("deleted_columns")).alias("deleted_column_headers"),
        F.when(table_missing, samples)
        .otherwise(drift_samples(samples, F.col("new_columns")))
        .alias("sample_data_rows"),
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("timestamp"),
    )
    wanted = outcomes.where(F.col("status").isin(routing.DRIFT_DETECTED, routing.TABLE_MISSING))
    return wanted.select(F.to_json(event, {"ignoreNullFields": "false"}).alias("value"))


def classify_drift_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Reads drift messages and keeps those that call for an action.

    A message counts when it adds or removes columns, names a contract, comes
    from the transformation layer, or asks for a deletion.
    """
    parsed = read_messages(messages, value)
    inferred = (F.size("added") == 0) & (F.size("removed") == 0) & (F.size("sample_rows") > 0)
    context = F.lower("error_context")
    judged = parsed.withColumns(
        {
            "added": F.when(inferred, first_sample_keys(F.col("sample_rows"))).otherwise(F.col("added")),
            "is_deletion": F.col("deletion_flag") | context.rlike("delete|drop"),
        }
    )
    relevant = (
        (F.size("added") > 0)
        | (F.size("removed") > 0)
        | F.col("data_contracts").isNotNull()
        | context.contains(PLATFORM_WORD)
        | F.col("is_deletion")
    )
    return judged.where(relevant).drop("deletion_flag", "sample_rows")


def evolved_columns(columns: Sequence[str], added: Sequence[str], removed: Sequence[str]) -> list[str]:
    """Names after a change: dropped ones out, new ones last, audit columns behind them."""
    kept = [c for c in columns if c not in removed and c not in AUDIT_COLUMNS]
    new = [c for c in dict.fromkeys(added) if c not in kept and c not in AUDIT_COLUMNS]
    return [*kept, *new, *AUDIT_COLUMNS]


def evolve_schema(raw: DataFrame, added: Sequence[str], removed: Sequence[str]) -> DataFrame:
    """Raw rows under the changed schema; an added column is text and NULL."""
    present = set(raw.columns)
    types = {BATCH_DATE: "date", PROCESSED: "timestamp"}
    return raw.select(
        *[
            F.col(f"`{c}`") if c in present and c not in set(removed) else F.lit(None).cast(types.get(c, "string")).alias(c)
            for c in evolved_columns(raw.columns, added, removed)
        ]
    )


def evolve_schema_fields(fields: Sequence[dict], added: Sequence[str], removed: Sequence[str]) -> list[dict]:
    """The same change on a JSON table schema; kept fields keep their attributes."""
    by_name = {f["name"]: f for f in fields}
    names = evolved_columns(list(by_name), added, removed)
    new = {"type": "STRING", "mode": "NULLABLE", "defaultValueExpression": "NULL"}
    kept = [{"defaultValueExpression": "NULL", **by_name[n]} if n in by_name else {"name": n, **new} for n in names[:-2]]
    return [*kept, *AUDIT_FIELDS]


# The two audit columns as table schemas declare them.
AUDIT_FIELDS = (
    {
        "name": BATCH_DATE,
        "type": "DATE",
        "mode": "NULLABLE",
        "description": "Day of the load; far future until the row is archived.",
        "defaultValueExpression": "DATE '9999-12-31'",
    },
    {
        "name": PROCESSED,
        "type": "TIMESTAMP",
        "mode": "NULLABLE",
        "description": "Time the row was loaded.",
        "defaultValueExpression": "CURRENT_TIMESTAMP()",
    },
)
