"""Text, name and number formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits and prices of the contracts this library serves.
ERROR_TEXT_LIMIT = 2000
PRICE_PER_TIB = 6.25
DEFAULT_DATASET = "raw"
FENCE = "```"

# Every character that counts as white space in Unicode text. The ones past
# Latin-1 sit behind a range test of their own, which spares letters their list.
_RARE_SPACE = r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
WHITESPACE = rf"[ \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0{_RARE_SPACE}]+"


def norm_blank(col: Column) -> Column:
    """Text without white space at either end; NULL for blank text and for the word ``nan``."""
    trimmed = F.regexp_replace(col, f"^{WHITESPACE}|{WHITESPACE}$", "")
    return F.when(~F.lower(trimmed).isin("", "nan"), trimmed)


def truncate_error(col: Column, limit: int = ERROR_TEXT_LIMIT) -> Column:
    return F.when(col != "", F.substring(col, 1, limit))


def collapse_whitespace(col: Column) -> Column:
    return F.coalesce(F.trim(F.regexp_replace(col, WHITESPACE, " ")), F.lit(""))


def strip_code_fence(col: Column, lang: str = "sql") -> Column:
    """Text inside a fenced block: the first and the last line go."""
    newline = F.lit("\n")
    body = F.substr(col, F.locate("\n", col) + 1)
    tail = F.length(F.substring_index(body, "\n", -1)) + 1
    inner = F.when(F.contains(body, newline), F.left(body, F.length(body) - tail)).otherwise(body)
    single_line = F.replace(F.replace(col, F.lit(FENCE + lang), F.lit("")), F.lit(FENCE), F.lit(""))
    unfenced = F.when(F.contains(col, newline), inner).otherwise(single_line)
    return F.when(col.startswith(FENCE), unfenced).otherwise(col)


def display_name(email: Column, fallback: str = "User") -> Column:
    """``org:jane_van.doe@x.com`` becomes ``Jane Van Doe``."""
    local_part = F.substring_index(F.substring_index(email, ":", -1), "@", 1)
    words = collapse_whitespace(F.translate(local_part, "._", "  "))
    return F.when(local_part == "", F.lit(fallback)).otherwise(F.initcap(words))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-case extension of the last path component; ``''`` for none or a dot file."""
    return F.lower(F.regexp_extract(path, r"(?:^|/)\.*[^./][^/]*\.([^./]*)$", 1))


def table_dataset(ref: Column, default: str = DEFAULT_DATASET) -> Column:
    return F.coalesce(F.try_element_at(F.split(ref, r"\."), F.lit(-2)), F.lit(default))


def table_name(ref: Column) -> Column:
    return F.substring_index(ref, ".", -1)


def table_base_name(ref: Column) -> Column:
    """Table name without ``_raw``, wherever it stands in the name."""
    return F.replace(table_name(ref), F.lit("_raw"), F.lit(""))


def is_raw_table(ref: Column) -> Column:
    return table_name(ref).endswith("_raw")


def thousands(col: Column) -> Column:
    return F.format_number(col, 0)


def money(col: Column) -> Column:
    return F.format_string("%.4f", col.cast("double"))


def scan_cost(bytes_scanned: Column) -> Column:
    return bytes_scanned.cast("double") / F.lit(float(1024**4)) * F.lit(PRICE_PER_TIB)


def new_id() -> Column:
    return F.replace(F.uuid(), F.lit("-"), F.lit(""))


def compact_timestamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss")
