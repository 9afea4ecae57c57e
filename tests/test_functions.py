from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pactloom.functions import casts, messages, predicates, text


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(build(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, type_name, expected",
    [
        ("12", "INT64", 12),
        (" 12 ", "INT64", 12),
        ("-7", "INT64", -7),
        ("12.5", "INT64", None),
        ("1e3", "INT64", None),
        ("0x1A", "INT64", 26),
        ("-0x1a", "INT64", -26),
        ("0xFFFFFFFFFFFFFFFF", "INT64", None),
        ("9223372036854775807", "INT64", 2**63 - 1),
        ("9223372036854775808", "INT64", None),
        ("00000000000000000000000042", "INT64", 42),
        ("", "INT64", None),
        (None, "INT64", None),
        ("12.3456789015", "NUMERIC", Decimal("12.345678902")),
        ("1e3", "NUMERIC", Decimal("1000.000000000")),
        ("N/A", "NUMERIC", None),
        ("1" + "0" * 30, "NUMERIC", None),
        ("2.5", "FLOAT64", 2.5),
        ("2.5f", "FLOAT64", None),
        ("1d", "FLOAT64", None),
        ("0x1p3", "FLOAT64", None),
        ("-inf", "FLOAT64", float("-inf")),
        (".5e1", "FLOAT64", 5.0),
        ("TRUE", "BOOL", True),
        ("t", "BOOL", None),
        ("1", "BOOL", None),
        ("2024-1-5", "DATE", date(2024, 1, 5)),
        ("2024-01-05 10:00:00", "DATE", date(2024, 1, 5)),
        ("2024-01-05 garbage", "DATE", None),
        ("2024", "DATE", None),
        ("2024-01", "DATE", None),
        ("now", "DATE", None),
        ("20240105", "DATE", None),
        ("2024-13-45", "DATE", None),
        ("2024-01-05 10:00:00", "TIMESTAMP", datetime(2024, 1, 5, 10)),
        ("10:00", "TIMESTAMP", None),
        ("now", "TIMESTAMP", None),
        ('{"a": 1}', "JSON", '{"a": 1}'),
        ("{a", "JSON", None),
        (" x ", "STRING", " x "),
    ],
)
def test_safe_cast(spark, value, type_name, expected):
    assert one(spark, value, lambda c: casts.safe_cast(c, type_name)) == expected


def test_safe_cast_of_typed_column(spark):
    assert one(spark, 12.5, lambda c: casts.safe_cast(c, "INT64", from_text=False), "double") == 12
    with pytest.raises(ValueError):
        casts.safe_cast(F.lit("x"), "BLOB")


def test_safe_parse(spark):
    assert one(spark, "2024-02-30", casts.safe_parse_date) is None
    assert one(spark, "2024-02-29", casts.safe_parse_date) == date(2024, 2, 29)
    assert one(spark, "soon", casts.safe_parse_timestamp) is None


@pytest.mark.parametrize(
    "value, expected",
    [
        ("```sql\nselect 1\nfrom x\n```", "select 1\nfrom x"),
        ("```\nabc", "abc"),
        ("```sql select 1```", " select 1"),
        ("plain\ntext", "plain\ntext"),
        ("", ""),
    ],
)
def test_strip_code_fence(spark, value, expected):
    assert one(spark, value, text.strip_code_fence) == expected


@pytest.mark.parametrize(
    "value", ["a  b", " a\n\tb ", "a b", "\x1ca\x1fb", "a 　b", "", "a b", "\x85a", "é é", "​x"]
)
def test_collapse_whitespace(spark, value):
    assert one(spark, value, text.collapse_whitespace) == " ".join(value.split())


def test_collapse_whitespace_of_null(spark):
    assert one(spark, None, text.collapse_whitespace) == ""


@pytest.mark.parametrize(
    "value, expected",
    [("org:jane_van.DOE@x.com", "Jane Van Doe"), ("bob@x", "Bob"), ("@x.com", "User"), ("plain", "Plain")],
)
def test_display_name(spark, value, expected):
    assert one(spark, value, text.display_name) == expected


@pytest.mark.parametrize(
    "value", ["a/b.c/x.CSV", "x", ".csv", "a..csv", "..csv", "dir.d/file", "a/.x.json", "in/view_1.tar.gz", "a."]
)
def test_extension(spark, value):
    import os.path

    assert one(spark, value, text.extension) == os.path.splitext(value)[1].lower().replace(".", "")


def test_table_references(spark):
    refs = [("p.q.orders_raw",), ("q.a_raw_b_raw",), ("orders",)]
    got = spark.createDataFrame(refs, "v string").select(
        text.table_dataset(F.col("v")), text.table_name(F.col("v")), text.table_base_name(F.col("v")), text.is_raw_table(F.col("v"))
    )
    assert [tuple(r) for r in got.collect()] == [
        ("q", "orders_raw", "orders", True),
        ("q", "a_raw_b_raw", "a_b", True),
        ("raw", "orders", "orders", False),
    ]


@pytest.mark.parametrize("value, expected", [(" x ", "x"), ("NaN", None), ("  ", None), (None, None), ("nano", "nano")])
def test_norm_blank(spark, value, expected):
    assert one(spark, value, text.norm_blank) == expected


def test_numbers_and_errors(spark):
    assert one(spark, 1234567, text.thousands, "bigint") == "1,234,567"
    assert one(spark, 0.05, text.money, "double") == "0.0500"
    assert one(spark, 2**40, text.scan_cost, "bigint") == 6.25
    assert len(one(spark, "x" * 3000, text.truncate_error)) == 2000
    assert one(spark, "", text.truncate_error) is None
    assert len(one(spark, "x", lambda c: text.new_id())) == 32


def test_any_blank_keeps_white_space(spark):
    df = spark.createDataFrame([("a", " "), ("a", ""), (None, "b")], "x string, `y.z` string")
    assert [r[0] for r in df.select(predicates.any_blank(df.columns)).collect()] == [False, True, True]


def test_in_range_is_null_for_null(spark):
    got = spark.createDataFrame([(5,), (None,), (11,)], "v int").select(predicates.in_range(F.col("v"), 0, 10))
    assert [r[0] for r in got.collect()] == [True, None, False]


def test_base64_round_trip(spark):
    assert one(spark, "é\n" * 100, lambda c: messages.decode_base64(messages.encode_base64(c))) == "é\n" * 100
