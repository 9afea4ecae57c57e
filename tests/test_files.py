import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pactloom.sources import files


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def values(df):
    return rows(df.drop(files.SOURCE_FILE))


@pytest.mark.parametrize("skip", [0, 1, 3])
def test_csv_preamble(spark, tmp_path, skip):
    for name in ("a.csv", "b c.csv"):
        write(tmp_path / name, "".join(f"head {i}\n" for i in range(skip)) + f'{name}|"x|y"\n\n2|"say ""hi"""\n')
    df = files.scan_csv(spark, str(tmp_path), ["p", "q"], delimiter="|", skip_rows=skip)
    assert values(df) == [("2", 'say "hi"'), ("2", 'say "hi"'), ("a.csv", "x|y"), ("b c.csv", "x|y")]
    assert df.select(files.SOURCE_FILE).distinct().count() == 2


def test_csv_preamble_of_a_split_file(spark, tmp_path):
    write(tmp_path / "a.csv", "one\ntwo\nx,y\n" + "".join(f"{i},{i}\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = files.scan_csv(spark, str(tmp_path), ["x", "y"], skip_rows=3)
        assert df.rdd.getNumPartitions() > 3
        assert df.agg(F.count("x"), F.sum(F.col("x").cast("int"))).first()[:] == (20000, 199990000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_quote_character_and_empty_fields(spark, tmp_path):
    path = write(tmp_path / "a.csv", "p;q\n'a;b';''\n;x\n")
    assert values(files.scan_csv(spark, path, ["p", "q"], delimiter=";", quote="'")) == sorted([("a;b", ""), (None, "x")], key=repr)


@pytest.mark.parametrize("line", ["1", "1,2,3"])
def test_csv_ragged_row(spark, tmp_path, line):
    path = write(tmp_path / "a.csv", f"p,q\n1,2\n{line}\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.scan_csv(spark, path, ["p", "q"]).collect()
    kept = files.scan_csv(spark, path, ["p", "q"], fail_fast=False)
    assert sorted(r[files.CORRUPT] is None for r in kept.collect()) == [False, True]


def test_ndjson(spark, tmp_path):
    lines = [{"a": i, "b": {"c": [1, "x"]}} for i in range(60)] + [{"a": True, "late": 1.5}]
    path = write(tmp_path / "a.json", "\n".join(json.dumps(r) for r in lines))
    df = files.scan_ndjson(spark, path, ["a", "b", "late"])
    assert df.where("a = '5'").first()["b"] == '{"c": [1, "x"]}'
    assert df.where("a = 'true'").first()["late"] == "1.5"
    found = files.ndjson_columns(spark, [path]).first()
    assert found["headers"] == ["a", "b", "late"]


def test_ndjson_broken_line(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"a": 1}\n{"a": \n')
    with pytest.raises(Exception):
        files.scan_ndjson(spark, path, ["a"]).collect()
    kept = files.scan_ndjson(spark, path, ["a"], fail_fast=False).collect()
    assert sorted(r[files.CORRUPT] is None for r in kept) == [False, True]


def test_parquet_as_text(spark, tmp_path):
    spark.sql("SELECT 1 AS a, 2.50BD AS b, DATE '2024-01-02' AS c, true AS d, NULL AS e").write.parquet(str(tmp_path / "p"))
    df = files.scan_parquet(spark, str(tmp_path / "p"))
    assert values(df) == [("1", "2.50", "2024-01-02", "true", None)]
    assert {t for n, t in df.dtypes} == {"string"}
    assert dict(files.scan_parquet(spark, str(tmp_path / "p"), ["a"], as_text=False).dtypes)["a"] == "int"


def headers(spark, *specs):
    schema = "path string, file_format string, delimiter string, quote_char string, skip_header_rows int"
    found = files.read_headers(spark.createDataFrame(list(specs), schema)).collect()
    return {r["path"].rsplit("/", 1)[-1]: r for r in found}


def test_read_headers(spark, tmp_path):
    wide = ",".join(f"c{i}" for i in range(35))
    specs = [
        (write(tmp_path / "plain.csv", "﻿a,b,c,d,e\n1,2,3,4,5\n"), "csv", ",", '"', 1),
        (write(tmp_path / "semi.csv", "note\n\n'x;1';y\n5;6\n"), "csv", ";", "'", 2),
        (write(tmp_path / "twice.csv", "a,a,,a\n1,2,3,4\n"), "csv", ",", '"', 1),
        (write(tmp_path / "empty.csv", ""), "csv", ",", '"', 1),
        (write(tmp_path / "wide.csv", wide + "\n" + ("x" * 5000 + ",") * 34 + "\n"), "csv", ",", '"', 1),
        (write(tmp_path / "nested.json", '{"a": 1, "b": {"c": 2}}\n{"d": null}\n'), "json", ",", '"', 1),
        (write(tmp_path / "x.avro", "zzz"), "avro", ",", '"', 1),
        (str(tmp_path / "gone.csv"), "csv", ",", '"', 1),
    ]
    got = headers(spark, *specs)
    assert got["plain.csv"]["headers"] == ["a", "b", "c", "d", "e"]
    assert got["plain.csv"]["samples"] == [{"a": "1", "b": "2", "c": "3", "d": "4", "e": "5"}]
    assert got["semi.csv"]["headers"] == ["x;1", "y"]
    assert got["twice.csv"]["headers"] == ["a", "a.1", "Unnamed: 2", "a.2"]
    assert "No columns" in got["empty.csv"]["header_error"]
    assert len(got["wide.csv"]["headers"]) == 35
    assert got["nested.json"]["headers"] == ["a", "b", "d"]
    assert got["nested.json"]["samples"][0] == {"a": "1", "b": '{"c": 2}'}
    assert "Unsupported file format: avro" in got["x.avro"]["header_error"]
    assert got["gone.csv"]["header_error"].startswith("Failed to read metadata from gone.csv")


def test_parquet_headers(spark, tmp_path):
    spark.range(20).selectExpr("id", "id * 0.5 AS half").coalesce(1).write.parquet(str(tmp_path / "p"))
    path = str(next((tmp_path / "p").glob("*.parquet")))
    found = next(iter(headers(spark, (path, "parquet", ",", '"', 1)).values()))
    assert found["headers"] == ["id", "half"]
    assert len(found["samples"]) == 5


def test_listing_reads_no_contents(spark, tmp_path):
    write(tmp_path / "in" / "a b.csv", "a\n1\n")
    listed = files.list_files(spark, str(tmp_path))
    assert listed.select("file_name").first()[0] == "in/a b.csv"
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_sample_rows(spark):
    df = spark.createDataFrame([(i, float("nan") if i % 2 else 1.0) for i in range(200)], "a int, b double")
    sample = files.sample_rows(df)
    assert sample.count() == 50
    assert sample.where("lower(b) = 'nan'").count() == 0


def test_preamble_query_writes_a_file_for_each_task(spark, tmp_path):
    from pactloom.parity import CASES

    for name, parts in (("orders", 4), ("customer", 1)):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").repartition(parts).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = CASES["scan_csv_preamble"].build(spark, str(tmp_path))
    assert len(found.inputFiles()) >= 4
    assert found.count() == CASES["scan_csv_preamble"].build(spark, "/root/testdata/sf0.001").count()
