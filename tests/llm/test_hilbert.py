import zlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pactloom.llm import hilbert

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, _o int"


@pytest.mark.parametrize(("n", "bits"), [(1, 3), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_neighbours(spark, n, bits):
    side = 1 << bits
    points = spark.range(side**n).select(F.array(*((F.floor(F.col("id") / side**i) % side).cast("long") for i in range(n))).alias("p"))
    got = points.select("p", hilbert.curve_index(F.col("p"), n, bits).alias("i")).orderBy("i").collect()
    assert [r["i"] for r in got] == list(range(side**n))
    for a, b in zip(got, got[1:], strict=False):
        assert sum(abs(x - y) for x, y in zip(a["p"], b["p"], strict=True)) == 1


def check(got, n, law, shards=8):
    assert len(got) == n
    by = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
    for s, of_shard in by.items():
        assert 0 <= s < shards
        assert sorted(r["slot"] for r in of_shard) == list(range(len(of_shard)))
    curve = [r["curve"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert curve == sorted(curve)
    sums = [sum(1 if law == "rows" else r["size"] for r in by.get(s, [])) for s in range(shards)]
    assert max(sums) - min(sums) <= (1 if law == "rows" else 2 * max(r["size"] for r in got))


@pytest.mark.parametrize("law", ["rows", "bytes"])
@pytest.mark.parametrize("bucket_rows", [7, 50_000])
def test_shards_are_level(spark, law, bucket_rows):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    # A third of all rows at one place of the curve.
    hot = docs.limit(1).crossJoin(spark.range(100).select(F.col("id").alias("k"))).withColumn("doc_id", F.col("k") + 10_000).drop("k")
    both = docs.unionByName(hot)
    got = hilbert.sharded(both, law=law, bucket_rows=bucket_rows).collect()
    check(got, both.count(), law)
    for r in got:
        raw = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 1, zlib.crc32(raw))


def test_shards_of_odd_rows(spark):
    data = [(i, t, lang, s, n, "x", "y", 1) for i, t, lang, s, n in [(1, "a", "en", "s1", 1), (1, "a", "en", "s1", 1), (None, None, None, None, None), (2, "", "de", "s2", 0), (3, "é" * 200_000, "en", "s10", 200_000)]]
    odd = spark.createDataFrame(data + [(None, "z", None, "", -5, None, None, None)] * 12, SCHEMA)
    for law in ("rows", "bytes"):
        check(hilbert.sharded(odd, law=law, bucket_rows=2).collect(), 17, law)
    none = hilbert.sharded(odd.limit(0))
    assert none.count() == 0 and {"size", "shard", "slot"} <= set(none.columns)


def test_files_hold_small_boxes(spark, tmp_path):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"),
        F.element_at(F.array(*map(F.lit, ("de", "en", "es", "fr"))), (F.xxhash64("id") % 2 + 2).cast("int")).alias("lang"),
        F.concat(F.lit("src"), (F.pmod(F.hash("id"), F.lit(40))).cast("string")).alias("source"),
        F.pmod(F.xxhash64("id", F.lit(2)), F.lit(9_000)).alias("n_chars"),
    )
    manifest = hilbert.write_shards(docs, str(tmp_path / "shards"), file_rows=500).collect()
    assert sum(r["n"] for r in manifest) == 20_000 and {r["shard"] for r in manifest} == set(range(8)) and len(manifest) >= 40
    read = lambda keep: sum(1 for r in manifest if keep(r))
    # Files in any other order would nearly all hold each of these.
    assert read(lambda r: r["n_chars_min"] <= 1000) <= len(manifest) / 2
    assert read(lambda r: r["source_min"] <= "src17" <= r["source_max"]) <= len(manifest) / 2
    assert rows(spark.read.parquet(str(tmp_path / "shards")).select("doc_id")) == rows(docs.select("doc_id"))


def test_query_covers_every_document(spark):
    from pactloom.llm import queries

    got = queries.QUERIES["op13_hilbert_shards"](spark, "/root/testdata/sf0.001").collect()
    check(got, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count(), "rows")
    assert {r["law"] for r in got} == {"rows"} and {r["grown_shard"] for r in got} == {None}
