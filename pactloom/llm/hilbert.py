"""Sharding along a Hilbert curve over several metadata columns, so that a file holds a small box of all of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pactloom.llm.common import free_prefix, stored, table

SHARDS = 8
#: Bits of each dimension on the curve: a dimension is cut into 2^6 levels of about as many rows each.
BITS = 6
#: Rows that are numbered in one window, about.
BUCKET_ROWS = 50_000
#: Rows of one written file, at most.
FILE_ROWS = 250_000
DIMENSIONS = ("lang", "source", "n_chars")

#: Ranks of the quantiles are exact to one in this many rows.
ACCURACY = 100_000


def _common_prefix(a: str | None, b: str | None) -> int:
    n = 0
    for x, y in zip(a or "", b or "", strict=False):
        if x != y:
            break
        n += 1
    return n


def sortable(docs: DataFrame, dims: Sequence[str]) -> list[Column]:
    """A number for each dimension that grows with its values; null stays null.

    Numbers, dates and timestamps stand for themselves. Of a text the six bytes after what all values begin with
    count, so values that agree in those share a level.
    """
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    texts = [d for d in dims if not isinstance(kinds[d], T.NumericType | T.DateType | T.TimestampType | T.BooleanType)]
    ends = [e for d in texts for e in (F.min(F.col(f"`{d}`").cast("string")), F.max(F.col(f"`{d}`").cast("string")))]
    found = list(docs.agg(F.count(F.lit(1)), *ends).first())[1:]
    skip = {d: _common_prefix(found[2 * i], found[2 * i + 1]) for i, d in enumerate(texts)}

    def number(d: str) -> Column:
        value = F.col(f"`{d}`")
        if d in skip:
            raw = F.rpad(F.hex(F.substring(F.encode(F.substring(value.cast("string"), skip[d] + 1, 6), "UTF-8"), 1, 6)), 12, "0")
            return F.conv(raw, 16, 10).cast("double")
        if isinstance(kinds[d], T.DateType):
            return F.unix_date(value).cast("double")
        number = value.cast("double")
        return F.when(~F.isnan(number), number)

    return [number(d) for d in dims]


def levels(docs: DataFrame, dims: Sequence[str], bits: int = BITS) -> Column:
    """An array with the level (0 to 2^bits - 1) of each dimension: cuts lie at quantiles over all rows; null is level 0."""
    numbers = sortable(docs, dims)
    shares = [i / 2**bits for i in range(1, 2**bits)]
    cuts = docs.agg(*(F.percentile_approx(n, shares, ACCURACY) for n in numbers)).first()

    def level(n: Column, at: list[float] | None) -> Column:
        if not at:
            return F.lit(0).cast("long")
        bounds = F.array(*(F.lit(float(x)) for x in sorted(set(at))))
        return F.coalesce(F.size(F.filter(bounds, lambda b: b <= n)), F.lit(0)).cast("long")

    return F.array(*(level(n, at) for n, at in zip(numbers, cuts, strict=True)))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), body), 1)


def curve_index(axes: Column, n: int, bits: int = BITS) -> Column:
    """The place on the Hilbert curve of a point with ``n`` coordinates of ``bits`` bits, given as an array.

    From the highest bit down, a set bit of a coordinate mirrors the lower bits of the first one, a clear bit swaps
    them with the first one's (Skilling's transform); what that leaves, read as a Gray code bit by bit across the
    coordinates, is the index.
    """
    zero = F.lit(0).cast("long")
    masks = [1 << b for b in range(bits - 1, -1, -1)]

    def each_bit(of: list[int]) -> Column:
        return F.array(*(F.struct(F.lit(q).cast("long").alias("q"), F.lit(i).alias("i")) for q in of for i in range(n)))

    def turn(x: Column, step: Column) -> Column:
        own, low = F.element_at(x, step["i"] + 1), step["q"] - 1
        is_set = own.bitwiseAND(step["q"]) != 0
        differ = F.element_at(x, 1).bitwiseXOR(own).bitwiseAND(low)
        first, other = F.when(is_set, low).otherwise(differ), F.when(is_set, zero).otherwise(differ)
        return F.transform(x, lambda v, j: v.bitwiseXOR(F.when(j == 0, first).otherwise(zero)).bitwiseXOR(F.when(j == step["i"], other).otherwise(zero)))

    def gray(x: Column) -> Column:
        return F.transform(x, lambda v, j: F.aggregate(F.slice(x, F.lit(1), j + 1), zero, lambda s, y: s.bitwiseXOR(y)))

    def fix(x: Column) -> Column:
        flips = F.array(*(F.lit(q).cast("long") for q in masks[:-1]))
        return F.aggregate(flips, zero, lambda t, q: t.bitwiseXOR(F.when(F.element_at(x, n).bitwiseAND(q) != 0, q - 1).otherwise(zero)))

    def read(x: Column, t: Column) -> Column:
        bit = lambda p: F.when(F.element_at(x, p["i"] + 1).bitwiseXOR(t).bitwiseAND(p["q"]) != 0, 1).otherwise(0)
        return F.aggregate(each_bit(masks), zero, lambda s, p: s * 2 + bit(p))

    turned = F.aggregate(each_bit(masks[:-1]), axes, turn)
    return _let(turned, lambda x: _let(gray(x), lambda y: _let(fix(y), lambda t: read(y, t))))


def _offsets(buckets: DataFrame) -> DataFrame:
    """``h, part, rows_before, bytes_before``: running sums over the buckets, by groups of places on the curve.

    Only the groups' totals (at most 2^10 of them) meet in one window; each group is summed by a task of its own.
    """
    last = buckets.agg(F.max("h").alias("h")).first()["h"]
    width = max(0, int(last or 0).bit_length() - 10)
    grouped = buckets.withColumn("g", F.shiftright("h", width))
    totals = grouped.groupBy("g").agg(F.sum("n").alias("gn"), F.sum("b").alias("gb"))
    before = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("g", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("gn", "gb")))
    within = Window.partitionBy("g").orderBy("h", "part").rowsBetween(Window.unboundedPreceding, -1)
    summed = grouped.select("g", "h", "part", *(F.coalesce(F.sum(c).over(within), F.lit(0)).alias(f"w{c}") for c in ("n", "b")))
    return summed.join(totals, "g").select("h", "part", (F.col("wn") + F.col("gn")).alias("rows_before"), (F.col("wb") + F.col("gb")).alias("bytes_before"))


def sharded(
    docs: DataFrame,
    dims: Sequence[str] = DIMENSIONS,
    *,
    shards: int = SHARDS,
    law: str = "rows",
    id_column: str = "doc_id",
    text: str = "text",
    bits: int = BITS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``docs`` with ``size, text_crc32, curve, shard, slot``: cut into ``shards`` runs along the curve over ``dims``.

    Rows are ordered by their place on the curve, then by a hash of the id, the id and the text's checksum. With the
    law ``rows`` runs differ by one row at most; with ``bytes`` a row belongs to the run in which it begins, so runs
    differ by less than the largest row. ``slot`` numbers a shard's rows from 0.

    Numbers come from counts: rows are counted by place, a place with many rows is cut into ranges of the hash, and
    only a bucket of about ``bucket_rows`` rows is sorted in one window. A hot place is thus many buckets.

    A null text has no bytes; a row's size is that of its text plus 1. Null dimensions are level 0. Rows that agree in
    place, id and checksum follow each other in any order; all rows without an id at one place share a bucket. Columns
    of ``docs`` named like the new ones are replaced. An empty table gives an empty result.
    """
    if bits < 2 or law not in ("rows", "bytes"):
        raise ValueError(f"no such law: {law}, or too few bits: {bits}")
    new = ("size", "text_crc32", "curve", "shard", "slot")
    columns = [c for c in docs.columns if c not in new]
    text_column = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    p = free_prefix(docs)
    sorting = F.struct(F.xxhash64(f"`{id_column}`").alias("x"), F.col(f"`{id_column}`").alias("i"), F.crc32(F.encode(text_column, "UTF-8")).alias("c"))
    index = curve_index(levels(docs, dims, bits), len(dims), bits)
    placed = docs.select(
        *(F.col(f"`{c}`") for c in columns),
        (F.octet_length(text_column) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text_column, "UTF-8")).alias("text_crc32"),
        index.alias("curve"),
        sorting.alias(f"{p}o"),
    )
    meta = stored(placed.select("curve", f"{p}o", "size"), "curve")
    places = meta.groupBy("curve").agg(F.count(F.lit(1)).alias("n"))
    places = stored(places.select("curve", F.ceil(F.col("n") / bucket_rows).cast("int").alias(f"{p}parts")), "places")
    if len(dims) * bits <= 20:  # as many places at most
        places = F.broadcast(places)

    def in_parts(rows: DataFrame) -> DataFrame:
        # A place's range of hashes in equal parts; the upper half of the hash, counted from the smallest, tells them.
        upper = F.shiftrightunsigned(F.col(f"{p}o.x").bitwiseXOR(F.lit(-(2**63))), 32).cast("double")
        part = F.floor(upper / F.lit(2.0**32) * F.col(f"{p}parts")).cast("int")
        return rows.join(places, "curve").withColumn(f"{p}part", part)

    buckets = in_parts(meta).groupBy(F.col("curve").alias("h"), F.col(f"{p}part").alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b"))
    buckets = stored(buckets, "curve-buckets")
    total = buckets.agg(F.sum("n").alias("n"), F.sum("b").alias("b")).first()
    n_rows, n_bytes = total["n"] or 1, total["b"] or 1
    names = {"h": "curve", "part": f"{p}part", "rows_before": f"{p}rows", "bytes_before": f"{p}bytes"}
    before = stored(_offsets(buckets).withColumnsRenamed(names), "curve-offsets")
    order = Window.partitionBy("curve", f"{p}part").orderBy(f"{p}o")
    running = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = in_parts(placed).withColumn(f"{p}row", F.row_number().over(order) - 1)
    if law == "bytes":
        rows = rows.withColumn(f"{p}byte", F.coalesce(F.sum("size").over(running), F.lit(0)))
    rows = rows.join(before, ["curve", f"{p}part"]).withColumn(f"{p}row", F.col(f"{p}row") + F.col(f"{p}rows"))
    if law == "rows":
        first = F.expr(f"({p}shard * {n_rows}L + {shards - 1}L) div {shards}L")
        rows = rows.withColumn(f"{p}shard", F.expr(f"({p}row * {shards}L) div {n_rows}L")).withColumn("slot", F.col(f"{p}row") - first)
    else:
        rows = rows.withColumn(f"{p}shard", F.expr(f"(({p}bytes + {p}byte) * {shards}L) div {n_bytes}L"))
        starts = stored(rows.groupBy(f"{p}shard").agg(F.min(f"{p}row").alias(f"{p}first")), "shard-starts")
        # A row for each shard.
        rows = rows.join(F.broadcast(starts), f"{p}shard").withColumn("slot", F.col(f"{p}row") - F.col(f"{p}first"))
    kept = (F.col(f"`{c}`") for c in columns)
    return rows.select(*kept, "size", "text_crc32", "curve", F.col(f"{p}shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))


def write_shards(docs: DataFrame, folder: str, dims: Sequence[str] = DIMENSIONS, *, file_rows: int = FILE_ROWS, **options) -> DataFrame:
    """Writes ``docs`` as Parquet, a folder for each shard, rows in the order of the curve; gives the manifest.

    A file holds a run of at most ``file_rows`` rows of the curve, so the smallest and largest values that its footer
    keeps for each dimension span a small box, and a filter on any of them skips most files. The manifest lists for each
    file its rows and those values.
    """
    placed = sharded(docs, dims, **options)
    runs = placed.select("shard", F.floor(F.col("slot") / file_rows)).distinct().count()
    dealt = placed.repartitionByRange(max(1, runs), "shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").option("maxRecordsPerFile", file_rows).parquet(folder)
    written = docs.sparkSession.read.parquet(folder)
    spans = [e for d in dims for e in (F.min(f"`{d}`").alias(f"{d}_min"), F.max(f"`{d}`").alias(f"{d}_max"))]
    return written.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n"), F.min("shard").alias("shard"), *spans)


def op13_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharded(table(spark, sf_dir, "documents"), law="rows")
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")
