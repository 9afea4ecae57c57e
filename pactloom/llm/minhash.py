"""Near copies by DartMinHash: darts thrown into weighted element regions, the earliest of each coordinate kept."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pactloom.llm.common import (
    GOLDEN,
    free_prefix,
    listed,
    mix,
    prepare,
    stored,
    table,
    text_chunks,
    tidy,
    uniform,
    unlisted,
    window_hashes,
    word_hashes,
)
from pactloom.llm.graph import components, joined

WORDS = 5
SIMILARITY = 0.8
#: 32 bands of 4 coordinates: a pair of similarity 0.8 shares no band with probability (1 - 0.8^4)^32 = 5e-8.
COORDINATES = 128
ROWS = 4
#: How far apart two documents of a bucket may stand, in the order of their further coordinates, to be compared first.
NEIGHBOURS = 3
#: Documents with an element that one task compares with others.
SHARE_ROWS = 4096
#: Hash slots of elements whose parity is kept, 64 to a column.
ODD_BITS = 256
ODD = [f"odd_{j}" for j in range(ODD_BITS // 64)]

EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def dart_signatures(
    elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n_owners: int, k: int = COORDINATES, seed: int = 1
) -> np.ndarray:
    """``k`` coordinates for each weighted set: two agree with probability of their weighted Jaccard similarity.

    ``elements`` are 64-bit hashes, ``owner`` the set of each, ``weights`` its positive weight there. Darts fall on
    the plane of (weight, time) of an element as a Poisson process that depends on the element alone: in each dyadic
    weight region they follow each other at exponential gaps. A set catches the darts below its weights; of those
    with the same coordinate (a hash of the dart) the earliest counts. Only darts before about ``k log k + 2k``
    expected catches are thrown, twice as many again while a coordinate is empty; what was caught first stays.
    """
    signature = np.full((n_owners, k), EMPTY, np.uint64)
    total = np.bincount(owner, weights, n_owners)
    limit = np.divide(k * (np.log(k) + 2), total, out=np.zeros(n_owners), where=total > 0)
    open_sets = np.flatnonzero(total > 0)
    regions = np.where(weights <= 1, 1, np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64) + 1)
    source = np.repeat(np.arange(len(elements)), regions)
    region = np.arange(len(source)) - np.repeat(np.cumsum(regions) - regions, regions)
    low = np.where(region == 0, 0.0, 2.0 ** (region - 1.0))
    width = np.where(region == 0, 1.0, low)
    salt = mix(mix(np.array([seed])) + region.astype(np.uint64))
    start = mix(elements[source] ^ salt)
    set_of, weight = owner[source], weights[source]
    while len(open_sets):
        chosen = np.zeros(n_owners, bool)
        chosen[open_sets] = True
        live = np.flatnonzero(chosen[set_of])
        time = np.zeros(len(live))
        step = np.zeros(1, np.uint64)
        keys, times, darts = [], [], []
        while len(live):
            step += np.uint64(1)
            dart = mix(start[live] + step * GOLDEN)
            time = time - np.log(uniform(dart)) / width[live]
            in_time = time < limit[set_of[live]]
            live, time, dart = live[in_time], time[in_time], dart[in_time]
            name = mix(dart ^ np.uint64(0x5851F42D4C957F2D))
            caught = low[live] + width[live] * uniform(mix(name ^ GOLDEN)) < weight[live]
            keys.append(set_of[live][caught] * k + (name[caught] % np.uint64(k)).astype(np.int64))
            times.append(time[caught])
            darts.append(name[caught])
        key, when, dart = np.concatenate(keys), np.concatenate(times), np.concatenate(darts)
        latest_first = np.argsort(-when, kind="stable")
        signature.reshape(-1)[key[latest_first]] = dart[latest_first]
        open_sets = open_sets[(signature[open_sets] == EMPTY).any(axis=1)]
        limit[open_sets] *= 2
    return signature


def shingle_sets(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct word shingles of each text: hash, how often it stands there, number of the text."""
    hashes, owner = window_hashes(*word_hashes(texts), words)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(np.append(first, len(hashes)))
    return hashes[first], counts, owner[first]


def _signer(words: int, k: int, rows: int, weighted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end in text_chunks(batch.column("text")):
                part = batch.slice(at, end - at)
                texts = [t or "" for t in part.column("text").to_pylist()]
                elements, counts, owner = shingle_sets(texts, words)
                weights = counts.astype(float) if weighted else np.ones(len(counts))
                signed = dart_signatures(elements, weights, owner, len(texts), k)
                mixed = np.zeros((len(texts), k // rows), np.uint64)
                for j in range(rows):
                    mixed = mix(mixed + signed[:, j::rows][:, : k // rows] + GOLDEN)
                mixed = mix(mixed + np.arange(k // rows, dtype=np.uint64))
                size = np.bincount(owner, minlength=len(texts))
                sums = [np.zeros(len(texts), np.uint64) for _ in range(2)]
                for j, s in enumerate(sums):
                    np.add.at(s, owner, mix(elements + np.uint64(j + 1)) * (counts.astype(np.uint64) if weighted else np.uint64(1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array(size, pa.int64()),
                        *(pa.array(s.view(np.int64), pa.int64()) for s in sums),
                        pa.array(list(mixed.view(np.int64)), pa.list_(pa.int64())),
                    ],
                    ["doc_id", "text_hash", "size", "set_a", "set_b", "bands"],
                )

    return run


SIGNED = "doc_id long, text_hash long, size long, set_a long, set_b long, bands array<long>"


def signatures(docs: DataFrame, words: int = WORDS, weighted: bool = True) -> DataFrame:
    """Per document a hash of its text, the number of its shingles, a 128-bit name of their set, and its band keys."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(_signer(words, COORDINATES, ROWS, weighted), SIGNED)


def _near_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, then, doc_id): pairs of near rows of a key; and the rows at either end of the partition."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("then", pa.int64())])

    def out(a, b, key, then):
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, pa.int64()), pa.array(key), pa.array(then)], schema=schema)

    carried, first = np.empty((3, 0), np.int64), True
    for batch in batches:
        rows = np.stack([batch.column(c).to_numpy() for c in ("key", "then", "doc_id")])
        if first and rows.shape[1]:
            head = rows[:, :NEIGHBOURS]
            yield out(head[2], [None] * head.shape[1], head[0], head[1])
            first = False
        known = carried.shape[1]
        rows = np.concatenate([carried, rows], axis=1)
        for d in range(1, NEIGHBOURS + 1):
            at = np.arange(max(known, d), rows.shape[1])
            at = at[(rows[0, at] == rows[0, at - d]) & (rows[2, at] != rows[2, at - d])]
            if len(at):
                x, y = rows[2, at - d], rows[2, at]
                yield out(np.minimum(x, y), np.maximum(x, y), rows[0, at], rows[1, at])
        carried = rows[:, -NEIGHBOURS:]
    if carried.shape[1]:
        yield out(carried[2], [None] * carried.shape[1], carried[0], carried[1])


def candidate_pairs(signed: DataFrame) -> DataFrame:
    """Pairs ``(a, b, shared)`` of documents that stand near each other in a bucket; ``shared`` counts the buckets.

    A bucket is sorted by the next band's key, so that those which agree further stand together, and each document
    is compared with the next ``NEIGHBOURS`` only: the pairs grow with the rows, whatever a bucket holds. Buckets are
    dealt out by range, so a large one is spread over tasks; what the cuts separate is joined again from the rows at
    the ends of the partitions.
    """
    n = COORDINATES // ROWS
    rows = signed.where("size > 0 AND doc_id IS NOT NULL").select("doc_id", "bands", F.posexplode("bands").alias("i", "key"))
    rows = rows.select("key", F.element_at("bands", (F.col("i") + 1) % n + 1).alias("then"), "doc_id")
    dealt = rows.repartitionByRange("key", "then", "doc_id").sortWithinPartitions("key", "then", "doc_id")
    found = dealt.mapInArrow(_near_rows, "a long, b long, key long, then long")
    found = stored(found, "near-rows")
    ends = found.where("b IS NULL").select("key", "then", F.col("a").alias("doc_id")).distinct()
    order = Window.partitionBy("key").orderBy("then", "doc_id")
    near = [F.lag("doc_id", d).over(order) for d in range(1, NEIGHBOURS + 1)]
    ends = ends.withColumn("near", F.array(*near)).select("doc_id", "key", F.explode("near").alias("other"))
    ends = ends.where("other != doc_id")
    ends = ends.select(F.least("doc_id", "other").alias("a"), F.greatest("doc_id", "other").alias("b"), "key")
    pairs = found.where("b IS NOT NULL").select("a", "b", "key").union(ends)
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))


def _sets(words: int, weighted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end in text_chunks(batch.column("text")):
                part = batch.slice(at, end - at)
                texts = [t or "" for t in part.column("text").to_pylist()]
                elements, counts, owner = shingle_sets(texts, words)
                if weighted:  # the second time a shingle stands in a text it is another element
                    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                    elements, owner = np.repeat(elements, counts), np.repeat(owner, counts)
                    elements = np.where(nth > 0, mix(elements + nth.astype(np.uint64) * GOLDEN), elements)
                total = np.bincount(owner, minlength=len(texts))
                slot = owner * ODD_BITS + (elements % np.uint64(ODD_BITS)).astype(np.int64)
                odd = np.bincount(slot, minlength=len(texts) * ODD_BITS).reshape(-1, ODD_BITS) & 1
                odd = np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)
                lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(total)).astype(np.int32), pa.array(elements.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(total), lists, *(pa.array(np.ascontiguousarray(o)) for o in odd.T)],
                    ["doc_id", "total", "elements", *ODD],
                )

    return run


def element_sets(texts: DataFrame, words: int = WORDS, weighted: bool = True) -> DataFrame:
    """Per text the number of its elements, the elements, and bits that say of which hash slots it has an odd number.

    In as many bits as two texts differ, they have elements that the other lacks, at least.
    """
    schema = "doc_id long, total long, elements array<long>, " + ", ".join(f"{c} long" for c in ODD)
    return texts.select("doc_id", "text").mapInArrow(_sets(words, weighted), schema)


def rarest_elements(sets: DataFrame, at_least: float = SIMILARITY) -> DataFrame:
    """``doc_id, total, key, place``: the rarest elements of each set, as many as a set so similar can't lack all of.

    With all elements in one order, the rarest first, two sets that share ``at_least`` of the larger one share one of
    their first ``total - at_least * total + 1``. What no other set has comes first and can't be shared, so it counts
    for the places only; a set with so many of these has no row.
    """
    rows = sets.select("doc_id", "total", F.explode("elements").alias("key"))
    often = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = rows.join(often.hint("merge"), "key")
    of_text = Window.partitionBy("doc_id")
    place = F.col("total") - F.count(F.lit(1)).over(of_text) + F.row_number().over(of_text.orderBy("n", "key")) - 1
    placed = shared.withColumn("place", place)
    return placed.where(f"place <= total - ceil({at_least!r}D * total - 1e-9D)").select("doc_id", "total", "key", "place")


def far_pairs(
    members: DataFrame, texts: DataFrame, at_least: float = SIMILARITY, words: int = WORDS, weighted: bool = True
) -> DataFrame:
    """Pairs ``(a, b)`` of ``members`` in buckets of several classes that belong to two classes and may be similar enough.

    ``members`` has ``doc_id, bands, root``, ``texts`` their texts. Documents of such a bucket are looked up by their
    rarest elements, and pairs are left out whose sizes, places or odd bits show that they have too little in common:
    all bounds, so no link is lost. Of the documents with an element, those outside their largest class are held
    against all of them; those within a class need no link more.
    An element that many documents have is compared in shares, so no task holds it whole.
    """
    banded = members.select("doc_id", "root", F.explode("bands").alias("band"))
    # In a smaller bucket everybody was near everybody.
    wide = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    wide = wide.where((F.col("low") != F.col("high")) & (F.col("n") > NEIGHBOURS + 1))
    open_ends = stored(banded.join(wide.select("band").hint("merge"), "band").select("doc_id", "root").distinct(), "open-ends")
    open_texts = listed(texts, open_ends, "doc_id").join(open_ends.select("doc_id").hint("merge"), "doc_id")
    sets = stored(element_sets(open_texts, words, weighted), "sets")
    ends = open_ends.join(sets.select("doc_id", *ODD).hint("merge"), "doc_id")
    rows = stored(rarest_elements(sets, at_least).join(ends.hint("merge"), "doc_id"), "rarest")
    of_class = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max(F.struct("n", (-F.col("root")).alias("root")))
    buckets = of_class.groupBy("key").agg(
        F.count(F.lit(1)).alias("classes"), F.sum("n").alias("n"), (-largest["root"]).alias("main")
    )
    shares = F.ceil(F.col("n") / SHARE_ROWS).cast("int").alias("shares")
    buckets = buckets.where("classes > 1").select("key", "main", shares)
    rows = stored(rows.join(buckets.hint("merge"), "key"), "open-buckets")
    bucket = rows.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.col("shares")).cast("int")).alias("x")
    others = rows.where("root != main").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).alias("y")
    # Two sets so similar have ``wanted`` elements in common, and one of them so early that so many can follow it.
    wanted = f"{at_least / (1 + at_least)!r}D * (x.total + y.total) - 1e-6D"
    common = "least(x.place, y.place) + least(x.total - x.place, y.total - y.place)"
    early = "least(x.total - x.place, y.total - y.place)"
    enough = f"{common} >= {wanted} AND {early} >= {wanted}"
    sizes = f"least(x.total, y.total) >= {at_least!r}D * greatest(x.total, y.total) - 1e-6D"
    apart = " + ".join(f"bit_count(x.{c} ^ y.{c})" for c in ODD)
    few = f"{apart} <= {(1 - at_least) / (1 + at_least)!r}D * (x.total + y.total) + 1e-6D"
    alike = f"x.key = y.key AND x.share = y.share AND x.root != y.root AND {sizes} AND {enough} AND {few}"
    pairs = bucket.hint("merge").join(others, F.expr(alike))
    return pairs.select(F.expr("least(x.doc_id, y.doc_id) AS a"), F.expr("greatest(x.doc_id, y.doc_id) AS b")).distinct()


def _judge(words: int, weighted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end in text_chunks(batch.column("text_a")):
                part = batch.slice(at, end - at)
                n = len(part)
                texts = [t or "" for c in ("text_a", "text_b") for t in part.column(c).to_pylist()]
                elements, counts, owner = shingle_sets(texts, words)
                weight = counts if weighted else np.ones(len(counts), np.int64)
                pair = owner % n
                order = np.lexsort((elements, pair))
                elements, pair, weight = elements[order], pair[order], weight[order]
                twice = (elements[1:] == elements[:-1]) & (pair[1:] == pair[:-1])
                common = np.bincount(pair[1:][twice], np.minimum(weight[1:], weight[:-1])[twice], n)
                every = np.bincount(pair, weight, n) - common
                likeness = np.divide(common, every, out=np.zeros(n), where=every > 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("a"), part.column("b"), pa.array(likeness)], ["a", "b", "similarity"]
                )

    return run


def similarity(pairs: DataFrame, texts: DataFrame, words: int = WORDS, weighted: bool = True) -> DataFrame:
    """The exact Jaccard similarity of the word shingles of each pair ``(a, b)``; ``pairs`` is a stored table."""
    sides = {end: texts.select(F.col("doc_id").alias(end), F.col("text").alias(f"text_{end}")) for end in ("a", "b")}
    a, b = (listed(side, pairs.select(end), end) for end, side in sides.items())
    both = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_judge(words, weighted), "a long, b long, similarity double")


@tidy
def _classified(docs: DataFrame, words: int, at_least: float, weighted: bool) -> DataFrame:
    """``doc_id, text_hash, class_id`` for each row of ``docs``."""
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(signatures(docs, words, weighted), "signatures")
    heads = signed.where("size > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b").agg(
        F.min("doc_id").alias("doc_id"), F.min_by("bands", "doc_id").alias("bands")
    )
    heads = stored(heads.withColumn("size", F.lit(1)), "heads")
    pairs = stored(candidate_pairs(heads), "pairs")
    ends = stored(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct(), "pair-ends")
    # A repeated doc_id may stand for several texts; one of them, the same each time, is compared.
    texts = listed(docs, ends, "doc_id").join(ends, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    texts = stored(texts, "pair-texts")

    best = F.max(F.struct("shared", (-F.col("other")).alias("other")))
    sides = pairs.select("a", "b", "shared", F.col("a").alias("me"), F.col("b").alias("other"))
    sides = sides.union(pairs.select("a", "b", "shared", F.col("b").alias("me"), F.col("a").alias("other")))
    likeliest = sides.groupBy("me").agg(best.alias("x")).select("me", (-F.col("x.other")).alias("other"))
    likeliest = likeliest.select(F.least("me", "other").alias("a"), F.greatest("me", "other").alias("b")).distinct()
    likeliest = stored(likeliest, "likeliest")
    first = stored(similarity(likeliest, texts, words, weighted), "judged-first")
    near = F.col("similarity") >= at_least
    classes = components(first.where(near))
    # Later rounds judge pairs of two classes only, and join the classes' roots instead of their members.
    rest = pairs.join(first, ["a", "b"], "left_anti").select("a", "b")
    for end in ("a", "b"):
        of_end = classes.select(F.col("id").alias(end), F.col("root").alias(f"root_{end}"))
        rest = rest.join(of_end, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    rest = stored(rest.where("root_a != root_b").select("a", "b", "root_a", "root_b"), "rest")
    second = stored(similarity(rest, texts, words, weighted), "judged-rest")
    links = second.where(near).join(rest, ["a", "b"])
    classes = stored(joined(classes, components(links, "root_a", "root_b")), "classes-second")
    # Who stands near nobody is alone in all of its buckets.
    members = listed(heads, ends, "doc_id").join(ends, "doc_id").join(classes.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    members = stored(members.withColumn("root", F.coalesce("root", "doc_id")), "members")
    far = far_pairs(members, texts, at_least, words, weighted).join(first, ["a", "b"], "left_anti").join(second, ["a", "b"], "left_anti")
    third = stored(similarity(stored(far, "far"), texts, words, weighted), "judged-far").where(near).select("a", "b")
    for end in ("a", "b"):
        third = third.join(members.select(F.col("doc_id").alias(end), F.col("root").alias(f"root_{end}")), end)
    classes = joined(classes, components(third, "root_a", "root_b"))
    named = heads.join(classes.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    named = named.select("set_a", "set_b", F.coalesce("root", "doc_id").alias("class_id"))
    out = signed.select("doc_id", "text_hash", "size", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    return out.select("doc_id", "text_hash", F.when(F.col("size") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"))


def near_copies(docs: DataFrame, words: int = WORDS, at_least: float = SIMILARITY, weighted: bool = True) -> DataFrame:
    """``doc_id, class_id`` per document: who belongs together, named by the smallest doc_id.

    Two documents are linked when the Jaccard similarity of their word shingles, each weighted by how often it stands
    in the text (else, without ``weighted``, by 1), is ``at_least`` that; a class is what links connect. Documents with
    the same weighted set are one from the start. Candidates share a bucket. Of those that stand near each other there
    each document's likeliest is judged first; the others, and then the far ones, only where they would still join two
    classes and bounds allow it: no link is lost there.

    Null and empty texts and texts without a word are classes of their own; a text of fewer than ``words`` words is
    one shingle. Rows without a doc_id share the class of an equal set, else their class is null. Repeated rows are
    kept as rows. An empty table gives an empty result. Other columns are not read.
    """
    return _classified(docs, words, at_least, weighted).drop("text_hash")


@tidy
def keep_one(docs: DataFrame, words: int = WORDS, at_least: float = SIMILARITY, weighted: bool = True) -> DataFrame:
    """One document of each class of near copies, that with the smallest doc_id; all columns as they were.

    Of rows with one doc_id that is the class's smallest the text with the smallest hash stays, and of equal texts one
    row. Rows without a doc_id stay.

    What stays and what goes is decided on ids and hashes. Two bitmaps, of the ids that go and of those that stay, tell
    both apart for most rows; only rows that are in both are joined, so few texts are shuffled.
    """
    found = _classified(docs, words, at_least, weighted).where("doc_id IS NOT NULL")
    least = found.where("doc_id = class_id").groupBy("doc_id").agg(F.min("text_hash").alias("kept_hash"))
    rows = found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).join(least, "doc_id", "left")
    rows = stored(rows, "verdicts")
    stays = rows.where("text_hash = kept_hash")
    goes = rows.where("kept_hash IS NULL OR text_hash != kept_hash OR n > 1")
    p = free_prefix(docs)
    own = docs.select("*", F.col("doc_id").cast("long").alias(f"{p}id"), F.xxhash64(F.col("text").cast("string")).alias(f"{p}hash"))
    with_id = own.where(F.col(f"{p}id").isNotNull())
    name = lambda df: df.select(F.col("doc_id").alias(f"{p}id"), F.col("text_hash").alias(f"{p}hash"))
    plain = unlisted(with_id, name(goes), f"{p}id")
    doubtful = listed(listed(with_id, name(goes), f"{p}id"), name(stays), f"{p}id")
    judged = doubtful.join(name(stays), [f"{p}id", f"{p}hash"]).dropDuplicates([f"{p}id"])
    return plain.unionByName(judged).unionByName(own.where(F.col(f"{p}id").isNull())).select(*(F.col(f"`{c}`") for c in docs.columns))


def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))
