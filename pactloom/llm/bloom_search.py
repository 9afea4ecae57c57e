"""Ranked lexical search over bit-sliced Bloom signatures: bounds from slices, exact scores for all that bounds can't exclude.

A document's signature has a bit for each (term, level): level 0 for a term that occurs, level l for one that occurs
2^l times at least. Documents with signatures of one length share a block, a matrix with a row per bit and a column per
document. The rows that belong to a query term, ANDed, are the documents that may hold it so often: a superset. Sums of
those bitmaps, weighted by what a term so frequent can add at most, bound each document's score from above.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pactloom.llm.common import FILTER_BITS, GOLDEN, bitmap, listed, mix, prepare, stored, table, tidy

TOP = 50
#: Bits of a signature for each (term, level) of its document, rounded up to a power of two; bits that a key sets. A
#: rare term that a document only seems to hold lifts its bound above the limit at once, so that must be rare: with
#: these it is so for one key in 2000 at most.
BITS_PER_KEY = 16
HASHES = 8
#: A signature has 2^21 bits at most, which bounds what a task holds. Longer documents fill it more densely, which
#: loosens their bounds and excludes fewer of them.
MOST_BITS = 1 << 21
#: So many times the wanted documents, those with the highest bounds, are scored first, to find the limit.
FIRST = 4
#: Bits of a block; so many documents share it.
BLOCK_BITS = 1 << 22
#: Items whose terms are held by a task at once, and their terms; more items are searched in further rounds.
ROUND_ITEMS = 2_000
ROUND_TERMS = 200_000
#: Bytes of (document, items) rows that are broadcast to the documents, at most.
BROADCAST_BYTES = 32 << 20
#: Terms whose hashes a task remembers.
REMEMBERED = 300_000
#: Bytes of term bitmaps that are unpacked at once.
UNPACKED = 4_000_000

#: In UTF-8 every byte of a character above 127 is above 127, so bytes can be matched for characters.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def term_counts(raw: bytes) -> Counter:
    """How often each term stands in a text; only A to Z are lowered."""
    return Counter(TERM.findall(raw.lower()))


class _Hashes(dict):
    def __missing__(self, term: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[term] = xxhash.xxh64_intdigest(term)
        return value


def bit_rows(hashes: np.ndarray, level: np.ndarray | int, bits: int) -> np.ndarray:
    """The rows of a signature of ``bits`` bits that stand for (term, level): ``HASHES`` for each."""
    y = mix(hashes + GOLDEN * (np.asarray(level).astype(np.uint64) + np.uint64(1)))
    # Double hashing: steps of an odd width through the signature.
    step = (y >> np.uint64(32)) | np.uint64(1)
    return np.stack([(y + np.uint64(j) * step) & np.uint64(bits - 1) for j in range(HASHES)]).astype(np.int64)


def _length(raw: pa.Scalar) -> bytes:
    return raw.as_buffer().to_pybytes() if raw.is_valid else b""


#: Rows of two kinds: blocks (bits is not null) and, with ``term`` or null, counts of documents and of terms.
SIGNED = "bits binary, rows long, keys binary, n binary, top binary, term binary, n_docs long, n_terms long"


def _sign(held):
    schema = pa.schema(
        [("bits", pa.binary()), ("rows", pa.int64()), ("keys", pa.binary()), ("n", pa.binary()), ("top", pa.binary())]
        + [("term", pa.binary()), ("n_docs", pa.int64()), ("n_terms", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(held.value, np.uint8)).astype(bool)
        known = _Hashes()
        blocks: dict[int, list] = {}
        found: Counter = Counter()
        n_docs = n_terms = 0

        def given(rows: int):
            bits, keys, n, top = blocks.pop(rows)
            arrays = [np.array(x, np.int64).tobytes() for x in (keys, n, top)]
            return pa.RecordBatch.from_pylist([{"bits": bits.tobytes(), "rows": rows, "keys": arrays[0], "n": arrays[1], "top": arrays[2]}], schema)

        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
                counts = term_counts(_length(text))
                if not counts:
                    continue
                often = np.fromiter(counts.values(), np.int64, len(counts))
                hashes = np.fromiter(map(known.__getitem__, counts), np.uint64, len(counts))
                n_docs, n_terms = n_docs + 1, n_terms + int(often.sum())
                hits = np.flatnonzero(wanted[hashes >> np.uint64(64 - FILTER_BITS)])
                if len(hits):
                    terms = list(counts)
                    found.update([terms[i] for i in hits])
                top = int(often.max())
                levels = np.floor(np.log2(often)).astype(np.int64) + 1
                size = int(levels.sum())
                rows = min(MOST_BITS, max(64, 1 << (size * BITS_PER_KEY - 1).bit_length()))
                docs = max(8, min(1024, BLOCK_BITS // rows))
                if rows not in blocks:
                    blocks[rows] = [np.zeros((rows, docs // 8), np.uint8), [], [], []]
                bits, keys, n, tops = blocks[rows]
                source = np.repeat(np.arange(len(hashes)), levels)
                level = np.arange(size) - np.repeat(np.cumsum(levels) - levels, levels)
                at = bit_rows(hashes[source], level, rows).reshape(-1)
                column = len(keys)
                bits[at, column >> 3] |= np.uint8(128 >> (column & 7))
                keys.append(key)
                n.append(int(often.sum()))
                tops.append(top)
                if len(keys) == docs:
                    yield given(rows)
            if len(found) > REMEMBERED:
                yield pa.RecordBatch.from_pylist([{"term": t, "n_docs": c} for t, c in found.items()], schema)
                found = Counter()
        for rows in list(blocks):
            yield given(rows)
        yield pa.RecordBatch.from_pylist([{"term": t, "n_docs": c} for t, c in found.items()] + [{"n_docs": n_docs, "n_terms": n_terms}], schema)

    return run


def signatures(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Blocks of signatures of ``docs (key, text)``, and in how many documents each of ``terms (term, hash)`` occurs.

    Each task deals its documents to blocks by the length of their signatures and cuts a block when it is full; nothing
    is shuffled. Terms outside a bitmap of fixed size over ``terms`` aren't counted.
    """
    prepare(docs.sparkSession)
    slots = terms.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).cast("int").alias("slot"))
    held = docs.sparkSession.sparkContext.broadcast(bitmap(slots))
    out = stored(docs.select("key", "text").mapInArrow(_sign(held), SIGNED), "signatures")
    held.destroy()
    return out


@dataclass
class Questions:
    """Items of one round: their terms (all items' terms once), and for each item which terms with which weight."""

    terms: list[bytes]
    hashes: np.ndarray
    begins: np.ndarray  # where an item's part of the next two begins, and the end
    term: np.ndarray
    weight: np.ndarray
    n_docs: int
    n_terms: int

    def longness(self, n: list[int]) -> np.ndarray:
        return np.array([100 - 50 + (50 * x * self.n_docs) // self.n_terms for x in n], np.int64)

    def bounds(self, bits: np.ndarray, n: np.ndarray, top: np.ndarray) -> np.ndarray:
        """For each item and document of a block what the score can be at most."""
        rows, docs = bits.shape[0], len(n)
        m = self.longness(n.tolist())
        out = np.zeros((len(self.begins) - 1, docs), np.int64)
        live = np.arange(len(self.terms))
        present = np.full((len(live), bits.shape[1]), 255, np.uint8)
        worth, level = np.zeros(docs, np.int64), 0
        while len(live):
            for at in bit_rows(self.hashes[live], level, rows):
                present &= bits[at]
            some = present.any(axis=1)
            live, present = live[some], present[some]
            most = np.minimum((1 << (level + 1)) - 1, top)
            here = (1_000_000_000 * most) // (1000 * most + 20 * m)
            self._add(out, live, present, here - worth)
            worth, level = here, level + 1
            if level > 62 or not (top >= 1 << level).any():
                break
        return out

    def _add(self, out: np.ndarray, live: np.ndarray, present: np.ndarray, worth: np.ndarray) -> None:
        place = np.full(len(self.terms), -1)
        place[live] = np.arange(len(live))
        pairs = np.flatnonzero(place[self.term] >= 0)
        item = np.searchsorted(self.begins, pairs, "right") - 1
        docs = out.shape[1]
        step = max(1, UNPACKED // max(1, docs))
        for at in range(0, len(pairs), step):
            part, owner = pairs[at : at + step], item[at : at + step]
            slices = np.unpackbits(present[place[self.term[part]]], axis=1, count=docs)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sums = np.add.reduceat(slices * self.weight[part][:, None], first, axis=0)
            out[owner[first]] += sums * worth

    def score(self, item: int, counts: Counter, m: int) -> int:
        total = 0
        for j in range(self.begins[item], self.begins[item + 1]):
            tf = counts.get(self.terms[self.term[j]], 0)
            if tf:
                total += int(self.weight[j]) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
        return total


def _blocks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for i in range(len(batch)):
            rows = batch.column("rows")[i].as_py()
            keys, n, top = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("keys", "n", "top"))
            bits = np.frombuffer(batch.column("bits")[i].as_buffer(), np.uint8).reshape(rows, -1)
            yield keys, n, top, bits


BOUNDED = "item int, key long, bound long"


def _bounded(item: np.ndarray, key: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(key, pa.int64()), pa.array(bound, pa.int64())], ["item", "key", "bound"])


def _highest(held, top_k: int):
    """Of each task's documents those with the highest bounds, for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions = held.value
        n_items = len(questions.begins) - 1
        best, names = np.zeros((n_items, 0), np.int64), np.zeros((n_items, 0), np.int64)
        for keys, n, top, bits in _blocks(batches):
            best = np.concatenate([best, questions.bounds(bits, n, top)], axis=1)
            names = np.concatenate([names, np.broadcast_to(keys, (n_items, len(keys)))], axis=1)
            if best.shape[1] > top_k:
                at = np.argpartition(-best, top_k - 1, axis=1)[:, :top_k]
                best, names = np.take_along_axis(best, at, 1), np.take_along_axis(names, at, 1)
        item, column = np.nonzero(best > 0)
        yield _bounded(item, names[item, column], best[item, column])

    return run


def _at_least(held, limits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions, least = held.value, limits.value
        for keys, n, top, bits in _blocks(batches):
            bound = questions.bounds(bits, n, top)
            item, column = np.nonzero(bound >= least[:, None])
            yield _bounded(item, keys[column], bound[item, column])

    return run


def _score(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions = held.value
        for batch in batches:
            out = []
            for doc_id, text, items in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("items").to_pylist(), strict=True):
                counts = term_counts(_length(text))
                m = int(questions.longness([sum(counts.values())])[0])
                out += [(i, doc_id, questions.score(i, counts, m)) for i in items]
            columns = list(zip(*out, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), pa.int64()), strict=True)], ["item", "doc_id", "score"])

    return run


def exact_scores(docs: DataFrame, pairs: DataFrame, held) -> DataFrame:
    """``item, doc_id, score`` for ``pairs (item, key)``; each document is read once for all of its items.

    The items go to the documents where they are few enough to be broadcast, by their count; else both are shuffled,
    the documents after a look into a bitmap of the keys.
    """
    items = stored(pairs.groupBy("key").agg(F.collect_set("item").alias("items")), "candidates")
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("items")).alias("m")).first()
    if 64 * size["n"] + 8 * (size["m"] or 0) <= BROADCAST_BYTES:
        texts = docs.join(F.broadcast(items), "key")
    else:
        texts = listed(docs, items, "key").join(items.hint("merge"), "key")
    texts = texts.select("doc_id", "text", "items")
    return stored(texts.mapInArrow(_score(held), "item int, doc_id long, score long"), "scores").where("score > 0")


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, item_id, text in zip(batch.column("key").to_pylist(), batch.column("item_id").to_pylist(), batch.column("text"), strict=True):
            terms = list(term_counts(_length(text)))
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(terms), pa.int64()), pa.array([item_id] * len(terms), pa.int64()), pa.array(terms, pa.binary()), pa.array(hashes)],
                ["key", "item_id", "term", "hash"],
            )


@tidy
def search(docs: DataFrame, items: DataFrame, top_k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top_k`` documents of the highest score above 0 for each item.

    Blocks of signatures bound every document's score for every item. The documents with the highest bounds, ``FIRST``
    times ``top_k``, are scored exactly; what scores less than the ``top_k``-th best of them can't be among the first, so
    exactly all documents whose bound reaches that score are scored, whatever their number. Equal scores go by doc_id. Items are taken in rounds, so
    that what a task holds of them is bounded; an item with more terms than a round holds has a round with others at
    most as long.

    A null text has no terms. An item without terms, or whose terms no document holds, has no rows. Repeated documents
    are ranked each; without a doc_id they come after those with one. Repeated items are one; items with one id and
    different texts are ranked each. Empty tables give an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    asked = asked.withColumn("key", F.xxhash64("item_id", "text"))
    asked = stored(asked.select("key", "item_id", "text").mapInArrow(_item_terms, "key long, item_id long, term binary, hash long"), "item-terms")
    signed = signatures(docs, asked)
    total = signed.where("bits IS NULL AND term IS NULL").agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n, length = total["n"] or 0, total["l"] or 0
    known = signed.where("term IS NOT NULL").groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1))).cast("long")
    asked = stored(asked.join(known, "term").select("key", "item_id", "term", "hash", weight.alias("w")).where("w > 0"), "weighted-terms")
    sizes = asked.agg(F.count(F.lit(1)).alias("t"), F.count_distinct("key").alias("i")).first()
    rounds = max(1, -(-sizes["t"] // ROUND_TERMS), -(-sizes["i"] // ROUND_ITEMS))
    blocks = signed.where("bits IS NOT NULL").select("bits", "rows", "keys", "n", "top")
    out = None
    for r in range(rounds):
        mine = asked.where(F.pmod("key", F.lit(rounds)) == r).toPandas().sort_values(["item_id", "key", "term"])
        if not len(mine):
            continue
        terms = sorted(set(mine["term"].map(bytes)))
        hash_of = dict(zip(mine["term"].map(bytes), mine["hash"], strict=True))
        number = {t: i for i, t in enumerate(terms)}
        begins = np.flatnonzero(np.append(True, mine["key"].to_numpy()[1:] != mine["key"].to_numpy()[:-1]))
        questions = Questions(
            terms,
            np.array([hash_of[t] for t in terms], np.int64).view(np.uint64),
            np.append(begins, len(mine)),
            mine["term"].map(bytes).map(number).to_numpy(np.int64),
            mine["w"].to_numpy(np.int64),
            n,
            length,
        )
        held = spark.sparkContext.broadcast(questions)
        first = stored(blocks.mapInArrow(_highest(held, FIRST * top_k), BOUNDED), "highest-bounds")
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "key"))
        first = first.withColumn("place", place).where(F.col("place") <= FIRST * top_k)
        scored = exact_scores(docs, first.select("item", "key"), held)
        nth = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
        # A number for each item of the round.
        reached = scored.withColumn("nth", nth).where(F.col("nth") == top_k).select("item", "score").toPandas()
        least = np.ones(len(begins), np.int64)
        least[reached["item"]] = reached["score"]
        limits = spark.sparkContext.broadcast(least)
        rest = blocks.mapInArrow(_at_least(held, limits), BOUNDED)
        scored = exact_scores(docs, rest.select("item", "key"), held)
        by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = scored.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= top_k)
        ids = mine["item_id"].iloc[begins].astype("Int64")
        names = spark.createDataFrame([(i, None if x is None or x != x else int(x)) for i, x in enumerate(ids.astype(object).where(ids.notna(), None))], "item int, item_id long")
        ranked = stored(ranked.join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked")
        held.destroy()
        limits.destroy()
        out = ranked if out is None else out.union(ranked)
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out


def op11_bloom_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce({_LOWER}, ''), '{_PATTERN}') AS t FROM documents),
s AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0),
m AS (SELECT doc_id, r, 100 - 50 + (50 * len(t) * s.n) // s.l AS m FROM d, s WHERE len(t) > 0),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(coalesce({_LOWER}, ''), '{_PATTERN}')) AS term FROM benchmark),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(s.n) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, s GROUP BY term),
x AS (SELECT item_id, doc_id, r, CAST(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * m.m))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN f USING (term) JOIN m USING (r) GROUP BY item_id, doc_id, r),
k AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank
      FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= {TOP}
"""
