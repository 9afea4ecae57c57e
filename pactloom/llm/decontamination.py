"""Benchmark decontamination by template: numbers, names and units become typed slots, windows of templates are joined."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.llm.common import FILTER_BITS, GOLDEN, bitmap, free_prefix, listed, mix, prepare, stored, table, text_chunks, tidy, unlisted, word_characters

#: Words of a window, and how many of them must be plain words for a template to say anything.
WORDS = 8
PLAIN = 5
#: Windows in a row that make a passage (13 words), or this share of an item's windows where it has fewer.
WINDOWS = 6
SHARE = 0.5
#: An item of fewer words is found as a whole text only: so few words in a row stand everywhere.
ANYWHERE = 5

#: Words that are units where they follow a number.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg t ton tons ounce ounces pound pounds lb ml cl l "
    "litre litres liter liters gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks "
    "month months year years percent degree degrees cent cents dollar dollars euro euros usd eur gbp yen mph kmh kb mb gb tb "
    "w kw mw v a hz khz mhz ghz j kj cal kcal k c f"
).split()


@cache
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each code point: its lower-case form, whether it is a capital, a digit, the end of a sentence."""
    every = [chr(i) for i in range(0x110000)]
    lower = np.fromiter((ord(x) if len(x := c.lower()) == 1 else ord(c) for c in every), np.uint32, len(every))
    capital = np.fromiter((c.isupper() for c in every), bool, len(every))
    digit = np.fromiter((c.isdecimal() for c in every), bool, len(every))
    end = np.zeros(len(every), bool)
    end[[ord(c) for c in ".!?:;\n\"'“”„«»|"]] = True
    return lower, capital, digit, end


def _hash_words(points: np.ndarray, starts: np.ndarray, at: np.ndarray, word: np.ndarray) -> np.ndarray:
    offset = at - starts[word]
    powers = np.full(int(offset.max()) + 1, 0x100000001B3, np.uint64)
    powers[0] = 1
    values = mix(points[at].astype(np.uint64) + GOLDEN) * np.cumprod(powers)[offset]
    return mix(np.add.reduceat(values, np.searchsorted(at, starts)))


def template_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word in all texts: its hash (lower case), its kind (0 plain, 1 number, 2 unit, 3 name), its text's number.

    A number is a run of digits; a unit is a word of ``UNITS`` right after a number; a name begins with a capital where
    no sentence begins.
    """
    lower, capital, digit, end = _characters()
    points = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    begins = np.cumsum(sizes) - sizes
    inside, digits = word_characters()[points], digit[points]
    first = inside.copy()
    # A word ends where digits and letters meet, so that "12km" is a number and a unit.
    first[1:] &= ~inside[:-1] | (digits[1:] != digits[:-1])
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero(inside)
    word = np.cumsum(first)[at] - 1
    hashes = _hash_words(lower[points], starts, at, word)
    owner = np.searchsorted(begins, starts, "right") - 1
    kind = np.where(digits[starts], 1, 0)
    sentence = np.cumsum(end[points])[starts]
    opens = np.append(True, (sentence[1:] != sentence[:-1]) | (owner[1:] != owner[:-1]))
    kind[(kind == 0) & capital[points[starts]] & ~opens] = 3
    after_number = np.append(False, (kind[:-1] == 1) & (owner[1:] == owner[:-1]))
    kind[after_number & np.isin(hashes, _units())] = 2
    return hashes, kind, owner


@cache
def _units() -> np.ndarray:
    points = np.frombuffer("\n".join(UNITS).encode("utf-32-le"), np.uint32)
    at = np.flatnonzero(points != 10)
    starts = at[np.append(True, np.diff(at) > 1)]
    return _hash_words(points, starts, at, np.searchsorted(starts, at, "right") - 1)


def windows(texts: list[str], words: int, plain: int, bitmap: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Per window: hash, number of its text, first word, words (hash each), kinds; and the windows of each text.

    Every window stands once with its words as they are and, where it has slots and enough plain words, once with
    slots in their place. With a ``bitmap`` only windows whose hash has its bit there are given.
    """
    hashes, kind, owner = template_words(texts)
    total = max(0, len(hashes) - words + 1)
    if not total:
        none = np.empty(0, np.int64)
        empty = np.empty((0, words), np.int64)
        return none.astype(np.uint64), none, none, empty.astype(np.uint64), empty, np.zeros(len(texts), np.int64)
    slots = np.where(kind > 0, mix(kind.astype(np.uint64) + np.uint64(0x51ED27)), hashes)
    factor = np.uint64(0xD6E8FEB86659FD93)
    literal, templated = np.zeros(total, np.uint64), np.ones(total, np.uint64)
    n_slots = np.zeros(total, np.int64)
    for j in range(words):
        literal = literal * factor + hashes[j : j + total]
        templated = templated * factor + slots[j : j + total]
        n_slots += kind[j : j + total] > 0
    whole = owner[:total] == owner[words - 1 :]
    a = np.flatnonzero(whole)
    b = np.flatnonzero(whole & (n_slots > 0) & (words - n_slots >= plain))
    at = np.concatenate([a, b])
    found = np.concatenate([mix(literal[a]), mix(templated[b])])
    n_windows = np.bincount(owner[a], minlength=len(texts))
    # In a literal window no word is a slot: all words agree.
    literals = np.arange(len(at)) < len(a)
    if bitmap is not None:
        hit = np.flatnonzero(bitmap[found >> np.uint64(64 - FILTER_BITS)])
        at, found, literals = at[hit], found[hit], literals[hit]
    counts = np.bincount(owner, minlength=len(texts))
    first = at - (np.cumsum(counts) - counts)[owner[at]]
    columns = at[:, None] + np.arange(words)
    return found, owner[at], first, hashes[columns], np.where(literals[:, None], 0, kind[columns]), n_windows


def short_windows(texts: list[str], sizes: list[int], bitmap: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, number of the text and first word of the literal windows of ``sizes`` words, for items as short as that.

    Below ``ANYWHERE`` words, and without a ``bitmap`` (for items), only the window of a whole text counts.
    """
    hashes, _, owner = template_words(texts)
    counts = np.bincount(owner, minlength=len(texts))
    begins = np.cumsum(counts) - counts
    factor = np.uint64(0xD6E8FEB86659FD93)
    out = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
    for size in sizes:
        total = max(0, len(hashes) - size + 1)
        if not total:
            continue
        value = np.full(total, np.uint64(0xA5A5A5A5 + size))
        for j in range(size):
            value = value * factor + hashes[j : j + total]
        at = np.flatnonzero(owner[:total] == owner[size - 1 :])
        if bitmap is None or size < ANYWHERE:
            at = at[counts[owner[at]] == size]
        found = mix(value[at])
        if bitmap is not None:
            hit = bitmap[found >> np.uint64(64 - FILTER_BITS)] > 0
            at, found = at[hit], found[hit]
        out.append((found, owner[at], at - begins[owner[at]]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


WINDOWED = "id long, hash long, first long, words array<long>, kinds array<int>, n_windows long"


def _windows(words: int, plain: int, held, sizes: list[int]):
    names = ["id", "hash", "first", "words", "kinds", "n_windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if held is None else np.unpackbits(np.frombuffer(held.value, np.uint8))
        for batch in batches:
            for at, end in text_chunks(batch.column("text"), 1_000_000):
                part = batch.slice(at, end - at)
                texts = [t or "" for t in part.column("text").to_pylist()]
                found, owner, first, own, kinds, n = windows(texts, words, plain, bitmap)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(pa.array(owner)),
                        pa.array(found.view(np.int64)),
                        pa.array(first),
                        pa.array(list(own.view(np.int64)), pa.list_(pa.int64())),
                        pa.array(list(kinds.astype(np.int32)), pa.list_(pa.int32())),
                        pa.array(n[owner]),
                    ],
                    names,
                )
                found, owner, first = short_windows(texts, sizes, bitmap)
                none = [pa.array([[]] * len(found), pa.list_(t)) for t in (pa.int64(), pa.int32())]
                one = pa.array(np.ones(len(found), np.int64))
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(owner)), pa.array(found.view(np.int64)), pa.array(first), *none, one], names)

    return run


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(np.bincount(template_words(texts)[2], minlength=len(texts)))], ["n"])


def _keyed_id() -> Column:
    """A key of each row: rows that agree in doc_id and text are one, and a row without a doc_id has a key as well."""
    doc_id = F.col("doc_id").cast("long")
    return F.xxhash64(doc_id, F.isnull(doc_id), F.col("text").cast("string"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(_keyed_id().alias("id"), F.col("text").cast("string").alias("text"))


def matches(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, plain: int = PLAIN) -> DataFrame:
    """``id, item_id, shift, n_matched, n_literal, n_item, consistent``: windows that a text shares with an item.

    ``docs`` has ``id`` and ``text``. ``shift`` is how far the document's words stand behind the item's, so each row is one
    passage. ``n_literal`` of its windows agree word for word. It is consistent when equal slot fillings of the item have
    equal ones in the document and different ones different ones. An item of fewer than ``words`` words is one window of
    all its words, compared word for word; one of fewer than ``ANYWHERE`` words only with texts of just those words.

    Tasks drop windows whose hash isn't in a bitmap of fixed size; those left are joined by hash. Words of the window
    travel with it, so nothing is read again. Items of one text are one before the join, named by the smallest id.
    """
    prepare(docs.sparkSession)
    items = benchmark.selectExpr("CAST(item_id AS BIGINT) AS id", "CAST(text AS STRING) AS text").where("id IS NOT NULL")
    items = items.groupBy("text").agg(F.min("id").alias("id")).select("id", "text")
    short = items.mapInArrow(_sizes, "n long").where(f"n > 0 AND n < {words}").distinct().toPandas()["n"]
    short = sorted(int(n) for n in short)
    items = stored(items.mapInArrow(_windows(words, plain, None, short), WINDOWED), "item-windows")
    slots = items.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).cast("int").alias("slot"))
    held = docs.sparkSession.sparkContext.broadcast(bitmap(slots))
    rows = docs.select("id", "text").mapInArrow(_windows(words, plain, held, short), WINDOWED)
    mine = rows.select("id", "hash", "first", F.col("words").alias("own"))
    theirs = items.select(F.col("id").alias("item_id"), "hash", F.col("first").alias("at"), "words", "kinds", "n_windows")
    hits = mine.join(theirs, "hash").withColumn("shift", F.col("first") - F.col("at"))
    pairs = F.filter(F.arrays_zip("words", "own", "kinds"), lambda x: x["kinds"] > 0)
    hits = hits.withColumn("slots", F.transform(pairs, lambda x: F.struct(x["words"].alias("item"), x["own"].alias("doc"))))
    # Literal and templated windows of one place count once; a passage has no more windows than its item.
    passage = hits.groupBy("id", "item_id", "shift").agg(
        F.size(F.collect_set("at")).alias("n_matched"),
        F.size(F.collect_set(F.when(~F.exists("kinds", lambda k: k > 0), F.col("at")))).alias("n_literal"),
        F.max("n_windows").alias("n_item"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    of = lambda side: F.size(F.array_distinct(F.transform("slots", lambda x: x[side])))
    consistent = (of("item") == F.size("slots")) & (of("doc") == F.size("slots"))
    return passage.select("id", "item_id", "shift", "n_matched", "n_literal", "n_item", consistent.alias("consistent"))


@tidy
def _found(docs: DataFrame, benchmark: DataFrame, words: int, in_a_row: int, share: float) -> DataFrame:
    """``id, item_id, n_windows, coverage`` of the best passage of each text of ``docs (id, text)`` that holds one."""
    # Slots filled inconsistently take nothing from what stands there word for word.
    found = matches(docs, benchmark, words).withColumn("n_matched", F.when(F.col("consistent"), F.col("n_matched")).otherwise(F.col("n_literal")))
    found = found.where(F.col("n_matched") >= F.least(F.lit(in_a_row), F.greatest(F.lit(1), F.ceil(share * F.col("n_item")))))
    best = F.max(F.struct("n_matched", (F.col("n_matched") / F.col("n_item")).alias("coverage"), (-F.col("item_id")).alias("item")))
    return found.groupBy("id").agg(best.alias("x")).select(
        "id", (-F.col("x.item")).alias("item_id"), F.col("x.n_matched").cast("long").alias("n_windows"), "x.coverage"
    )


@tidy
def judged(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, in_a_row: int = WINDOWS, share: float = SHARE) -> DataFrame:
    """``doc_id, contaminated, item_id, n_windows, coverage`` for each row of ``docs``.

    A passage of an item counts when it has ``in_a_row`` windows of ``words`` words, or ``share`` of its item's windows if
    that is less: as many that agree word for word, whatever the others say, or as many of any kind when it is
    consistent. Items of fewer words are found word for word: of ``ANYWHERE`` words and more wherever they stand, shorter
    ones where they are the whole text.

    Each row is judged by its own text, with or without a doc_id; repeated rows have equal results. Null texts are
    empty, and items without words or without an id can't be found. Items with equal texts tie, and the smallest
    item_id is named. Empty tables give an empty or clean result; other columns are not read.
    """
    keyed = _keyed(docs)
    found = _found(keyed, benchmark, words, in_a_row, share)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _keyed_id().alias("id"))
    out = rows.join(found, "id", "left")
    return out.select(
        "doc_id", F.col("item_id").isNotNull().alias("contaminated"), "item_id",
        F.coalesce("n_windows", F.lit(0)).alias("n_windows"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, item_id, n_windows, coverage`` of the rows of ``judged`` that hold a passage, each once."""
    return judged(docs, benchmark, **options).where("contaminated").drop("contaminated").distinct()


@tidy
def drop_contaminated(docs: DataFrame, benchmark: DataFrame, words: int = WORDS, in_a_row: int = WINDOWS, share: float = SHARE) -> DataFrame:
    """``docs`` without the rows that hold a passage of the benchmark (see ``judged``); columns as they were.

    Rows whose key isn't among the keys that go, by a bitmap, stay without a join.
    """
    gone = _found(_keyed(docs), benchmark, words, in_a_row, share)
    p = free_prefix(docs)
    own, gone = docs.withColumn(f"{p}id", _keyed_id()), gone.select(F.col("id").alias(f"{p}id"))
    doubtful = listed(own, gone, f"{p}id").join(gone, f"{p}id", "left_anti")
    return unlisted(own, gone, f"{p}id").unionByName(doubtful).select(*(F.col(f"`{c}`") for c in docs.columns))


def op7_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
