"""What the operators of this package share: tables, stored steps, and word hashes over Arrow batches."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.session import scratch_root

#: Rows of one Arrow batch; texts may be long, so few rows make a batch.
BATCH_ROWS = 256
#: Bytes of text that are turned into arrays at once inside a task.
CHUNK_BYTES = 2_000_000

#: Bits of a bitmap's address where its size doesn't follow the keys (2 MB).
FILTER_BITS = 24

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, so that a Python worker's memory stays bounded whatever the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that the cluster shares (``spark.checkpoint.dir``)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


#: Folders of tables written inside each ``tidy`` function that is running.
_written: list[list[str]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: computed once, and a lost executor doesn't replay what lies before it."""
    path = shared_folder(df.sparkSession, name)
    if _written:
        _written[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def written() -> Iterator[list[str]]:
    """The folders of the tables that are written inside, for ``remove``."""
    _written.append([])
    try:
        yield _written[-1]
    finally:
        _written.pop()


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tidy(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A step whose result is written; the tables that it wrote on the way are removed, and Spark may drop its shuffles."""

    @wraps(step)
    def run(*args, **options) -> DataFrame:
        spark, out = SparkSession.active(), None
        _written.append([])
        try:
            out = stored(step(*args, **options), step.__name__)
        finally:
            made = _written.pop()
            for folder in made[:-1] if out is not None else made:
                remove(spark, folder)
            if out is not None and _written:
                _written[-1].append(made[-1])
        # Shuffle files go once nobody holds the frames that made them; the driver's JVM would find that out much later.
        gc.collect()
        spark._jvm.System.gc()
        return out

    return run


def free_prefix(*frames: DataFrame) -> str:
    """What no column of ``frames`` begins with, for columns of one's own beside theirs."""
    names = [c.lower() for df in frames for c in df.columns]
    prefix = "_"
    while any(n.startswith(prefix) for n in names):
        prefix += "_"
    return prefix


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each bit of the result depends on every bit of ``x``."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53


def text_chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Bounds of runs of rows that hold about ``limit`` bytes; a longer text is a run of its own."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, before + limit, "right")))
        yield at, end
        at = end


@cache
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@cache
def word_characters() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts as one array of code points, a line break between them, and where each starts."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(t) + 1 for t in low), np.int64, len(low))
    return points, np.cumsum(sizes) - sizes


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word (a run of letters or digits, lower case) and the number of its text."""
    points, begins = code_points(texts)
    inside = word_characters()[points]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(inside)
    word = np.cumsum(first)[at] - 1
    offset = at - starts[word]
    powers = np.full(int(offset.max()) + 1, 0x100000001B3, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    values = mix(points[at].astype(np.uint64) + GOLDEN) * powers[offset]
    sums = np.add.reduceat(values, np.searchsorted(at, starts))
    return mix(sums), np.searchsorted(begins, starts, "right") - 1


def window_hashes(words: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each ``width`` words in a row, and the number of its text.

    A text of fewer words has one window of all its words; a text without words has none.
    """
    if not len(words):
        return words, owner
    counts = np.bincount(owner)
    total = max(0, len(words) - width + 1)
    full = np.zeros(total, np.uint64)
    factor = np.uint64(0xD6E8FEB86659FD93)
    for j in range(width):
        full = full * factor + words[j : j + total]
    ok = owner[:total] == owner[width - 1 :] if total else np.empty(0, bool)
    hashes, owners = [full[ok]], [owner[:total][ok]]
    begins = np.cumsum(counts) - counts
    for t in np.flatnonzero((counts > 0) & (counts < width)):
        value = np.uint64(counts[t])
        with np.errstate(over="ignore"):
            for w in words[begins[t] : begins[t] + counts[t]]:
                value = value * factor + w
        hashes.append(np.array([value], np.uint64))
        owners.append(np.array([t], owner.dtype))
    return mix(np.concatenate(hashes)), np.concatenate(owners)


def _slot(key: str, bits: int = FILTER_BITS):
    return F.shiftrightunsigned(F.xxhash64(key), 64 - bits).cast("int")


def bitmap(slots: DataFrame, bits: int = FILTER_BITS) -> bytes:
    """``2^bits`` bits, those of ``slots (slot)`` set. Words of 64 slots are made in Spark; no more come to the driver."""
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(slot & 63 AS INT)))").alias("mask")
    )
    found = words.toPandas()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["word"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).view(np.uint64)
    return np.packbits(np.unpackbits(out.view(np.uint8), bitorder="little")).tobytes()


def filter_bits(n_keys: int) -> int:
    """Bits of a filter's address for so many keys: 16 bits a key, from 2^16 to 2^26 in all (a million words of 64)."""
    return min(26, max(16, (16 * max(1, n_keys) - 1).bit_length()))


def _held_against(rows: DataFrame, keys: DataFrame, key: str, keep: bool) -> DataFrame:
    bits, p = filter_bits(keys.count()), free_prefix(rows)
    slots = keys.select(_slot(key, bits).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias(f"{p}word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(slot & 63 AS INT)))").alias(f"{p}mask")
    )
    held = rows.withColumn(f"{p}slot", _slot(key, bits))
    held = held.join(F.broadcast(words), F.shiftright(f"{p}slot", 6) == F.col(f"{p}word"), "inner" if keep else "left")
    found = F.expr(f"coalesce(shiftright({p}mask, {p}slot & 63) & 1L, 0L) = 1L")
    return held.where(found if keep else ~found).select(*(F.col(f"`{c}`") for c in rows.columns))


def listed(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` isn't in ``keys``: what a join with ``keys`` needs, before its shuffle.

    A hash of the key is looked up in a bitmap of 16 bits for each key, that is broadcast as at most 2^20 words. Beyond
    some 10^7 keys ever more bits are set and more rows stay; the join that follows decides in any case.
    """
    return _held_against(rows, keys, key, True)


def unlisted(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows that ``listed`` leaves out: their ``key`` isn't in ``keys``, so no join has to say so."""
    return _held_against(rows, keys, key, False)
