"""Suffix-array dedup: bytes of strings that stand more than once are removed.

Anchors bring equal strings together: of the grams in each window the one with the smallest hash is chosen, so any
string of ``width`` bytes contains a chosen gram, the same one at each of its places. Grams that stand once drop out.
Of those left, contexts (all bytes that a string around the gram may touch) that are equal are repeated as a whole;
where contexts of one gram differ, a suffix array over them tells how far they agree.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.llm.common import CHUNK_BYTES, GOLDEN, listed, mix, prepare, stored, table
from pactloom.llm.suffix_array import repeated

WIDTH = 200
#: More differing contexts of one gram than this are told apart by longer grams first.
GROUP = 4096
#: Anchors of one gram that are sorted out at once; what comes out doesn't depend on it.
PIECE_ROWS = 200_000
#: Bytes of contexts that one suffix array is built over.
SHARD_BYTES = 2_000_000


def window_hash(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` values in a row, by hashes of 1, 2, 4 ... values."""
    factor = int(GOLDEN)
    out, done = None, 0
    part, size = values, 1
    while True:
        if width & size:
            if out is None:
                out, done = part, size
            else:
                n = max(0, len(values) - done - size + 1)
                out = out[:n] * np.uint64(pow(factor, size, 1 << 64)) + part[done : done + n]
                done += size
        if 2 * size > width:
            return mix(out)
        n = max(0, len(part) - size)
        part = part[:n] * np.uint64(pow(factor, size, 1 << 64)) + part[size : size + n]
        size *= 2


def anchor_places(raw: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, gram hash and context hash of the chosen grams of a text.

    Grams have ``width // 2`` bytes; a window is all grams of a string of ``width`` bytes, equal hashes go to the
    rightmost. A context that the text's ends cut off has the hash 0: it is like no other. Long texts are taken in
    blocks that overlap by a string.
    """
    gram = width // 2
    windows = width - gram + 1
    n = len(raw)
    if n < width:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    found: list[tuple] = []
    block = max(4 * width, CHUNK_BYTES)
    for at in range(0, n - width + 1, block):
        lo, hi = max(0, at - (width - gram)), min(n, at + block + 2 * width)
        bytes_ = np.frombuffer(raw, np.uint8, hi - lo, lo)
        values = mix(bytes_.astype(np.uint64) + GOLDEN)
        hashes = window_hash(values, gram)
        own = hashes[at - lo : min(len(hashes), at - lo + block + windows - 1)]
        # 40 bits of hash, then the place from the right: the smallest is the rightmost of equals.
        key = (own & ~np.uint64((1 << 24) - 1)) | (np.uint64((1 << 24) - 1) - np.arange(len(own), dtype=np.uint64))
        least, size = key, 1
        while 2 * size <= windows:
            least = np.minimum(least[: len(least) - size], least[size:])
            size *= 2
        rest = windows - size
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        new = np.append(True, least[1:] != least[:-1])
        place = (np.uint64((1 << 24) - 1) - (least[new] & np.uint64((1 << 24) - 1))).astype(np.int64)
        starts = place + at
        context = np.zeros(len(starts), np.uint64)
        whole = (starts - (width - gram) >= 0) & (starts + width <= n)
        if whole.any():
            around = window_hash(values, 2 * width - gram)
            context[whole] = around[starts[whole] - (width - gram) - lo] | np.uint64(1)
        found.append((starts, own[place], context))
    starts, grams, contexts = (np.concatenate(x) for x in zip(*found, strict=True))
    _, first = np.unique(starts, return_index=True)
    return starts[first], grams[first], contexts[first]


def _anchors(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("tid").to_numpy()
            out: list[tuple] = []
            held = 0

            def made():
                tid, at, gram, context = (np.concatenate(x) for x in zip(*out, strict=True))  # noqa: B023
                return pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), pa.array(tid), pa.array(at)],
                    ["gram", "context", "tid", "at"],
                )

            for tid, text in zip(ids, batch.column("text"), strict=True):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                at, gram, context = anchor_places(raw, width)
                out.append((np.full(len(at), tid), at, gram, context))
                held += len(at)
                if held > 100_000:
                    yield made()
                    out, held = [], 0
            if out:
                yield made()

    return run


def _sort_out(piece_rows: int):
    """Rows sorted by (gram, context, tid, at), copies side by side: those whose gram stands elsewhere too.

    ``full`` says that the context stands elsewhere; ``first`` marks one row of each context. Rows at the ends of a
    partition may have their likes in the next one and are given as if they had. Each row is given once: where a gram
    is cut after ``piece_rows`` rows, the last row waits for the next piece, with the one before it to compare with.
    """
    names = ("gram", "context", "tid", "at")

    def same_pairs(rows, k):
        return (rows[:k, 1:] == rows[:k, :-1]).all(axis=0)

    def distinct(rows):
        return rows[:, np.append(True, ~same_pairs(rows, 4))] if rows.shape[1] else rows

    def judged(rows: np.ndarray, open_start: bool, open_end: bool, skip_first: bool = False, skip_last: bool = False) -> pa.RecordBatch:
        n = rows.shape[1]
        gram, context = same_pairs(rows, 1), same_pairs(rows, 2) & (rows[1, 1:] != 0)
        again = np.append(False, gram) | np.append(gram, False)
        full = np.append(False, context) | np.append(context, False)
        first = np.append(True, ~context)
        border = np.zeros(n, bool)
        border[0] = open_start
        border[-1] |= open_end  # a piece of one row may be open on either side
        pick = again | border
        # Groups whose contexts are all alike need no comparison, nor do those whose contexts all stand elsewhere too:
        # such rows are repeated from end to end.
        ids = np.cumsum(np.append(True, ~gram)) - 1
        kinds = np.bincount(ids, first, int(ids[-1]) + 1)[ids]
        edges = np.zeros(int(ids[-1]) + 1, bool)
        edges[ids[border]] = True
        single = np.bincount(ids, ~full, int(ids[-1]) + 1)[ids] > 0
        compare = first & (((kinds > 1) & single) | edges[ids]) & pick
        given = pick & (full | compare)
        given[0] &= not skip_first
        given[-1] &= not skip_last
        use = np.flatnonzero(given)
        arrays = [pa.array(rows[i, use]) for i in (0, 2, 3)] + [pa.array(full[use]), pa.array(compare[use])]
        return pa.RecordBatch.from_arrays(arrays, ["gram", "tid", "at", "full", "compare"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, start, given = np.empty((4, 0), np.int64), True, False
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy() for c in names])
            held = distinct(np.concatenate([held, rows], axis=1))
            if not held.shape[1]:
                continue
            # A gram's rows are judged together, up to a size; a larger group is cut, and the cut is open.
            others = np.flatnonzero(held[0] != held[0, -1])
            last = int(others[-1]) + 1 if len(others) else 0
            if last:
                yield judged(held[:, :last], start, False, given)
                held, start, given = held[:, last:], False, False
            elif held.shape[1] > max(2, piece_rows):
                yield judged(held, True, True, given, True)
                held, start, given = held[:, -2:], True, True
        if held.shape[1]:
            yield judged(held, start, True, given)

    return run


def _cut(width: int):
    """Per record the bytes of its context, and where it begins; records are sorted by text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for i, places in enumerate(batch.column("places")):
                raw = texts[i].as_buffer().to_pybytes()
                rows = places.values.flatten()
                key, at, lo, hi = (x.to_numpy() for x in rows)
                begin, end = np.maximum(at + lo, 0), np.minimum(at + hi + width, len(raw))
                ok = np.flatnonzero(end - begin >= width)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(ok), batch.column("tid")[i].as_py())),
                        *(pa.array(x[ok]) for x in (key, at, lo, hi, begin)),
                        pa.array([raw[b:e] for b, e in zip(begin[ok], end[ok], strict=True)], pa.binary()),
                    ],
                    ["tid", "key", "at", "lo", "hi", "begin", "bytes"],
                )

    return run


CUT = "tid long, key long, at long, lo long, hi long, begin long, bytes binary"


def contexts(texts: DataFrame, records: DataFrame, width: int) -> DataFrame:
    """The bytes around each of ``records (tid, key, at, lo, hi)``: strings that begin from ``at + lo`` to ``at + hi``."""
    places = records.groupBy("tid").agg(F.collect_list(F.struct("key", "at", "lo", "hi")).alias("places"))
    wanted = listed(texts, records, "tid")
    # Copies of a text meet once: each task brings one of them.
    wanted = wanted.groupBy("tid").agg(F.first("text").alias("text"))
    return wanted.join(places, "tid").select("tid", "text", "places").mapInArrow(_cut(width), CUT)


def _halves(width: int):
    """Each record as two, for the first and the second half of its strings, with the longer grams those share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tid, at, lo, hi, begin, raw in zip(*(batch.column(c).to_pylist() for c in ("tid", "at", "lo", "hi", "begin", "bytes")), strict=True):
                mid = (lo + hi) // 2
                for a, b in {(lo, mid), (mid + 1, hi)} if lo < hi else {(lo, hi)}:
                    first, last = at + b - begin, at + a + width - begin
                    if a <= b and first >= 0 and last <= len(raw):
                        key = int.from_bytes(hashlib.blake2b(raw[first:last] + bytes([a % 256, b % 256]), digest_size=8).digest(), "little", signed=True)
                        out.append((tid, key, at, a, b))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["tid", "key", "at", "lo", "hi"])

    return run


def _compare(width: int):
    """Suffix arrays over the contexts of whole grams, sorted by key; gives the spans that stand more than once."""

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        # Contexts of a text that overlap are one segment, so that a string isn't taken for its own copy.
        segments: list[list] = []
        for tid, begin, raw in sorted(rows):
            if segments and segments[-1][0] == tid and begin <= segments[-1][1] + len(segments[-1][2]):
                over = segments[-1][1] + len(segments[-1][2]) - begin
                segments[-1][2] += raw[over:] if over < len(raw) else b""
            else:
                segments.append([tid, begin, bytearray(raw)])
        text = np.frombuffer(b"\0".join(bytes(s[2]) for s in segments) + b"\0", np.uint8).astype(np.int16) + 1
        sizes = np.array([len(s[2]) + 1 for s in segments])
        offsets = np.cumsum(sizes) - sizes
        text[offsets + sizes - 1] = 0
        starts = repeated(text, width)
        if not len(starts):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, ["tid", "begin", "end"])
        owner = np.searchsorted(offsets, starts, "right") - 1
        # Starts at most a string apart are one span.
        cut = np.append(True, (np.diff(starts) > width) | (np.diff(owner) > 0))
        first = np.flatnonzero(cut)
        last = np.append(first[1:], len(starts)) - 1
        shift = np.array([s[1] for s in segments])[owner[first]] - offsets[owner[first]]
        tids = np.array([s[0] for s in segments])[owner[first]]
        return pa.RecordBatch.from_arrays(
            [pa.array(tids), pa.array(starts[first] + shift), pa.array(starts[last] + shift + width)], ["tid", "begin", "end"]
        )

    def alike(group: list[tuple]) -> list[tuple]:
        """Contexts of one gram that can have a string in common with another.

        A string that begins in the first half of a context's places covers the middle of them and all up to the end
        of the gram; one that begins later covers the gram and all up to the middle's end. One of both must stand in
        another context.
        """
        sides: list[tuple] = []
        for _, begin, raw, at, lo, hi in group:
            mid = (lo + hi) // 2
            a, b = at + mid - begin, at + mid + 1 + width - begin
            sides.append((raw[a : at + lo + width - begin] if a >= 0 else None, raw[at + hi - begin : b] if b <= len(raw) else None))
        left, right = (Counter(x) for x in zip(*sides, strict=True))
        return [row[:3] for row, (a, b) in zip(group, sides, strict=True) if (a is not None and left[a] > 1) or (b is not None and right[b] > 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, group, held, key = [], [], 0, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "tid", "begin", "bytes", "at", "lo", "hi"))
            for k, *row in zip(*columns, strict=True):
                if k != key:
                    fit = alike(group) if group else []
                    rows, held, group = rows + fit, held + sum(len(r[2]) for r in fit), []
                    if held >= SHARD_BYTES:
                        yield spans(rows)
                        rows, held = [], 0
                group.append(tuple(row))
                key = k
        rows += alike(group) if group else []
        if rows:
            yield spans(rows)

    return run


SPAN = "tid long, begin long, end long"


def repeated_spans(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """``tid, begin, end``: spans of bytes of ``texts (tid, text)`` that strings of ``width`` bytes cover which also
    start elsewhere, in whatever pieces. Rows with one ``tid`` are one text.
    """
    gram = width // 2
    anchors = stored(texts.mapInArrow(_anchors(width), "gram long, context long, tid long, at long"), "anchors")
    order = ["gram", "context", "tid", "at"]
    dealt = anchors.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stored(dealt.mapInArrow(_sort_out(PIECE_ROWS), "gram long, tid long, at long, full boolean, compare boolean"), "repeated-grams")
    reach = width - gram
    full = kept.where("full").select("tid", (F.col("at") - reach).alias("begin"), (F.col("at") + width).alias("end"))
    records = kept.where("compare").select("tid", F.col("gram").alias("key"), "at", F.lit(-reach).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi"))
    found = [full]
    while True:
        cut = stored(contexts(texts, records, width), "contexts")
        large = stored(cut.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP).select("key"), "large-groups")
        small = cut.join(large, "key", "left_anti").select("key", "tid", "begin", "bytes", "at", "lo", "hi")
        shards = max(1, int((cut.agg(F.sum(F.length("bytes"))).first()[0] or 0) // SHARD_BYTES))
        arrays = small.repartition(shards, "key").sortWithinPartitions("key").mapInArrow(_compare(width), SPAN)
        found.append(stored(arrays, "spans"))
        if large.isEmpty():
            break
        # Strings of a large group share a gram and yet differ: they meet again by longer grams, at last by all bytes.
        halves = stored(cut.join(large, "key", "left_semi").mapInArrow(_halves(width), "tid long, key long, at long, lo long, hi long"), "halves")
        again = halves.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
        halves = stored(halves.join(again, "key", "left_semi"), "halves-again")
        whole = halves.where("lo = hi")
        found.append(whole.select("tid", (F.col("at") + F.col("lo")).alias("begin"), (F.col("at") + F.col("lo") + width).alias("end")))
        records = halves.where("lo < hi").select("tid", "key", "at", "lo", "hi")
    spans = found[0]
    for more in found[1:]:
        spans = spans.union(more)
    return spans


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unites the spans of each text and takes them out."""
    for batch in batches:
        rows = []
        for tid, n, text, begins, ends in zip(
            batch.column("tid").to_pylist(), batch.column("n").to_pylist(), batch.column("text"), batch.column("begins").to_pylist(), batch.column("ends").to_pylist(), strict=True
        ):
            raw = text.as_buffer().to_pybytes()
            if n > 1:  # a text that stands twice is repeated as a whole
                begins, ends = [0], [len(raw)]
            merged: list[list[int]] = []
            for a, b in sorted(zip(begins or [], ends or [], strict=True)):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            digest, at = hashlib.sha256(), 0
            for a, b in merged:
                digest.update(raw[at:a])
                at = b
            digest.update(raw[at:])
            rows.append((tid, sum(b - a for a, b in merged), len(merged), digest.hexdigest(), [x for m in merged for x in m]))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["tid", "n_removed", "n_spans", "kept_sha256", "spans"])


def duplicate_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` for each row of ``docs (doc_id, text)``.

    Texts are UTF-8 bytes. A byte is removed when a string of ``width`` bytes covers it that starts at another place
    too, of the same document or another; strings are those of the input. ``spans`` lists begin and end of the maximal
    removed runs. Texts are told apart by a 64-bit hash; copies of a text are worked on once.

    A null text is empty; texts shorter than ``width`` keep everything. Repeated rows are documents each, so they
    remove each other. Rows without a doc_id are worked on like others. An empty table gives an empty result; other
    columns are not read.
    """
    prepare(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("tid", F.xxhash64("text"))
    texts = rows.select("tid", "text").where(F.octet_length("text") >= width)
    spans = stored(repeated_spans(texts, width), "all-spans")
    copies = rows.where(F.octet_length("text") >= width).groupBy("tid").agg(F.count(F.lit(1)).alias("n"))
    copies = copies.where("n > 1")
    pieces = spans.groupBy("tid").agg(F.collect_set(F.struct("begin", "end")).alias("p"))
    pieces = pieces.join(copies, "tid", "full").select(
        "tid", F.coalesce("n", F.lit(1)).alias("n"), F.transform("p", lambda x: x["begin"]).alias("begins"), F.transform("p", lambda x: x["end"]).alias("ends")
    )
    pieces = stored(pieces, "pieces")
    marked = listed(texts, pieces, "tid").groupBy("tid").agg(F.first("text").alias("text"))
    removed = marked.join(pieces, "tid").select("tid", "n", "text", "begins", "ends").mapInArrow(
        _removed, "tid long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"
    )
    removed = stored(removed, "removed")
    every = rows.select("doc_id", "tid", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("own"))
    return every.join(removed, "tid", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "own").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast("array<long>")).alias("spans"),
    )


def op2_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_spans(table(spark, sf_dir, "documents")).drop("spans")
