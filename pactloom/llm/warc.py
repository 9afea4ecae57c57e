"""WARC archives compressed record by record with a Zstandard dictionary that stands at the head of each file."""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.llm.common import prepare, shared_folder, stored, table

#: Payloads of fewer bytes are written in full, however often they occur.
REVISIT_FROM = 1000
#: Records are gathered up to this size to build a file's dictionary from; the rest follows as it comes.
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 1 << 15
#: A file is closed when its records have this many bytes before compression.
ARCHIVE_BYTES = 64 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"

# Magic numbers of the dictionary frame and of a Zstandard frame, profile of a revisit record.
DICTIONARY_MAGIC = 0x184D2A5D
ZSTD_MAGIC = 0xFD2FB528
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def open_folder(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system that a folder names and the path there; a name without a scheme is a mounted folder."""
    if folder.startswith("file:"):
        folder = re.sub("^file:/*", "/", folder)
    return fs.FileSystem.from_uri(folder)


def _record(page_id, url, payload: bytes, size: int, digest: str, keeper) -> bytes:
    """A response with its payload, or where ``keeper`` is given a revisit that refers to that page's response."""
    name = lambda page: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}')}>"
    block = HTTP_HEAD + (payload if keeper is None else b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if keeper is None else 'revisit'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\r\n]+", " ", url))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if keeper is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(keeper)}", f"X-Refers-To-Page-ID: {keeper}"]
    head += [
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on records; where they are too few or too alike to train on, their last bytes serve as they are."""
    if sum(map(len, samples)) >= 8 * DICTIONARY_BYTES and len(samples) >= 8:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, [s[:100_000] for s in samples], k=200, d=8)
        except zstandard.ZstdError:
            pass
    return zstandard.ZstdCompressionDict(b"".join(samples)[-DICTIONARY_BYTES:] or b"WARC/1.1\r\n", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        waiting: list[bytes] = []
        out, packer, path, records, size, packed, held = None, None, "", 0, 0, 0, 0
        made = []

        def start():
            nonlocal out, packer, path, packed, held
            learned = build_dictionary(waiting)
            # A name of its own for each attempt: what a lost one leaves is in no manifest.
            path = f"{root}/{uuid.uuid4().hex}.warc.zst"
            out = system.open_output_stream(path)
            content = learned.as_bytes()
            out.write(struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content)
            packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=learned, write_content_size=True)
            packed = 8 + len(content)
            for record in waiting:
                add(record)
            waiting.clear()
            held = 0

        def add(record):
            nonlocal records, size, packed
            frame = packer.compress(record)
            out.write(frame)
            records, size, packed = records + 1, size + len(record), packed + len(frame)

        def finish():
            nonlocal out, records, size
            if waiting:
                start()
            if out is not None:
                out.close()
                made.append((path.rpartition("/")[2], records, size, packed))
            out, records, size = None, 0, 0

        for batch in batches:
            for row in batch.to_pylist():
                payload = row["html"].encode("utf-8", "surrogatepass")
                record = _record(row["page_id"], row["url"], payload, row["size"], row["digest"], row["keeper"])
                if out is None:
                    waiting.append(record)
                    held += len(record)
                    if held >= SAMPLE_BYTES:
                        start()
                else:
                    add(record)
                    if size >= ARCHIVE_BYTES:
                        finish()
        finish()
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("archive", "records", "bytes", "packed_bytes"), m, strict=True)) for m in made],
            pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("packed_bytes", pa.int64())]),
        )

    return run


def write_archives(pages: DataFrame, folder: str, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Writes ``pages (page_id, url, html)`` to WARC files in ``folder``; gives the manifest.

    One record per row. Of rows with equal payloads of at least ``revisit_from`` bytes the one with the largest
    page_id is written in full, the others as revisits of it, those without a page_id too. A null html is an empty
    payload, a null url leaves the address out; where no row has a page_id all are written in full; repeated rows with the largest page_id are all written in
    full. Each task writes files of its own, each with its own dictionary; memory is bounded by the sample and the
    largest record. An empty table writes nothing. Other columns are not read.

    ``folder`` must be one that all executors share.
    """
    prepare(pages.sparkSession)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    named = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    named = named.withColumn("digest", F.sha1("html")).withColumn("size", F.octet_length("html").cast("long"))
    equal = named.where(F.col("size") >= revisit_from).groupBy("digest", "size").agg(
        F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")
    )
    equal = stored(equal.where("n > 1 AND keeper IS NOT NULL").drop("n"), "equal-payloads")
    marked = named.join(equal, ["digest", "size"], "left")
    keeper = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    marked = marked.select("page_id", "url", F.when(keeper.isNull(), F.col("html")).otherwise("").alias("html"), "size", "digest", keeper.alias("keeper"))
    open_folder(folder)[0].create_dir(open_folder(folder)[1], recursive=True)
    manifest = marked.mapInArrow(_write(folder), "archive string, records long, bytes long, packed_bytes long")
    return stored(manifest, "archives")


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, a frame at a time."""
    head = stream.read(8)
    magic, length = struct.unpack("<II", head)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("the archive doesn't begin with a dictionary frame")
    content = stream.read(length)
    if content[:4] == struct.pack("<I", ZSTD_MAGIC):
        content = zstandard.ZstdDecompressor().decompress(content)
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    data = stream.read(1 << 20)
    while data:
        frame, parts = unpacker.decompressobj(), []
        while not frame.eof:
            if not data:
                raise ValueError("the archive ends inside a record")
            parts.append(frame.decompress(data))
            data = frame.unused_data if frame.eof else stream.read(1 << 20)
        data = data or stream.read(1 << 20)
        record = b"".join(parts)
        top, _, rest = record.partition(b"\r\n\r\n")
        lines = top.decode("utf-8", "surrogatepass").split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        yield headers, rest[: int(headers["Content-Length"])]


READ = "archive string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read(folder: str, texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_folder(folder)
        names = [*(x.split()[0] for x in READ.split(", ")), *["html"] * texts]
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                rows, held = [], 0
                with system.open_input_stream(f"{root}/{archive}") as stream:
                    for headers, block in read_records(stream):
                        payload, kind = block.partition(b"\r\n\r\n")[2], headers["WARC-Type"]
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        whole = kind == "response"
                        if whole and hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"{archive}: payload of page {headers.get('X-Page-ID')} is damaged")
                        number = lambda name: int(headers[name]) if name in headers else None  # noqa: B023, E731
                        row = (archive, number("X-Page-ID"), headers.get("WARC-Target-URI"), len(payload) if whole else number("X-Payload-Length"), digest, kind, number("X-Refers-To-Page-ID"))
                        rows.append((*row, payload.decode("utf-8", "surrogatepass") if whole else None) if texts else row)
                        held += len(payload) * texts
                        if len(rows) >= 1000 or held > 4_000_000:
                            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], schema)

    types = {"string": pa.string(), "long": pa.int64()}
    schema = pa.schema([(a, types[b]) for a, b in (x.split() for x in READ.split(", "))] + [("html", pa.string())] * texts)
    return run


def read_archives(manifest: DataFrame, folder: str, texts: bool = False) -> DataFrame:
    """The records of the archives that ``manifest`` lists; ``texts`` adds the payloads.

    Each file is read as a stream, a record at a time; payloads are held against their digests.
    """
    prepare(manifest.sparkSession)
    # A number of partitions that adaptive execution leaves as it is: the rows are small, the files behind them aren't.
    files = manifest.select("archive").repartition(max(1, manifest.count()))
    return files.mapInArrow(_read(folder, texts), READ + ", html string" * texts)


def op9_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "warc")
    manifest = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(manifest, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP9_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keeper FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {REVISIT_FROM} AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {REVISIT_FROM} AND page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM k
"""
