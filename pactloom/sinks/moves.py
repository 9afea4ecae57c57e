"""Handled files moved to their archive: intents written first, then copies, then deletions, then the ledger's address."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pactloom.session import cut_lineage
from pactloom.sinks.ledger import INGESTION_COLUMNS, append_ledger
from pactloom.sinks.tables import append_table

BLOCK_BYTES = 4 << 20
_RESULT = "ingestion_id string, error string"


def _open(uri: str):
    from pyarrow import fs

    uri = re.sub(r"^s3[an]://", "s3://", uri.replace(" ", "%20") if "://" in uri or uri.startswith("file:") else uri)
    return fs.FileSystem.from_uri(re.sub("^file:/*", "file:///", uri))


def _size(system, path: str) -> int | None:
    info = system.get_file_info(path)
    return info.size if info.is_file else None


def _digest(system, path: str) -> str:
    found = hashlib.sha256()
    with system.open_input_stream(path) as stream:
        while block := stream.read(BLOCK_BYTES):
            found.update(block)
    return found.hexdigest()


def _copy(source: str, root: str, place: str, length: int) -> None:
    """Brings a file to its place, complete or not at all; a file that is there already must be the same."""
    (from_system, path), (system, folder) = _open(source), _open(root)
    target = f"{folder.rstrip('/')}/{place}"
    have, there = _size(from_system, path), _size(system, target)
    if there is not None:
        if have is None and there == length or have == there == length and _digest(from_system, path) == _digest(system, target):
            return
        raise FileExistsError(f"{target} is another file")
    if have is None:
        raise FileNotFoundError(f"{source} is neither there nor at {target}")
    if have != length:
        raise OSError(f"{source} has {have} bytes, its listing says {length}")
    system.create_dir(target.rpartition("/")[0], recursive=True)
    # A name of its own for each attempt, so that two attempts at one file don't write into each other.
    part = f"{target}.{uuid.uuid4().hex}.part"
    with from_system.open_input_stream(path) as read, system.open_output_stream(part) as write:
        while block := read.read(BLOCK_BYTES):
            write.write(block)
    if _size(system, part) != length:
        system.delete_file(part)
        raise OSError(f"the copy of {source} is not complete")
    system.move(part, target)


def _delete(source: str, root: str, place: str, length: int) -> None:
    """Removes a file whose copy is in place."""
    (from_system, path), (system, folder) = _open(source), _open(root)
    if _size(system, f"{folder.rstrip('/')}/{place}") != length:
        raise FileNotFoundError(f"{source} has no complete copy at {place}")
    if _size(from_system, path) is not None:
        from_system.delete_file(path)


def _each(work: Callable[[str, str, str, int], None], root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                try:
                    work(r["path"], root, r["place"], r["length"])
                    rows.append({"ingestion_id": r["ingestion_id"], "error": None})
                except Exception as error:  # noqa: BLE001 - the other files are moved all the same
                    rows.append({"ingestion_id": r["ingestion_id"], "error": f"{type(error).__name__}: {error}"})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("ingestion_id", pa.string()), ("error", pa.string())]))

    return run


def intend(rows: DataFrame, intents: str, batch_id: str) -> None:
    """Writes down which files are to go where, with the ledger rows that will say so.

    ``rows`` are ledger rows with ``path`` (as listed), ``place`` (below the archive's root) and ``length``.
    """
    kept = rows.select(*INGESTION_COLUMNS, "path", "place", "length", F.lit(batch_id).alias("batch_id"))
    append_table(kept, intents, partition_by="batch_id")


def open_intents(spark: SparkSession, intents: str, ledger: str, batch_id: str) -> DataFrame | None:
    """Intents of a batch whose files the ledger doesn't list yet, each once."""
    if not spark.catalog.tableExists(intents):
        return None
    found = spark.table(intents).where(F.col("batch_id") == batch_id).dropDuplicates(["ingestion_id"])
    if spark.catalog.tableExists(ledger):
        found = found.join(spark.table(ledger).select("ingestion_id"), "ingestion_id", "left_anti")
    return cut_lineage(found)


def settle(spark: SparkSession, intents: str, ledger: str, root: str, batch_id: str) -> list[str]:
    """Moves the files of a batch's open intents and lists them in the ledger; gives the errors of those that stay open.

    Copies are made in tasks, a file is removed only once its copy is complete, and the ledger names a file's new address
    only once it is there and the old one is gone. Each step leaves alone what is done, so after a stop anywhere the
    next call goes on. Files that can't be moved stay where they are, and their intents open.
    """
    waiting = open_intents(spark, intents, ledger, batch_id)
    if waiting is None or waiting.isEmpty():
        return []
    errors = []
    for work in (_copy, _delete):
        # Spread over tasks by number, however small the table of intents is.
        spread = waiting.repartition(F.col("ingestion_id")).select("ingestion_id", "path", "place", "length")
        done = cut_lineage(spread.mapInArrow(_each(work, root), _RESULT))
        errors += [r["error"] for r in done.where("error IS NOT NULL").orderBy("error").limit(20).collect()]
        waiting = waiting.join(done.where("error IS NULL").select("ingestion_id"), "ingestion_id", "left_semi")
    append_ledger(waiting.select(*INGESTION_COLUMNS), ledger, batch_id)
    return errors
