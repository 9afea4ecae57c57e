"""Landed files: listing, column names, and rows as text."""

from __future__ import annotations

import csv
import io
import json
import re
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactloom.operators.routing import DEFAULT_DELIMITER, DEFAULT_QUOTE, DEFAULT_SKIP_ROWS

SOURCE_FILE = "_source_file"
CORRUPT = "_corrupt_record"
LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"

# How many records of a file are looked at for names and samples.
SAMPLE_ROWS = 50
PARQUET_SAMPLE_ROWS = 5

_HEAD_BYTES = 1 << 16
_HEADER_SCHEMA = (
    "path string, headers array<string>, types array<string>, samples array<map<string,string>>, header_error string"
)


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file under ``root`` by its path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(*file_columns(root))


def file_columns(root: str) -> list[Column]:
    path = F.col("_metadata.file_path")
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    root_path = root.split(":", 1)[-1].strip("/") + "/"
    return [
        path.alias("path"),
        F.substr(plain, F.locate(root_path, plain) + len(root_path)).alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("modified_at"),
    ]


def readable(paths: Iterable[str]) -> list[str]:
    """Paths as readers take them, from paths as the ``_metadata`` column gives them: decoded, globs escaped."""
    return [re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(p)) for p in paths]


def scan_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str],
    *,
    delimiter: str | None = None,
    quote: str | None = None,
    skip_rows: int | None = None,
    fail_fast: bool = True,
) -> DataFrame:
    """CSV rows as text columns, by position.

    A row with too few or too many fields fails the read, or, without
    ``fail_fast``, is kept with its line in ``_corrupt_record``.
    """
    skip = DEFAULT_SKIP_ROWS if skip_rows is None else skip_rows
    schema = text_schema(columns)
    options = {
        "sep": delimiter or DEFAULT_DELIMITER,
        "quote": quote or DEFAULT_QUOTE,
        "escape": quote or DEFAULT_QUOTE,
        # An empty field is NULL, a quoted empty field is an empty text.
        "nullValue": "\0",
        "mode": "FAILFAST" if fail_fast else "PERMISSIVE",
    }
    if not fail_fast:
        schema = schema.add(CORRUPT, T.StringType())
        options["columnNameOfCorruptRecord"] = CORRUPT
    paths = [paths] if isinstance(paths, str) else list(paths)
    if skip <= 1:
        reader = spark.read.schema(schema).options(**options).option("columnPruning", "false")
        rows = reader.option("header", str(skip == 1).lower()).csv(paths)
        return rows.select(*schema.names, F.col("_metadata.file_path").alias(SOURCE_FILE))
    lines = _after_preamble(spark.read.text(paths), skip)
    parsed = F.from_csv("value", _ddl(schema), options)
    return lines.select(parsed.alias("r"), SOURCE_FILE).select("r.*", SOURCE_FILE)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _after_preamble(lines: DataFrame, skip: int) -> DataFrame:
    """Lines of each file without its first ``skip``.

    Line ids ascend within a split, so the first split of a file yields its
    first id by a partial aggregate; no file is sorted or gathered.
    """
    numbered = lines.select(
        "value",
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_line"),
    )
    first = numbered.where("_start = 0").groupBy(SOURCE_FILE).agg(F.min("_line").alias("_first"))
    joined = numbered.join(first, SOURCE_FILE, "left")
    body = (F.col("_start") > 0) | (F.col("_line") >= F.col("_first") + skip)
    return joined.where(body & (F.col("value") != "")).select("value", SOURCE_FILE)


def scan_ndjson(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], *, fail_fast: bool = True
) -> DataFrame:
    """JSON lines as text columns; other fields are ignored, nested values stay JSON text."""
    schema = text_schema(columns)
    reader = spark.read.option("mode", "FAILFAST" if fail_fast else "PERMISSIVE")
    if not fail_fast:
        schema = schema.add(CORRUPT, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.schema(schema).json([paths] if isinstance(paths, str) else list(paths))
    return rows.select(*schema.names, F.col("_metadata.file_path").alias(SOURCE_FILE))


def scan_parquet(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None, *, as_text: bool = True
) -> DataFrame:
    rows = spark.read.parquet(*([paths] if isinstance(paths, str) else list(paths)))
    names = list(columns or rows.columns)
    source = F.col("_metadata.file_path").alias(SOURCE_FILE)
    if not as_text:
        return rows.select(*[f"`{c}`" for c in names], source)
    return rows.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names], source)


def ndjson_columns(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Every key of every record, per file; counting starts before the shuffle."""
    keys = spark.read.text(readable(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.explode(F.json_object_keys("value")).alias("key")
    )
    return keys.distinct().groupBy("path").agg(F.sort_array(F.collect_list("key")).alias("headers"))


def _distinct_names(names: list[str]) -> list[str]:
    """Repeated names get a number, so that a doubled column shows up as unknown."""
    seen: dict[str, int] = {}
    result = []
    for i, name in enumerate(names):
        name = name or f"Unnamed: {i}"
        count = seen.get(name, 0)
        seen[name] = count + 1
        result.append(f"{name}.{count}" if count else name)
    return result


def _csv_head(text: str, delimiter: str, quote: str, skip_rows: int):
    lines = text.splitlines()[max(0, skip_rows - 1) :]
    lines = [line for line in lines if line.strip()]
    rows = list(csv.reader(io.StringIO("\n".join(lines)), delimiter=delimiter, quotechar=quote))
    if not rows:
        raise ValueError("No columns to parse from file")
    names = _distinct_names(rows[0])
    return names, [dict(zip(names, (v or None for v in r))) for r in rows[1 : SAMPLE_ROWS + 1]]


def _json_head(text: str):
    rows = [json.loads(line) for line in text.splitlines()[:SAMPLE_ROWS] if line.strip()]
    names = list(dict.fromkeys(k for r in rows for k in r))
    as_text = [{k: v if isinstance(v, str) or v is None else json.dumps(v) for k, v in r.items()} for r in rows]
    return names, as_text


def _read_head(path: str, fmt: str, delimiter: str, quote: str, skip_rows: int) -> dict:
    """Names, types and sample rows from the first bytes (or the footer) of one file."""
    from pyarrow import fs
    from pyarrow import parquet as pq

    uri = re.sub(r"^s3[an]://", "s3://", path.replace(" ", "%20"))
    filesystem, inner = fs.FileSystem.from_uri(uri)
    if fmt == "parquet":
        with filesystem.open_input_file(inner) as source:
            file = pq.ParquetFile(source)
            fields = file.schema_arrow
            batch = next(file.iter_batches(batch_size=PARQUET_SAMPLE_ROWS), None)
            rows = batch.to_pylist() if batch is not None else []
        samples = [{k: None if v is None else str(v) for k, v in r.items()} for r in rows]
        return {"headers": fields.names, "types": [str(f.type) for f in fields], "samples": samples}
    if fmt not in ("csv", "json", "ndjson"):
        raise ValueError(f"Unsupported file format: {fmt}")
    wanted = SAMPLE_ROWS + skip_rows + 1
    with filesystem.open_input_stream(inner) as source:
        data = source.read(_HEAD_BYTES)
        while data.count(b"\n") < wanted and (more := source.read(_HEAD_BYTES)):
            data += more
        complete = not source.read(1)
    if not complete and b"\n" in data:
        data = data[: data.rindex(b"\n")]
    text = data.decode("utf-8-sig", errors="replace")
    names, samples = _csv_head(text, delimiter, quote, skip_rows) if fmt == "csv" else _json_head(text)
    return {"headers": names, "types": ["string"] * len(names), "samples": samples}


def _read_heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    text, names = pa.string(), pa.list_(pa.string())
    schema = pa.schema(
        [
            ("path", text),
            ("headers", names),
            ("types", names),
            ("samples", pa.list_(pa.map_(text, text))),
            ("header_error", text),
        ]
    )
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            row = {"path": r["path"]}
            try:
                row |= _read_head(r["path"], r["file_format"], r["delimiter"], r["quote_char"], r["skip_header_rows"])
                row["samples"] = [list(sample.items()) for sample in row["samples"]]
            except Exception as error:  # noqa: BLE001 - one bad file must not stop the others
                row["header_error"] = f"Failed to read metadata from {r['path'].rsplit('/', 1)[-1]}: {error}"
            rows.append(row)
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_headers(files: DataFrame) -> DataFrame:
    """Column names and sample rows of each file, read inside tasks.

    ``files`` is (path, file_format, delimiter, quote_char, skip_header_rows).
    The work is one small read per file, not a pass over the data.
    """
    wanted = files.select("path", "file_format", "delimiter", "quote_char", "skip_header_rows")
    spread = wanted.repartition(F.col("path"))
    return spread.mapInArrow(_read_heads, _HEADER_SCHEMA)


def sample_rows(df: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows as text; which rows these are depends on the storage order."""
    blank = lambda c: F.when(F.lower(c) != "nan", c)
    return df.limit(rows).select(*[blank(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])
