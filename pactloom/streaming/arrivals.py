"""Files as they land, ingested one micro-batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pactloom.plans.ingest import IngestTargets, ingest
from pactloom.sources.files import LISTING_SCHEMA, file_columns


def file_arrivals(
    spark: SparkSession, root: str, *, files_per_batch: int = 1000, archive_to: str | None = None
) -> DataFrame:
    """A stream with one row per new file; contents are not read.

    ``archive_to`` lets the source move files once their batch is done.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive_to:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_to)
    return reader.load(root).select(*file_columns(root))


def ingest_arrivals(
    arrivals: DataFrame,
    registry_table: str,
    targets: IngestTargets,
    checkpoint: str,
    *,
    as_of: str | None = None,
    continuous: bool = False,
) -> StreamingQuery:
    """Runs ``ingest`` on every micro-batch.

    The batch is named after the checkpoint and its number, so a batch replayed
    after a crash does not load files that it already recorded.
    """

    def load(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        registry = spark.table(registry_table)
        ingest(
            spark,
            batch,
            registry,
            targets,
            as_of=as_of,
            batch_id=f"{checkpoint}#{number}",
        )

    writer = arrivals.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime="1 minute") if continuous else writer.trigger(availableNow=True)
    return writer.start()
