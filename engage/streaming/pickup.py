"""Exactly-once pickup of new files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from engage.sources.sinks import path_exists

BATCH = "batch_id"


def run_available(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Process what is there and stop; the checkpoint is the ledger, committed only after ``handle`` returned."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def write_batch(out: str) -> Callable[[DataFrame, int], None]:
    """A handler that writes each batch as its own partition, so that a replayed batch replaces itself."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{BATCH}={batch_id}")

    return handle


def new_files(
    spark: SparkSession, folder: str, schema: str, glob: str = "*", fmt: str = "parquet", max_files: int | None = None
) -> DataFrame:
    """Stream of a folder's files; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def stream_new(
    spark: SparkSession,
    folder: str,
    out: str,
    checkpoint: str,
    schema: str,
    glob: str = "*",
    fmt: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Append the rows of files not seen before to ``out`` and return the whole table.

    A second run without new files adds nothing.
    """
    stream = new_files(spark, folder, schema, glob, fmt)
    run_available(transform(stream) if transform else stream, write_batch(out), checkpoint)
    if not path_exists(spark, out):  # nothing has come yet
        empty = spark.createDataFrame([], schema)
        return transform(empty) if transform else empty
    return spark.read.parquet(out).drop(BATCH)


def new_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of archive paths for ``archives.read_archives`` inside a batch handler; contents are not read."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = new_files(spark, folder, schema, "*.zip", "binaryFile")
    return files.select(F.col("path").alias("archive"), "length")
