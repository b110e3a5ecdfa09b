"""Keep a vector index in step with a chunk table."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from engage.operators.merge import change_feed
from engage.operators.rag import embed
from engage.operators.skew import join_lookup
from engage.session import materialise
from engage.sources.sinks import path_exists
from engage.streaming.pickup import BATCH, new_files, run_available, write_batch

GONE = "is_deleted"
# Changed ids that are sent to every task, so that the texts stay where they are.
MOST_SENT = 1_000_000
CHUNK_SCHEMA = "chunk_id long, doc_id long, chunk_ix int, chunked_text string"


def sync_index(
    spark: SparkSession,
    chunk_folder: str,
    index: str,
    checkpoint: str,
    embedder: PipelineModel | Callable[[pd.Series], list],
    schema: str = CHUNK_SCHEMA,
) -> DataFrame:
    """Embed the chunks of files not seen before, add them to the index and return its current rows.

    Each trigger writes only its own chunks; a chunk id met again replaces the older row when read.
    """
    write = write_batch(index)

    def handle(batch: DataFrame, batch_id: int) -> None:
        write(embed(batch, "chunked_text", embedder), batch_id)

    run_available(new_files(spark, chunk_folder, schema, "*.parquet"), handle, checkpoint)
    return read_index(spark, index)


def sync_changes(
    spark: SparkSession,
    before: DataFrame | None,
    after: DataFrame,
    index: str,
    batch_id: int,
    embedder: PipelineModel | Callable[[pd.Series], list],
) -> DataFrame:
    """Bring the index from one snapshot of the chunk table to the next and return its current rows.

    Only chunks that are new or changed are embedded; chunks that are gone leave a tombstone without text.  ``batch_id``
    numbers the snapshot: a rerun replaces its own batch.  Snapshots meet by ids and 128-bit hashes of the text; a text is
    read again only where it is new, and of a first snapshot that is all of them.
    """
    if before is None:
        write_batch(index)(embed(after, "chunked_text", embedder).withColumn(GONE, F.lit(False)), batch_id)
        return read_index(spark, index)
    text = F.col("chunked_text")
    hashes = [F.xxhash64(text).alias("_h"), F.xxhash64(F.lit(1), text).alias("_i"), text.isNull().alias("_n")]
    old, new = (d.select(*[c for c in after.columns if c != "chunked_text"], *hashes) for d in (before, after))
    changes = materialise(change_feed(old, new, "chunk_id").drop("_h", "_i", "_n"), "changes")
    fresh = changes.where("change_type <> 'delete'").select("chunk_id")
    # a row without an id is new in every snapshot
    rows = join_lookup(after, fresh, "chunk_id", "left_semi", MOST_SENT).unionByName(after.where("chunk_id is null"))
    kept = embed(rows, "chunked_text", embedder).withColumn(GONE, F.lit(False))
    gone = changes.where("change_type = 'delete'").withColumn(GONE, F.lit(True))
    write_batch(index)(kept.unionByName(gone.drop("change_type"), allowMissingColumns=True), batch_id)
    return read_index(spark, index)


def read_index(spark: SparkSession, index: str, schema: str = CHUNK_SCHEMA + ", embedding array<double>") -> DataFrame:
    """Latest row per chunk id, without tombstones.  Spark keeps one row per id and partition before the shuffle.

    Of a chunk id twice in one batch the text with the smaller hash counts.  An index not yet written is empty.
    """
    if not path_exists(spark, index):
        return spark.createDataFrame([], schema)
    stored = spark.read.option("mergeSchema", "true").parquet(index)
    latest = Window.partitionBy("chunk_id").orderBy(F.desc(BATCH), F.xxhash64("chunked_text"))
    rows = stored.withColumn("_rn", F.row_number().over(latest)).where("_rn = 1")
    if GONE in stored.columns:
        rows = rows.where(~F.coalesce(F.col(GONE), F.lit(False)))
    return rows.drop("_rn", BATCH, GONE)


def compact(spark: SparkSession, index: str, out: str) -> None:
    """Write the current rows as a fresh index of one batch; switch readers to ``out`` afterwards."""
    read_index(spark, index).write.mode("overwrite").parquet(f"{out}/{BATCH}=-1")
