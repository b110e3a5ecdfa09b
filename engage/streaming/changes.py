"""A change feed from a stream of documents' chunks, with a hash per chunk kept as state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from engage.operators.rag import embed
from engage.session import materialise
from engage.streaming.index_sync import GONE, read_index
from engage.streaming.pickup import new_files, run_available, write_batch

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# What a document's file rows are: all its chunks of one version, or one row without a chunk when it is gone.
VERSIONED = "chunk_id long, doc_id long, chunk_ix int, chunked_text string, version long"
CHANGES = "chunk_id long, doc_id long, chunk_ix int, chunked_text string, change_type string"
CHANGE = Row(*[c.split()[0] for c in CHANGES.split(", ")])


class _Changes(StatefulProcessor):
    """Per document the ids and hashes of its chunks, and the version they are from."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getValueState("known", "version long, ids binary, hashes binary")

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:
        state = self.known.get()
        version, found = None, {}
        # of several versions in one trigger the last counts, of a chunk twice in it the first
        for row in rows:
            if version is None or row.version > version:
                version, found = row.version, {}
            if row.version == version and not row.gone:
                found.setdefault(row.chunk_id, row)
        if state and version <= state[0]:
            return
        before = dict(zip(np.frombuffer(state[1], "<i8").tolist(), np.frombuffer(state[2], "<i8").tolist())) if state else {}
        ids, hashes = (np.array(values, "<i8") for values in (list(found), [r.hash for r in found.values()]))
        self.known.update((version, ids.tobytes(), hashes.tobytes()))
        for chunk, row in found.items():
            if before.get(chunk) != row.hash:
                yield CHANGE(chunk, key[0], row.chunk_ix, row.chunked_text, "update" if chunk in before else "insert")
        for chunk in sorted(before.keys() - found.keys()):
            yield CHANGE(chunk, key[0], None, None, "delete")

    def close(self) -> None:
        pass


def change_stream(chunks: DataFrame) -> DataFrame:
    """Insert, update and delete rows from a stream of ``VERSIONED`` rows.

    A trigger's rows hold whole documents: all chunks of each document that changed, with its version, or a row without
    chunk_id for a document that is gone; unchanged documents need not come again, so the work follows the changes and
    not the table.  Inserts and updates show the new values, deletes the id alone.  A version already seen, or an older one, gives
    nothing, so a replayed file adds nothing; a document seen twice in a trigger counts in its last version.
    """
    gone = F.col("chunk_id").isNull()
    rows = chunks.select(
        "doc_id",
        F.coalesce("chunk_id", F.lit(0).cast("long")).alias("chunk_id"),
        F.coalesce("chunk_ix", F.lit(0)).alias("chunk_ix"),
        "chunked_text",
        "version",
        gone.alias("gone"),
        F.xxhash64("chunk_ix", "chunked_text").alias("hash"),
    ).where("doc_id is not null and version is not null")
    return rows.groupBy("doc_id").transformWithState(_Changes(), CHANGES, "Update", "None")


def sync_stream(
    spark: SparkSession,
    chunk_folder: str,
    index: str,
    checkpoint: str,
    embedder: PipelineModel | Callable[[pd.Series], list],
) -> DataFrame:
    """Bring the index up to the documents' versions in new files of the folder, and return its current rows.

    Only chunks that are new or changed are embedded.  A trigger's batch replaces itself when it is replayed.
    """
    write = write_batch(index)

    def handle(changes: DataFrame, batch_id: int) -> None:
        # written once: state is read by one pass over a batch
        changes = materialise(changes, "changes")
        kept = embed(changes.where("change_type <> 'delete'"), "chunked_text", embedder).withColumn(GONE, F.lit(False))
        gone = changes.where("change_type = 'delete'").withColumn(GONE, F.lit(True))
        write(kept.drop("change_type").unionByName(gone.drop("change_type"), allowMissingColumns=True), batch_id)

    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        run_available(change_stream(new_files(spark, chunk_folder, VERSIONED, "*.parquet")), handle, checkpoint)
    finally:
        spark.conf.set(STATE_STORE, before)
    return read_index(spark, index)
