"""What several operators share: batches as NumPy bytes, the given tables, and the fold rule."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: ASCII white space as the contracts name it, \x20 and \x09-\x0D.
WHITE = b" \t\n\x0b\x0c\r"
HELD_OUT = 2
FOLDS = 4


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept out of every fit: crc32 of the id as text, modulo 4, is 2.  A null id counts as "null"."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % FOLDS == HELD_OUT


def fold_of(doc_id) -> int:
    return zlib.crc32(str("null" if doc_id is None else doc_id).encode()) % FOLDS


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of a documents table, null text as empty; other columns, whatever their names, stay behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def column_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary Arrow column as one byte array and n + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def binary_lists(column) -> list[bytes]:
    """A string or binary Arrow column as bytes objects; nulls are empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def in_parts(batches, rows: int = 256):
    """Arrow batches cut into runs of a few rows, so that what Python makes of whole texts stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
