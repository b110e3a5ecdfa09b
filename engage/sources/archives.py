"""Zip archives of JSON documents, read by byte range so that a huge archive is many tasks."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

BLOCK_BYTES = 64 * 1024 * 1024
BATCH_BYTES = 8 * 1024 * 1024

ENTRY_SCHEMA = "archive string, entry string, body string, error string"


class _Seekable:
    """A store's file whose impossible seeks raise OSError, which zipfile looks for."""

    def __init__(self, handle):
        self.handle = handle

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            return self.handle.seek(offset, whence)
        except ValueError as error:
            raise OSError(str(error)) from error

    def __getattr__(self, name: str):
        return getattr(self.handle, name)


def locate(path: str) -> tuple[fs.FileSystem, str]:
    """The store and the path inside it; Spark writes local paths as ``file:/...``."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


@contextmanager
def _open(path: str) -> Iterator[zipfile.ZipFile]:
    """A zip on any store pyarrow reads, opened at random access."""
    store, inside = locate(path)
    with store.open_input_file(inside) as handle, zipfile.ZipFile(_Seekable(handle)) as archive:
        yield archive


def list_archives(spark: SparkSession, folder: str, name_contains: str = "", recursive: bool = False) -> DataFrame:
    """Archives of a folder, (archive, length), optionally those whose file name holds a text such as a date."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
    files = files.option("recursiveFileLookup", str(recursive).lower())
    name = F.element_at(F.split("path", "/"), -1)
    return files.load(folder).where(F.contains(name, F.lit(name_contains))).select(
        F.col("path").alias("archive"), "length"
    )


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cut every archive's entry list into runs of about BLOCK_BYTES unpacked."""
    for batch in batches:
        for path in batch["archive"]:
            rows = []
            try:
                with _open(path) as archive:
                    start = size = 0
                    entries = archive.infolist()
                    for i, entry in enumerate(entries):
                        size += entry.file_size
                        if size >= BLOCK_BYTES or i == len(entries) - 1:
                            rows.append((path, start, i + 1, None))
                            start, size = i + 1, 0
            except Exception as error:
                rows = [(path, 0, 0, f"{type(error).__name__}: {error}")]
            if rows:
                yield pd.DataFrame(rows, columns=["archive", "first", "last", "error"])


def _entries(suffix: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["archive", "entry", "body", "error"]
        for batch in batches:
            for path, first, last, error in zip(batch["archive"], batch["first"], batch["last"], batch["error"]):
                if error is not None:
                    yield pd.DataFrame([(path, None, None, error)], columns=columns)
                    continue
                with _open(path) as archive:
                    rows, held = [], 0
                    for entry in archive.infolist()[first:last]:
                        if entry.is_dir() or not entry.filename.endswith(suffix):
                            continue
                        try:
                            body = archive.read(entry).decode("utf-8")
                            rows.append((path, entry.filename, body, None))
                            held += len(body)
                        except Exception as problem:
                            rows.append((path, entry.filename, None, f"{type(problem).__name__}: {problem}"))
                        if held >= BATCH_BYTES:
                            yield pd.DataFrame(rows, columns=columns)
                            rows, held = [], 0
                    if rows:
                        yield pd.DataFrame(rows, columns=columns)

    return run


def read_archives(archives: DataFrame, suffix: str = ".json", tasks: int | None = None) -> DataFrame:
    """Every entry of every archive, (archive, entry, body, error); a bad archive or entry is a row with ``error``.

    ``archives`` has an ``archive`` path column.  Only entry lists are read first; runs of entries are then
    spread over the tasks, each of which reads its own bytes.
    """
    tasks = tasks or archives.sparkSession.sparkContext.defaultParallelism
    runs = archives.select("archive").mapInPandas(_blocks, "archive string, first long, last long, error string")
    return runs.repartition(tasks, "archive", "first").mapInPandas(_entries(suffix), ENTRY_SCHEMA)
