"""Zip archives as a Spark data source, for batches and for streams: ``spark.read.format("archives").load(folder)``."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from engage.sources.archives import BATCH_BYTES, ENTRY_SCHEMA, _open, locate

# Packed bytes of an archive that one task reads.
RANGE_BYTES = 16 << 20


@dataclass
class Range(InputPartition):
    """The entries of an archive whose headers lie in [start, end)."""

    archive: str
    start: int
    end: int


def _files(folder: str, contains: str, recursive: bool) -> list[fs.FileInfo]:
    store, inside = locate(folder)
    found = store.get_file_info(fs.FileSelector(inside, recursive=recursive))
    return [f for f in found if f.is_file and f.base_name.endswith(".zip") and contains in f.base_name]


def _ranges(files: list[fs.FileInfo], prefix: str, size: int) -> list[Range]:
    """Ranges of about ``size`` bytes, planned from the listing alone: no archive is opened on the driver."""
    return [
        Range(prefix + f.path, start, min(start + size, f.size)) for f in files for start in range(0, max(f.size, 1), size)
    ]


def _read(part: Range | None, suffix: str) -> Iterator[pa.RecordBatch]:
    if part is None:  # a source without partitions is asked once
        return
    names = ["archive", "entry", "body", "error"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=names)

    rows: list[tuple] = []
    held = 0
    try:
        with _open(part.archive) as archive:
            for entry in archive.infolist():
                if not part.start <= entry.header_offset < part.end or entry.is_dir() or not entry.filename.endswith(suffix):
                    continue
                try:
                    body = archive.read(entry).decode("utf-8")
                    rows.append((part.archive, entry.filename, body, None))
                    held += len(body)
                except Exception as problem:
                    rows.append((part.archive, entry.filename, None, f"{type(problem).__name__}: {problem}"))
                if held >= BATCH_BYTES:
                    yield batch(rows)
                    rows, held = [], 0
    except Exception as problem:
        # one row per archive, from its first range
        if part.start == 0:
            rows.append((part.archive, None, None, f"{type(problem).__name__}: {problem}"))
    if rows:
        yield batch(rows)


class _Options:
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.contains = options.get("contains", "")
        self.suffix = options.get("suffix", ".json")
        self.recursive = str(options.get("recursive", "false")).lower() == "true"
        self.size = int(options.get("rangebytes") or options.get("rangeBytes") or RANGE_BYTES)
        scheme, found, _ = self.folder.partition("://")
        self.prefix = "file:" if self.folder.startswith("file:/") else f"{scheme}://" if found else ""

    def files(self) -> list[fs.FileInfo]:
        return _files(self.folder, self.contains, self.recursive)


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.of = _Options(options)

    def partitions(self) -> list[Range]:
        return _ranges(self.of.files(), self.of.prefix, self.of.size)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _read(partition, self.of.suffix)


class ArchiveStreamReader(DataSourceStreamReader):
    """Offsets are the last archive's modification time and path, so an offset stays small however many archives were read.

    Archives are to arrive complete, by a rename or an upload, and not dated before archives already read.
    """

    def __init__(self, options: dict):
        self.of = _Options(options)

    @staticmethod
    def _place(f: fs.FileInfo) -> tuple[int, str]:
        return f.mtime_ns or 0, f.path

    def initialOffset(self) -> dict:
        return {"mtime": -1, "path": ""}

    def latestOffset(self) -> dict:
        mtime, path = max(map(self._place, self.of.files()), default=(-1, ""))
        return {"mtime": mtime, "path": path}

    def partitions(self, start: dict, end: dict) -> list[Range]:
        low, high = ((o["mtime"], o["path"]) for o in (start, end))
        return _ranges([f for f in self.of.files() if low < self._place(f) <= high], self.of.prefix, self.of.size)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return _read(partition, self.of.suffix)


class ArchiveSource(DataSource):
    """Options: ``contains`` (part of the file name, such as a date), ``suffix`` of entries, ``recursive``, ``rangeBytes``.

    Rows are (archive, entry, body, error); a bad archive or entry is a row with ``error``.
    """

    @classmethod
    def name(cls) -> str:
        return "archives"

    def schema(self) -> str:
        return ENTRY_SCHEMA

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(self.options)

    def streamReader(self, schema: StructType) -> ArchiveStreamReader:
        return ArchiveStreamReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ArchiveSource)
