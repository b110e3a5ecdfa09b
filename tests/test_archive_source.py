"""Archives through the data source: the rows of ``read_archives``, ranges, and streams that restart."""

import json
import os
import zipfile

import pytest

from engage.sources import archive_source, archives
from engage.streaming import pickup
from tests.conftest import as_set


def write(path, entries, at=None):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in entries.items():
            z.writestr(name, body)
    if at:
        os.utime(path, (at, at))


@pytest.mark.parametrize("size", [archive_source.RANGE_BYTES, 300])
def test_batch_equals_read_archives(spark, tmp_path, size):
    archive_source.register(spark)
    for d in range(3):
        entries = {f"d{d}/{i}.json": json.dumps({"i": i, "x": os.urandom(20).hex()}) for i in range(40)}
        write(tmp_path / f"feed_2024-01-0{d}.zip", entries | {"note.txt": "no", "bad.json": b"\xff\xfe"})
    (tmp_path / "feed_2024-01-07.zip").write_bytes(b"no zip" * 200)
    write(tmp_path / "other.zip", {"a.json": "{}"})
    got = spark.read.format("archives").option("contains", "2024-01").option("rangeBytes", size).load(str(tmp_path))
    want = archives.read_archives(archives.list_archives(spark, str(tmp_path), "2024-01"))
    strip = lambda df: {(r[0].rsplit("/", 1)[1], *r[1:]) for r in as_set(df)}
    assert strip(got) == strip(want) and got.count() == want.count() == 3 * 41 + 1
    assert (got.rdd.getNumPartitions() > 20) == (size == 300)


def test_empty_folder(spark, tmp_path):
    archive_source.register(spark)
    assert spark.read.format("archives").load(str(tmp_path)).isEmpty()


def test_stream_restarts_without_repeats(spark, tmp_path):
    archive_source.register(spark)
    folder, out, ledger = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ledger")
    folder.mkdir()

    def run():
        pickup.run_available(spark.readStream.format("archives").load(str(folder)), pickup.write_batch(out), ledger)
        return sorted(r["entry"] for r in spark.read.parquet(out).collect())

    write(folder / "a.zip", {"1.json": "{}", "2.json": "{}"}, at=1_700_000_000)
    assert run() == ["1.json", "2.json"]
    assert run() == ["1.json", "2.json"]
    write(folder / "b.zip", {"3.json": "{}"}, at=1_700_000_100)
    write(folder / "c.zip", {"4.json": "{}"}, at=1_700_000_100)
    assert run() == ["1.json", "2.json", "3.json", "4.json"]
