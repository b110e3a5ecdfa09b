"""Archives, documents and the incremental jobs on small files."""

import json
import zipfile

from engage.operators import rag
from engage.sources import archives, documents
from engage.streaming import index_sync, pickup
from tests.conftest import as_set


def make_zip(path, entries):
    with zipfile.ZipFile(path, "w") as z:
        for name, body in entries.items():
            z.writestr(name, body)


def test_archives_with_a_bad_one(spark, tmp_path):
    make_zip(tmp_path / "feed_2024-01-01.zip", {"a.json": '{"x": 1}', "sub/b.json": "{}", "c.txt": "no"})
    make_zip(tmp_path / "feed_2024-01-02.zip", {"d.json": "{}"})
    make_zip(tmp_path / "feed_2024-01-01_empty.zip", {})
    (tmp_path / "feed_2024-01-01_bad.zip").write_bytes(b"not a zip")
    (tmp_path / "notes.txt").write_text("x")
    listed = archives.list_archives(spark, str(tmp_path), "2024-01-01")
    assert listed.count() == 3
    rows = archives.read_archives(listed).collect()
    good = {(r["archive"].rsplit("/", 1)[1], r["entry"], r["body"]) for r in rows if r["error"] is None}
    assert good == {("feed_2024-01-01.zip", "a.json", '{"x": 1}'), ("feed_2024-01-01.zip", "sub/b.json", "{}")}
    bad = [r for r in rows if r["error"] is not None]
    assert len(bad) == 1 and bad[0]["archive"].endswith("_bad.zip") and "BadZipFile" in bad[0]["error"]


def test_archive_is_cut_into_blocks(tmp_path):
    import pandas as pd

    path = str(tmp_path / "big.zip")
    make_zip(path, {f"{i}.json": "x" * 1000 for i in range(100)})
    old, archives.BLOCK_BYTES = archives.BLOCK_BYTES, 10_000
    try:
        blocks = pd.concat(archives._blocks(iter([pd.DataFrame({"archive": [path]})])))
        read = pd.concat(archives._entries(".json")(iter([blocks])))
    finally:
        archives.BLOCK_BYTES = old
    assert len(blocks) == 10 and blocks["last"].max() == 100
    assert len(read) == 100 and read["entry"].nunique() == 100


def test_documents(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    good = {"language": "es", "channels": [{"n": 1}], "metadata": {"CD10": 7, "Direction": "1", "o": None}}
    (tmp_path / "a.json").write_text(json.dumps(good, indent=1))
    (tmp_path / "b.json").write_text("{broken")
    (tmp_path / "deep" / "c.json").write_text("{}")
    flat = documents.read_documents(spark, str(tmp_path))
    row = documents.readable(flat).first()
    assert (row["language"], row["metadata"]["CD10"], row["metadata"]["o"]) == ("es", "7", None)
    assert json.loads(row["channels"]) == [{"n": 1}]
    assert [r["path"].rsplit("/", 1)[1] for r in documents.unreadable(flat).collect()] == ["b.json"]
    assert documents.read_documents(spark, str(tmp_path), recursive=True).count() == 3
    work = documents.work_list(spark, str(tmp_path), "2024-01-01")
    assert as_set(work.select("transcript_name", "start_date", "retry_count")) == {
        (n, "2024-01-01", 1) for n in ("a.json", "b.json", "c.json")
    }


def test_stream_picks_up_only_new_files(spark, tmp_path):
    source, out, ledger = (str(tmp_path / n) for n in ("in", "out", "ledger"))
    spark.createDataFrame([(1,), (2,)], "id long").coalesce(1).write.parquet(source)
    assert pickup.stream_new(spark, source, out, ledger, "id long").count() == 2
    assert pickup.stream_new(spark, source, out, ledger, "id long").count() == 2
    spark.createDataFrame([(3,)], "id long").coalesce(1).write.mode("append").parquet(source)
    assert as_set(pickup.stream_new(spark, source, out, ledger, "id long")) == {(1,), (2,), (3,)}


def test_failed_batch_is_taken_again(spark, tmp_path):
    source, out, ledger = (str(tmp_path / n) for n in ("in", "out", "ledger"))
    spark.createDataFrame([(1,)], "id long").coalesce(1).write.parquet(source)

    def broken(batch, batch_id):
        raise RuntimeError("disk full")

    try:
        pickup.run_available(pickup.new_files(spark, source, "id long"), broken, ledger)
        raise AssertionError("the failure was swallowed")
    except Exception as error:
        assert "disk full" in str(error)
    assert pickup.stream_new(spark, source, out, ledger, "id long").count() == 1


def test_new_archives_stream(spark, tmp_path):
    folder = tmp_path / "zips"
    folder.mkdir()
    make_zip(folder / "a.zip", {"a.json": "{}"})
    seen = []

    def handle(batch, batch_id):
        seen.extend(r["entry"] for r in archives.read_archives(batch).collect())

    run = lambda: pickup.run_available(pickup.new_archives(spark, str(folder)), handle, str(tmp_path / "ledger"))
    run()
    make_zip(folder / "b.zip", {"b.json": "{}"})
    run()
    run()
    assert seen == ["a.json", "b.json"]


def test_index_follows_the_chunks(spark, tmp_path):
    source, index, ledger = (str(tmp_path / n) for n in ("chunks", "index", "ledger"))
    embedder = lambda batch: [[float(len(t))] for t in batch]
    first = rag.chunk(spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string"))
    first.coalesce(1).write.parquet(source)
    assert index_sync.sync_index(spark, source, index, ledger, embedder).count() == 2
    again = rag.chunk(spark.createDataFrame([(2, "longer"), (3, "d")], "doc_id long, text string"))
    again.coalesce(1).write.mode("append").parquet(source)
    rows = index_sync.sync_index(spark, source, index, ledger, embedder)
    assert {(r["doc_id"], r["chunked_text"], r["embedding"][0]) for r in rows.collect()} == {
        (1, "a b", 3.0), (2, "longer", 6.0), (3, "d", 1.0)
    }
    fresh = str(tmp_path / "fresh")
    index_sync.compact(spark, index, fresh)
    assert as_set(index_sync.read_index(spark, fresh).select("doc_id", "chunked_text")) == {(1, "a b"), (2, "longer"), (3, "d")}


def test_scratch_tables_go_at_the_end(spark):
    import os

    from engage.session import materialise, scratch, shared_dir

    with scratch(spark):
        held = materialise(spark.range(3), "held")
        path = held.inputFiles()[0].removeprefix("file://").removeprefix("file:").rsplit("/", 1)[0]
        out = shared_dir(spark, "out")
        held.write.parquet(out)
        assert os.path.exists(path)
    assert not os.path.exists(path) and spark.read.parquet(out).count() == 3
