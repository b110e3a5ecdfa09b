"""The streamed change feed, the table merged by parts, spans by cells, and mergeable counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import Row, functions as F

from engage.operators import audit, keyed_table, labels, merge
from engage.session import materialise, shared_dir
from engage.streaming import changes, index_sync, pickup
from tests.conftest import as_set


def chunks(spark, docs, version):
    rows = [(hash_id(d, i), d, i, text, version) for d, texts in docs.items() for i, text in enumerate(texts or ())]
    rows += [(None, d, None, None, version) for d, texts in docs.items() if texts is None]
    return spark.createDataFrame(rows, changes.VERSIONED)


def hash_id(doc, ix):
    return (doc * 1_000_003 + ix) * 2**40 + 7  # beyond what a double can hold


def feed(spark, waves):
    """The changes of every wave, each a trigger of its own; the last wave is offered twice."""
    source, ledger, out = (shared_dir(spark, n) for n in ("versions", "ledger", "out"))
    before = spark.conf.get(changes.STATE_STORE)
    spark.conf.set(changes.STATE_STORE, changes.ROCKS)
    for frame in [*waves, waves[-1]]:
        frame.write.mode("append").parquet(source)
        stream = changes.change_stream(pickup.new_files(spark, source, changes.VERSIONED, "*.parquet"))
        pickup.run_available(stream, pickup.write_batch(out), ledger)
    spark.conf.set(changes.STATE_STORE, before)
    return spark.read.parquet(out)


def test_stream_gives_the_feed_of_the_snapshots(spark):
    first = {1: ["a", "b", "c"], 2: ["x"], 3: ["same", "same"], 4: ["gone"]}
    second = {1: ["a", "B"], 4: None, 5: ["new"]}
    got = feed(spark, [chunks(spark, first, 1), chunks(spark, second, 2)])
    after = {1: ["a", "B"], 2: ["x"], 3: ["same", "same"], 5: ["new"]}
    drop = lambda d: chunks(spark, d, 0).drop("version")
    want = merge.change_feed(drop(first), drop(after), "chunk_id")
    blank = {c: F.when(F.col("change_type") != "delete", F.col(c)) for c in ("chunk_ix", "chunked_text")}
    columns = ["chunk_id", "doc_id", "chunk_ix", "chunked_text", "change_type"]
    assert as_set(got.where("batch_id = 0").select(*columns)) == {
        (hash_id(d, i), d, i, t, "insert") for d, texts in first.items() for i, t in enumerate(texts)
    }
    assert as_set(got.where("batch_id = 1").select(*columns)) == as_set(want.withColumns(blank).select(*columns))
    # what was offered again changed nothing
    assert got.where("batch_id = 2").isEmpty()


def test_older_versions_and_several_in_one_trigger(spark):
    both = chunks(spark, {1: ["old"]}, 1).union(chunks(spark, {1: ["new", "more"]}, 3))
    late = chunks(spark, {1: ["late"], 2: ["two"]}, 2)
    got = feed(spark, [both, late])
    assert as_set(got.select("batch_id", "doc_id", "chunked_text", "change_type")) == {
        (0, 1, "new", "insert"), (0, 1, "more", "insert"), (1, 2, "two", "insert"),
    }


@pytest.mark.parametrize("kind", ["int", "long"])
def test_merge_replaces_few_parts_and_equals_upsert(spark, kind):
    rng = random.Random(4)
    rows = [(i if i % 9 else None, rng.randint(0, 9), f"t{i}") for i in range(500)]
    target = spark.createDataFrame(rows, f"k {kind}, n int, s string")
    source = spark.createDataFrame([(3, 77, "upd"), (4, 78, None), (9000, 79, "ins"), (None, 80, "null")], "k long, n int, s string")
    path = shared_dir(spark, "table")
    keyed_table.create(target, path, "k", 32)
    want = sorted(as_set(merge.upsert(target, source, "k")), key=str)
    touched = keyed_table.merge_into(spark, path, source)
    assert len(touched) <= 4
    got = keyed_table.read(spark, path)
    assert sorted([tuple(r) for r in got.collect()], key=str) == want
    # rows with keys can be merged again, and nothing else moved
    again = keyed_table.merge_into(spark, path, source.where("k is not null"))
    assert set(again) <= set(touched) and sorted([tuple(r) for r in keyed_table.read(spark, path).collect()], key=str) == want
    assert keyed_table.merge_into(spark, path, source.limit(0)) == []


def test_merge_by_parts_with_conditions_and_without_inserts(spark):
    target = spark.createDataFrame([(i, i % 3, i * 10) for i in range(60)], "a int, b int, v int")
    source = spark.createDataFrame([(5, 2, 1), (6, 0, 2), (99, 0, 3)], "a int, b int, v int")
    path = shared_dir(spark, "table")
    keyed_table.create(target, path, ["a", "b"], 8)
    update = {"v": F.when(F.col("v") > 55, F.col("_src_v")).otherwise(F.col("v"))}
    keyed_table.merge_into(spark, path, source, update, insert=False)
    assert as_set(keyed_table.read(spark, path)) == as_set(merge.upsert(target, source, ["a", "b"], update, insert=False))


@pytest.mark.parametrize("width", [None, 1, 400])
def test_contained_finds_every_pair_once(spark, width):
    rng = random.Random(1)
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(n)
    spans = [(i, day(a := rng.randint(0, 900)), day(a + rng.randint(-3, 200))) for i in range(300)]
    spans += [(900, dt.date(1, 1, 1), dt.date(9999, 12, 31)), (901, None, day(5)), (902, day(5), None)]
    points = [(j, day(rng.randint(200, 700))) for j in range(80)] + [(99, None)]
    got = labels.contained(
        spark.createDataFrame(spans, "i int, f date, l date"), spark.createDataFrame(points, "j int, d date"), "f", "l", "d", width
    )
    rows = [(r["i"], r["j"]) for r in got.collect()]
    want = {(i, j) for i, f, l in spans for j, d in points if f and l and d and f <= d <= l}
    assert len(rows) == len(want) and set(rows) == want


def test_contained_without_points(spark):
    spans = spark.createDataFrame([(1, dt.date(2000, 1, 1), dt.date(2001, 1, 1))], "i int, f date, l date")
    assert labels.contained(spans, spark.createDataFrame([], "j int, d date"), "f", "l", "d").isEmpty()


def test_sketches_unite(spark):
    df = spark.range(60_000).selectExpr("id % 20000 as id", "cast(id % 7 as int) as day", "id % 2 as org")
    daily = audit.count_sketches(df, ["org", "day"])
    assert daily.count() == 14
    for r in audit.united_counts(daily, ["org"]).collect():
        assert abs(r["n"] - 10_000) < 500
    (n,) = audit.united_counts(daily.where("day < 2")).first()
    exact = df.where("day < 2").select("id").distinct().count()
    assert abs(n - exact) < 0.05 * exact
    assert audit.united_counts(daily.limit(0)).first()[0] == 0


def test_snapshots_meet_by_hashes_and_texts_are_written_once(spark, monkeypatch):
    schema = "chunk_id long, doc_id long, chunk_ix int, chunked_text string"
    first = [(1, 1, 0, "a"), (2, 1, 1, None), (3, 2, 0, ""), (4, 2, 1, "gone"), (5, 3, 0, "same")]
    second = [(1, 1, 0, "b"), (2, 1, 1, ""), (3, 2, 0, None), (5, 3, 0, "same"), (6, 4, 0, "new")]
    before, after = (spark.createDataFrame(rows, schema) for rows in (first, second))
    written = []
    monkeypatch.setattr(index_sync, "materialise", lambda df, name: written.append(df.columns) or materialise(df, name))
    index = shared_dir(spark, "index")
    embedder = lambda texts: [[float(len(t or ""))] for t in texts]
    index_sync.sync_changes(spark, None, before, index, 0, embedder)
    rows = index_sync.sync_changes(spark, before, after, index, 1, embedder)
    assert as_set(rows.drop("embedding")) == set(second)
    stored = spark.read.option("mergeSchema", "true").parquet(index).where("batch_id = 1")
    assert {r["chunk_id"]: r[index_sync.GONE] for r in stored.collect()} == {1: False, 2: False, 3: False, 4: True, 6: False}
    assert written and not any("chunked_text" in columns for columns in written)


def test_changes_of_a_document_are_rows_and_its_state_is_read_once():
    class Known:
        value, reads = None, 0

        def get(self):
            self.reads += 1
            return self.value

        def update(self, value):
            self.value = value

    row = Row("chunk_id", "chunk_ix", "chunked_text", "version", "gone", "hash")
    state = changes._Changes()
    state.known = Known()
    run = lambda *rows: [tuple(r) for r in state.handleInputRows((7,), iter(rows), None)]
    old, twice = row(1, 0, "old", 0, False, 9), row(1, 0, "a", 1, False, 5)
    assert run(old, twice, twice, row(2, 1, "b", 1, False, 6)) == [(1, 7, 0, "a", "insert"), (2, 7, 1, "b", "insert")]
    assert run(row(1, 0, "c", 2, False, 8)) == [(1, 7, 0, "c", "update"), (2, 7, None, None, "delete")]
    assert run(row(1, 0, "z", 2, False, 3)) == []
    assert run(row(0, 0, None, 3, True, 42)) == [(1, 7, None, None, "delete")]
    assert state.known.reads == 4
