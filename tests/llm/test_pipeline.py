"""The registered queries with SQL, and the pipeline against its stages done by hand."""

import re

import pytest

import corpus_pipeline
from check import compare
from engage.llm import langid, mixing, queries
from tests.llm.test_near import expected

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    ok, detail, _ = compare(spark, FOLDER, name, queries.ORACLE[name])
    assert ok, detail


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_keep_the_columns(spark, documents):
    docs = documents([(1, "the cat", "en", "a"), (2, "the cat", "en", "a"), (3, None, "en", "b")])
    for _, f in corpus_pipeline.STAGES[:-1]:
        assert f(spark, docs, FOLDER).columns == docs.columns


def test_decisions_take_effect(spark, documents):
    words = [f"w{i} " for i in range(40)]
    base = "".join(words)
    near = "".join(words[:20] + ["other "] + words[21:])
    rows = [(1, base, "en", "a"), (2, base.replace(" ", "  "), "en", "a"), (3, near, "en", "a"), (4, "12 34", "en", "a"), (None, base, "en", "a")]
    rows += [(10 + i, f"text number {i} " + "".join(f"q{i}x{j} " for j in range(30)), "en", "b") for i in range(8)]
    docs = documents(rows)
    kept = stage("exact dedup")(spark, docs, FOLDER)
    assert {r["doc_id"] for r in kept.collect()} == {2, 3, 4, *range(10, 18)}
    kept = stage("MinHash near-dedup")(spark, kept, FOLDER)
    assert {r["doc_id"] for r in kept.collect()} == {2, 4, *range(10, 18)}
    mixed = stage("mixing sources to target weights")(spark, kept, FOLDER)
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(kept).collect()}
    words_in = {}
    for r in mixed.collect():
        words_in[r["doc_id"]] = words_in.get(r["doc_id"], 0) + len(r["text"].split())
    assert words_in == {i: n for i, n in taken.items() if n}


def test_exact_stage_decides_by_row(spark, documents):
    rows = [(1, "a b", "en", "a"), (1, "a b", "en", "a"), (1, "a  b", "en", "b"), (1, "c", "en", "a"), (2, "c d", "en", "a"), (3, "cd", "en", "a")]
    rows += [(None, "e f", "en", "a"), (None, "e f", "en", "a"), (None, "g", "en", "a"), (None, "a b", "en", "a"), (4, None, "en", "a"), (5, "", "en", "a")]
    kept = stage("exact dedup")(spark, documents(rows), FOLDER).select("doc_id", "text").collect()
    want = [(1, "a  b"), (1, "c"), (2, "c d"), (4, None), (None, "e f"), (None, "g")]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, want))


def test_exact_stage_keeps_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 7, "x", 2.0), (1, "a b", 7, "x", 2.0), (2, "c", 8, "y", 3.0)], "doc_id int, text string, kept int, text_sha256 string, `n.1` double")
    out = stage("exact dedup")(spark, docs, FOLDER)
    assert out.columns == docs.columns and sorted(tuple(r) for r in out.collect()) == [(1, "a b", 7, "x", 2.0), (2, "c", 8, "y", 3.0)]


def test_whole_run_equals_stages_by_hand(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = corpus_pipeline.run(spark, FOLDER).collect()
    first = {r["doc_id"]: r["text"] for r in langid.accepted(docs).collect()}
    groups = {}
    for i, text in first.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), i))
    second = {min(g)[1]: first[min(g)[1]] for g in groups.values()}
    component = expected_fast(second)
    third = [i for i in second if component[i] == i]
    kept = docs.where(docs.doc_id.isin(third))
    taken = {r["doc_id"] for r in mixing.mix(kept).collect() if r["taken"]}
    assert {r["doc_id"] for r in out} == taken
    tokens = {}
    for r in out:
        tokens.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in tokens.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def expected_fast(texts):
    """Components by brute force, comparing only texts whose lengths and word counts allow a link."""
    from collections import Counter

    counts = {i: Counter(t.split()) for i, t in texts.items()}
    sizes = {i: sum(c.values()) for i, c in counts.items()}
    parent = {i: i for i in texts}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            longer = max(sizes[a], sizes[b])
            if a < b and min(sizes[a], sizes[b]) >= 0.8 * longer and (counts[a] & counts[b]).total() >= 0.8 * longer:
                if len(set(expected([(a, texts[a]), (b, texts[b])]).values())) == 1:
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_empty_table_passes_through(spark, documents):
    docs = documents([])
    for _, f in corpus_pipeline.STAGES:
        out = f(spark, docs, FOLDER)
        assert out.count() == 0
