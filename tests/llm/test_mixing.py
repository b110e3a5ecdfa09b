"""Mixing: targets, taken words, positions."""

import pytest

from engage.llm import mixing as op


def filled(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in stopped)
        share = sum(weight[s] for s in names if s not in stopped)
        target = {s: cap * sizes[s] if s in stopped else left * weight[s] / share for s in names}
        over = {s for s in names if s not in stopped and target[s] > cap * sizes[s]}
        if not over:
            return target
        stopped |= over


def rows():
    out = []
    for i in range(120):
        source = ["a", "b", None, "ä", "B", "z"][i % 6]
        out.append((i, "word " * (i % 17 + (400 if source == "a" else 0)), "en", source))
    return out + [(500, None, None, "a"), (501, "", None, None), (3, "x y", None, "b"), (3, "x y", None, "b"), (None, "p q r", None, "z")]


def test_targets_and_taken_words(documents):
    data = rows()
    got = op.mix(documents(data)).collect()
    sizes = {}
    for _, text, _, source in data:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = filled(sizes)
    by_source = {}
    assert len(got) == len(data)
    source_of = {}
    for i, text, _, source in data:
        source_of.setdefault((i, len((text or "").split())), source)
    for r in got:
        source = source_of[(r["doc_id"], r["size"])]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(want[source])
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_source[source] = by_source.get(source, 0) + r["taken"]
    assert all(abs(by_source[s] - want[s]) <= 1 for s in want)
    positions = [r["position"] for r in got if r["position"] is not None]
    assert positions == sorted(positions) and all(0 <= p < 1 for p in positions)


def test_curriculum_gives_the_words_taken(documents):
    data = rows()
    docs = documents(data)
    mixed = op.curriculum(docs)
    assert mixed.columns == docs.columns
    taken = sum(r["taken"] for r in op.mix(docs).collect())
    assert sum(len(r["text"].split()) for r in mixed.collect()) == taken


def test_reruns_agree(documents):
    docs = documents(rows())
    assert op.mix(docs).collect() == op.mix(docs.repartition(7)).collect()


def test_empty_and_wordless_tables(documents):
    assert op.mix(documents([])).collect() == []
    assert [r["taken"] for r in op.mix(documents([(1, None), (2, " ")])).collect()] == [0, 0]


def test_rows_that_share_an_id_stand_by_their_texts(documents):
    """Null and repeated ids at volume: no bucket holds them all, and the words add up."""
    data = [(None, f"w{i} " * (1 + i % 5), "en", "a") for i in range(3000)] + [(7, f"v{i} " * 3, "en", "b") for i in range(3000)]
    docs = documents(data)
    places = op.placed(docs, ["doc_id"]).select("place").collect()
    assert len({p["place"][: op.COARSE] for p in places}) > 2000
    got = op.mix(docs).collect()
    sizes = {"a": sum(1 + i % 5 for i in range(3000)), "b": 9000}
    want = filled(sizes)
    for source, key in (("a", None), ("b", 7)):
        assert abs(sum(r["taken"] for r in got if r["doc_id"] == key) - want[source]) <= 1


def test_bucket_sizes_do_not_change_the_mix(documents):
    docs = documents(rows())
    want = op.placed(docs, ["doc_id"], coarse=0, fine=0).drop("row").collect()
    for coarse, fine in ((1, 1), (1, 2), (3, 6)):
        got = op.placed(docs, ["doc_id"], coarse=coarse, fine=fine).drop("row").collect()
        assert sorted(map(str, got)) == sorted(map(str, want))
