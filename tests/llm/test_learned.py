"""Language identification and quality: held-out accuracy and special cases."""

import random

import numpy as np
import pytest

from engage.llm import langid, quality
from engage.llm.common import read

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def given(spark):
    return read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")


def test_languages_of_held_out_rows(given):
    docs, _ = given
    found = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("lang is not null").collect()
    held = [r["lang"] == r["lang_pred"] for r in found if r["held_out"]]
    assert np.mean(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in found)


def test_undetermined_and_long_texts(documents):
    train = [(i, "the cat and the dog " * 5 if i % 2 else "der hund und die katze " * 5, "en" if i % 2 else "de") for i in range(60)]
    rows = [(100, None, None), (101, "", None), (102, "123 !?", None), (103, "the dog " * 400_000, None), (104, "die katze", None), (None, "the cat", None), (104, "die katze", None)]
    got = langid.identify(documents(train + rows)).where("doc_id >= 100 or doc_id is null").collect()
    found = sorted([(r["doc_id"], r["lang_pred"]) for r in got], key=str)
    assert found == sorted([(100, "und"), (101, "und"), (102, "und"), (103, "en"), (104, "de"), (104, "de"), (None, "en")], key=str)
    assert all((r["score"] == 0) == (r["lang_pred"] == "und") and r["rejected"] == (r["score"] < 0.5) for r in got)


def test_without_labels_nothing_is_known(documents):
    rows = [(1, "some words"), (2, None)]
    assert {r["lang_pred"] for r in langid.identify(documents(rows)).collect()} == {"und"}
    assert langid.accepted(documents(rows)).count() == 0
    assert langid.identify(documents([])).collect() == []


def test_blocks_count_each_ngram_once(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.choice(np.frombuffer(b"abc d", np.uint8), 5000)
    model = langid.Model(["x", "y"], rng.normal(size=(1 << langid.BITS, 2)).astype(np.float32), np.zeros(2, np.float32))
    import pyarrow as pa

    column = pa.array([data.tobytes(), b"", data[:50].tobytes()])
    whole = langid.predicted(column, np.ones(3, bool), model)
    monkeypatch.setattr(langid, "BLOCK", 700)
    parts = langid.predicted(column, np.ones(3, bool), model)
    assert whole[0] == parts[0] and np.allclose(whole[1], parts[1])


def test_accepted_keeps_rows_as_they_are(given):
    docs, _ = given
    kept = langid.accepted(docs)
    assert kept.columns == docs.columns
    assert kept.count() >= 0.99 * docs.count()
    assert kept.exceptAll(docs).count() == 0


def test_quality_of_held_out_rows(given):
    docs, labels = given
    found = quality.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    score, truth = np.array([r["score"] for r in found]), np.array([r["quality"] for r in found])
    good, bad = score[truth == 1], score[truth == 0]
    auc = ((good[:, None] > bad).mean() + (good[:, None] >= bad).mean()) / 2
    assert auc > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in found)


def test_quality_special_cases(spark, documents, given):
    docs, labels = given
    rows = documents([(1, None), (2, ""), (2, ""), (None, "text " * 100_000), (3, "| | |")])
    model = quality.fit(docs, labels)
    got = quality.quality(rows, labels, model).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality.quality(rows, none).collect()} == {0.5}
    assert quality.quality(documents([]), none).collect() == []


def test_isotonic_never_falls():
    rng = np.random.default_rng(2)
    x = rng.normal(size=500).round(1)
    y = (rng.random(500) < 1 / (1 + np.exp(-x))).astype(float)
    corners, values = quality.isotonic(x, y)
    assert (np.diff(corners) > 0).all() and (np.diff(values) >= -0.02).all()


def test_sums_do_not_depend_on_partitions(spark, given):
    docs, labels = given
    a = quality.fit(docs.repartition(5), labels)
    b = quality.fit(docs.repartition(2), labels)
    assert np.allclose(a.weights, b.weights, atol=1e-6) and np.isclose(a.level, b.level)


def test_every_language_is_learned(documents):
    """More languages than the whole sample's bound gives a full share to."""
    rng = random.Random(12)
    words = {f"l{k:03d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(4)] for k in range(230)}
    rows = [(20 * k + i, " ".join(rng.choice(w) for _ in range(12)), lang) for k, (lang, w) in enumerate(words.items()) for i in range(12)]
    model = langid.fit(documents(rows), fit_rows=1000)
    assert model.langs == sorted(words)
