"""Ordered target statistics, boosted trees with an L2 term, and the halving search."""

import hashlib
import math
import random

import numpy as np
import pytest

from engage.operators import boost, targets


def frame(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.random(), rng.choice([0.0, 1.0]), rng.choice(["x", "y", "hot", "hot", "hot", None])
        rows.append((f"k{i}", a if rng.random() > 0.1 else None, b, c, int(rng.random() < 0.2 + 0.5 * b * (a > 0.4))))
    return rows, spark.createDataFrame(rows, "key string, a double, b double, c string, y int").repartition(3)


@pytest.mark.parametrize("bucket_rows", [10_000, 37])
def test_ordered_stats_see_earlier_rows_only(spark, bucket_rows):
    rows, df = frame(spark)
    got = {r["key"]: r["c_target"] for r in targets.ordered_stats(df, "c", "y", "key", bucket_rows=bucket_rows).collect()}
    seen = {}
    for key, _, _, c, y in sorted(rows, key=lambda r: hashlib.md5(r[0].encode()).hexdigest()):
        s, n = seen.get(c, (0, 0))
        assert got[key] == pytest.approx((s + 0.5) / (n + 1))
        seen[c] = (s + y, n + 1)


def test_rows_of_one_key_do_not_see_each_other_and_null_labels_count_nowhere(spark):
    df = spark.createDataFrame([("k", "x", 1), ("k", "x", 0), ("l", "x", None)], "key string, c string, y int")
    got = {(r["key"], r["y"]): r["c_target"] for r in targets.ordered_stats(df, "c", "y", "key").collect()}
    assert got["k", 1] == got["k", 0]
    first = min("kl", key=lambda k: hashlib.md5(k.encode()).hexdigest())
    assert got["k", 1] == 0.5 and got["l", None] == pytest.approx(0.5 if first == "l" else 1.5 / 3)


def test_tables_encode_other_rows(spark):
    _, df = frame(spark)
    train, test = targets.encode_all(df, [df.limit(3).withColumn("c", df["b"].cast("string"))], ["c"], "y", "key")
    assert train.count() == 400 and {r["c_target"] for r in test.collect()} == {0.5}


def newton(ys, l2, step, rounds):
    raw, out = 0.0, []
    for _ in range(rounds):
        p = 1 / (1 + math.exp(-raw))
        out.append(step * sum(y - p for y in ys) / (len(ys) * p * (1 - p) + l2))
        raw += out[-1]
    return out


@pytest.mark.parametrize("l2", [0.0, 4.0])
def test_leaves_are_newton_steps_with_the_l2_term(spark, l2):
    rows, df = frame(spark)
    model = boost.boost(df, ["b"], "y", 3, step=0.3, l2=l2, depth=1)
    for b in (0.0, 1.0):
        want = newton([r[4] for r in rows if r[2] == b], l2, 0.3, 3)
        assert [t.scores(np.array([[b]]))[0] for t in model.trees] == pytest.approx(want)


def test_trees_score_like_the_training_did_and_survive_a_table(spark, tmp_path):
    _, df = frame(spark)
    model = boost.boost(df, ["a", "b"], "y", 12, step=0.2, depth=3)
    assert len(model.trees) == 12 and max(len(t.feature) for t in model.trees) > 3
    model.to_frame(spark).write.parquet(str(tmp_path / "m"))
    again = boost.Boosted.from_frame(spark.read.parquet(str(tmp_path / "m")))
    one, two = (sorted((r["key"], r["p"]) for r in boost.score(m, df).collect()) for m in (model, again))
    assert one == two and len({p for _, p in one}) > 4
    # the training rows' log loss falls with every few trees
    losses = []
    for rounds in (0, 4, 8, 12):
        scored = boost.score(model, df, rounds=rounds).collect()
        losses.append(-sum(math.log(r["p"] if r["y"] else 1 - r["p"]) for r in scored))
    assert losses == sorted(losses, reverse=True) and losses[0] > losses[-1]


def test_a_continued_model_is_the_model_in_one_go(spark):
    _, df = frame(spark)
    whole = boost.boost(df, ["a", "b"], "y", 6, step=0.2, depth=3)
    half = boost.boost(df, ["a", "b"], "y", 3, step=0.2, depth=3)
    both = boost.boost(df, ["a", "b"], "y", 3, step=0.2, depth=3, start=half)
    assert len(half.trees) == 3
    assert [t.feature for t in both.trees] == [t.feature for t in whole.trees]
    assert [v for t in both.trees for v in t.value] == pytest.approx([v for t in whole.trees for v in t.value])


def test_search_stops_weak_trials(spark):
    _, df = frame(spark)
    space = boost.sample_space(4, (8, 8))
    assert all(4 <= s["depth"] <= 6 and 1e-3 <= s["step"] <= 1e-1 and 3 <= s["l2"] <= 5 for s in space)
    best, table = boost.halving_search(df, ["a", "b"], "y", "key", space)
    rows = table.orderBy("trial").collect()
    assert sorted(r["trees"] for r in rows) == [2, 2, 4, 8] and len(best.trees) == 8
    (winner,) = [r for r in rows if r["winner"]]
    assert winner["trees"] == 8


def additive(df):
    return df.selectExpr("*", "0.1 * a + 0.5 * b as p")


def test_effects_of_an_additive_score_are_its_slopes(spark):
    from engage.operators import evaluate

    _, df = frame(spark)
    df = df.where("a is not null").withColumn("w", df["b"] + 1)
    mean_b = df.agg({"b": "avg"}).first()[0]
    for r in evaluate.partial_dependence(additive, df, "a", [0, 0.5, 1]).collect():
        assert r["avg_score"] == pytest.approx(0.1 * r["value"] + 0.5 * mean_b) and r["n"] == df.count()
    weighted = {r["value"]: r["avg_score"] for r in evaluate.partial_dependence(additive, df, "a", [0.0], weight="w").collect()}
    rows = df.collect()
    assert weighted[0.0] == pytest.approx(sum(0.5 * r["b"] * r["w"] for r in rows) / sum(r["w"] for r in rows))
    for weight in (None, "w"):
        effects = evaluate.accumulated_effects(additive, df, "a", [0, 0.25, 0.5, 1], weight=weight).orderBy("bin").collect()
        assert [b["effect"] - a["effect"] for a, b in zip(effects, effects[1:])] == pytest.approx([0.025, 0.05])
        assert sum(r["n"] for r in effects) == df.count()
