"""Boosted trees whose leaves carry an L2 term, and a search that stops weak trials early.

MLlib finds each tree on the gradient of the log loss; its leaves are then set to the sum of gradients over the sum of Hessians
plus ``l2``, both summed where the rows are.  A model may be continued, so a trial that goes on pays only for its new trees.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from engage.operators.model import TRAIN_FILL, stratified_split
from engage.session import materialise

# Trees whose scores are looked up in one plan before the running score is written.
WRITE_EVERY = 10
NODE = re.compile(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)")
LEAF = re.compile(r" *Predict: ")


@dataclass
class Tree:
    """Nodes as columns: inner nodes have a feature and children, leaves a value; ``left`` of a leaf is -1."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def leaves(self) -> list[int]:
        """The leaves from left to right, as MLlib numbers them."""
        out, stack = [], [0]
        while stack:
            node = stack.pop()
            if self.left[node] < 0:
                out.append(node)
            else:
                stack += [self.right[node], self.left[node]]
        return out

    def scores(self, rows: np.ndarray) -> np.ndarray:
        feature, threshold, left, right, value = (
            np.array(x) for x in (self.feature, self.threshold, self.left, self.right, self.value)
        )
        at = np.zeros(len(rows), int)
        inner = np.flatnonzero(left[at] >= 0)
        while len(inner):
            here = at[inner]
            down = rows[inner, feature[here]] <= threshold[here]
            at[inner] = np.where(down, left[here], right[here])
            inner = inner[left[at[inner]] >= 0]
        return value[at]


def parsed(text: str) -> Tree:
    """A tree of MLlib from its printed form, in preorder."""
    tree, open_ = Tree(), []
    for line in text.splitlines()[1:]:
        split = NODE.match(line)
        if split and split[3] == ">":
            continue
        if not split and not LEAF.match(line):
            continue
        node = len(tree.feature)
        if open_:
            parent = open_[-1]
            if tree.left[parent] == 0:
                tree.left[parent] = node
            else:
                tree.right[parent] = node
                open_.pop()
        tree.feature.append(int(split[2]) if split else 0)
        tree.threshold.append(float(split[4]) if split else 0.0)
        tree.left.append(0 if split else -1)
        tree.right.append(-1)
        tree.value.append(0.0)
        if split:
            open_.append(node)
    return tree


@dataclass
class Boosted:
    """Numeric ``features`` and the trees over them, each with its step already in its values."""

    features: list[str]
    trees: list[Tree] = field(default_factory=list)

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (t, i, *node)
            for t, x in enumerate(self.trees)
            for i, node in enumerate(zip(x.feature, x.threshold, x.left, x.right, x.value, strict=True))
        ]
        schema = "tree int, node int, feature int, threshold double, left int, right int, value double"
        return spark.createDataFrame(rows, schema).withColumn("features", F.lit(self.features))

    @staticmethod
    def from_frame(df: DataFrame) -> Boosted:
        """A model written as a table: a few hundred rows per tree at most."""
        rows = df.orderBy("tree", "node").collect()
        trees: list[Tree] = []
        for r in rows:
            if r["node"] == 0:
                trees.append(Tree())
            for name in ("feature", "threshold", "left", "right", "value"):
                getattr(trees[-1], name).append(r[name])
        return Boosted(list(rows[0]["features"]) if rows else [], trees)


def _inputs(features: Sequence[str]) -> Column:
    filled = [F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None)), F.lit(float(TRAIN_FILL))) for f in features]
    return F.array(*filled)


def raw_score(model: Boosted, inputs: Column, rounds: int | None = None) -> Column:
    """The log odds after the first ``rounds`` trees, from a column of the features' values."""
    trees = model.trees[:rounds]

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = np.array(batch.to_list(), "float64").reshape(len(batch), -1)
            yield pd.Series(sum((tree.scores(rows) for tree in trees), np.zeros(len(rows))))

    return run(inputs)


def _probability(raw: Column) -> Column:
    return 1 / (1 + F.exp(-raw))


def score(model: Boosted, df: DataFrame, name: str = "p", rounds: int | None = None) -> DataFrame:
    """Add the probability of class 1."""
    if not model.trees[:rounds]:
        return df.withColumn(name, F.lit(0.5))
    return df.withColumn(name, _probability(raw_score(model, _inputs(model.features), rounds)))


def boost(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    rounds: int,
    step: float = 0.03,
    l2: float = 3.0,
    depth: int = 6,
    bins: int = 64,
    weight: str | None = None,
    start: Boosted | None = None,
    seed: int = 42,
) -> Boosted:
    """Add ``rounds`` trees to ``start`` (nothing, by default).

    Features are numbers; encode categories first.  ``df`` should be a table.  A round fits one tree on the gradients and sums
    gradients and Hessians by leaf, 2^depth rows; trees follow each other as boosting has it.  Continuing a model gives
    the trees that boosting it in one go would give.
    """
    model = Boosted(list(features)) if start is None else replace(start, trees=list(start.trees))
    inputs = _inputs(model.features)
    rows = df.select(
        inputs.alias("x"),
        F.col(label).cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"),
    ).where("y is not null")
    raw = raw_score(model, F.col("x")) if model.trees else F.lit(0.0)
    rows = materialise(rows.withColumn("raw", raw), "boost")
    for n in range(rounds):
        p = _probability(F.col("raw"))
        round_ = rows.select(array_to_vector("x").alias("features"), (F.col("y") - p).alias("g"), "w", "x", "y", "raw")
        learner = DecisionTreeRegressor(
            featuresCol="features", labelCol="g", weightCol="w", maxDepth=depth, maxBins=bins,
            seed=seed + len(model.trees), leafCol="leaf",
        )
        fitted = learner.fit(round_)
        tree = parsed(fitted.toDebugString)
        found = fitted.transform(round_).select("x", "y", "w", "raw", "g", F.col("leaf").cast("int").alias("leaf"))
        sums = found.groupBy("leaf").agg(
            F.sum(F.col("w") * F.col("g")).alias("g"), F.sum(F.col("w") * p * (1 - p)).alias("h")
        )
        # one row per leaf
        values = {r["leaf"]: step * r["g"] / (r["h"] + l2) for r in sums.collect()}
        leaves = tree.leaves()
        for number, node in enumerate(leaves):
            tree.value[node] = values.get(number, 0.0)
        model.trees.append(tree)
        table = F.array(*[F.lit(tree.value[node]) for node in leaves])
        rows = found.select("x", "y", "w", (F.col("raw") + F.get(table, F.col("leaf"))).alias("raw"))
        if n % WRITE_EVERY == WRITE_EVERY - 1 and n + 1 < rounds:
            rows = materialise(rows, "boost")
    return model


def sample_space(trials: int, rounds: tuple[int, int] = (500, 1000), seed: int = 42) -> list[dict]:
    """Random parameters: depth 4-6, log-uniform step 1e-3 to 1e-1, L2 3-5, 32 or 64 bins, and most rounds."""
    rng = random.Random(seed)
    return [
        {
            "depth": rng.randint(4, 6),
            "step": math.exp(rng.uniform(math.log(1e-3), math.log(1e-1))),
            "l2": float(rng.randint(3, 5)),
            "bins": rng.choice((32, 64)),
            "rounds": rng.randint(*rounds),
        }
        for _ in range(trials)
    ]


def recall(scored: DataFrame, label: str, p: str = "p", threshold: float = 0.5) -> float:
    one = F.col(label) == 1
    found, total = scored.agg(F.count_if(one & (F.col(p) > threshold)), F.count_if(one)).first()
    return found / total if total else 0.0


def halving_search(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    space: Sequence[dict],
    keep: int = 2,
    rungs: int = 3,
    weight: str | None = None,
    validate_share: float = 0.2,
) -> tuple[Boosted, DataFrame]:
    """The best model by recall on a validation share, and one row per trial with the trees it was given.

    All trials grow to ``1 / keep ** (rungs - 1)`` of their rounds; of each rung the best ``1 / keep`` go on, from the trees they have,
    to the next share.  Ties go to the smaller log loss, then to the earlier trial.
    """
    split = materialise(stratified_split(df.drop("is_test"), key, label, validate_share), "search")
    fit, held = split.where("is_test = 0"), split.where("is_test = 1")
    models: dict[int, Boosted] = {}
    found: dict[int, tuple[float, float]] = {}
    alive = list(range(len(space)))
    for rung in range(rungs):
        for trial in alive:
            most = space[trial]["rounds"]
            until = max(1, math.ceil(most / keep ** (rungs - 1 - rung)))
            has = models.get(trial)
            params = {k: v for k, v in space[trial].items() if k != "rounds"}
            models[trial] = boost(
                fit, features, label, until - (len(has.trees) if has else 0), weight=weight, start=has, **params
            )
            scored = materialise(score(models[trial], held.select(label, *features)).select(label, "p"), "validated")
            y = F.col(label)
            loss = -F.avg(y * F.log("p") + (1 - y) * F.log(1 - F.col("p")))
            found[trial] = (recall(scored, label), scored.agg(loss).first()[0] or 0.0)
        alive = sorted(alive, key=lambda t: (-found[t][0], found[t][1], t))[: max(1, math.ceil(len(alive) / keep))]
    rows = [
        (i, s["depth"], s["step"], s["l2"], s["bins"], s["rounds"], len(models[i].trees), *found[i], i == alive[0])
        for i, s in enumerate(space)
    ]
    table = df.sparkSession.createDataFrame(
        rows,
        "trial int, depth int, step double, l2 double, bins int, rounds int, trees int, recall double, log_loss double, winner boolean",
    )
    return models[alive[0]], table
