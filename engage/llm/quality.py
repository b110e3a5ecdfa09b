"""Quality scores from document statistics by kernel ridge regression on random Fourier features.

``STATISTICS`` describe a whole text: lengths, shares of letter kinds, repetition of words and lines.  Standardised,
they pass through cosines of random projections, whose products approximate a Gaussian kernel.  Ridge scores on these
features solve normal equations that every partition of the fitting rows sums for itself; isotonic regression on
rows that the ridge did not see turns scores into probabilities of label 1.

The fit takes about ``FIT_ROWS`` labelled rows at most, chosen by a hash of the id, from those that are not held out.

Defined results: null text is empty and scored like any other; a doc_id labelled more than once has its smallest
label; without labels, or with one label value only, every score is the share of label 1, or 0.5; repeated rows are
scored each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from engage.llm.common import binary_lists, fold_of, held_out, in_parts, texts
from engage.session import materialise

FEATURES = 256
WIDTH = 4.0
RIDGE = 1.0
FIT_ROWS = 20_000
FIT_PARTS = 8
CALIBRATION_FOLD = 3
PREDICT = 0.7
SEED = 5
CLIP = 6.0

KINDS = np.full(256, 7)
for _kind, _bytes in enumerate([b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\n\x0b\x0c\r", b".,;:!?'\"-()"]):
    KINDS[list(_bytes)] = _kind
KINDS[128:] = 5
KINDS[list(b"|{}[]<>#$%&*@^~=_+\\/`")] = 6

STATISTICS = (
    "chars words word_mean word_sd word_max lower upper digit white punct other_script symbol control top_symbol bang "
    "distinct top_word hapax lines line_mean repeated_lines ended_lines entropy no_letter capital_words"
).split()


def describe(text: bytes) -> list[float]:
    """The statistics of a text, in the order of STATISTICS."""
    n = len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(KINDS, counts, minlength=8) / n
    symbols = counts * ((KINDS == 6) | (KINDS == 4))
    words = text.split()
    tally = Counter(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    lines = [x for x in text.split(b"\n") if x.strip()]
    distinct = set(lines)
    p = counts[counts > 0] / n
    total = max(1, len(words))
    return [
        np.log1p(n),
        np.log1p(len(words)),
        float(sizes.mean()),
        float(sizes.std()),
        np.log1p(float(sizes.max())),
        *kinds[:8].tolist(),
        float(symbols.max()) / n,
        counts[33] / n,
        len(tally) / total,
        max(tally.values(), default=0) / total,
        sum(1 for c in tally.values() if c == 1) / total,
        np.log1p(len(lines)),
        np.log1p(n / max(1, len(lines))),
        1 - len(distinct) / max(1, len(lines)),
        sum(1 for x in lines if x.rstrip()[-1:] in b".!?") / max(1, len(lines)),
        float(-(p * np.log(p)).sum()),
        sum(c for w, c in tally.items() if not any(97 <= b <= 122 or 65 <= b <= 90 or b > 127 for b in w)) / total,
        sum(c for w, c in tally.items() if 65 <= w[0] <= 90) / total,
    ]


@dataclass
class Scorer:
    """Standardisation, random projection, ridge weights and the calibration's corners."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    level: float
    corners: tuple[np.ndarray, np.ndarray]

    def features(self, x: np.ndarray) -> np.ndarray:
        projection, phase = projections(x.shape[1], len(self.weights))
        z = np.clip((x - self.mean) / self.scale, -CLIP, CLIP)
        return np.sqrt(2 / len(phase)) * np.cos(z @ projection + phase)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights + self.level

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.corners), 0, 1)


def projections(n: int, features: int, width: float = WIDTH, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(0, 1 / width, (n, features)), rng.uniform(0, 2 * np.pi, features)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corners of a non-decreasing fit by pooling adjacent violators; equal x are pooled first."""
    x, inverse = np.unique(x, return_inverse=True)
    weight = np.bincount(inverse).astype(float)
    value = np.bincount(inverse, y) / weight
    pools: list[list[float]] = []
    for at, v, w in zip(x, value, weight, strict=True):
        pools.append([v, w, at * w])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v2, w2, a2 = pools.pop()
            v1, w1, a1 = pools.pop()
            pools.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, a1 + a2])
    # a pool's value, drawn to one half as by one more row of each label, stands at its centre
    return np.array([p[2] / p[1] for p in pools]), np.array([(p[0] * p[1] + 0.5) / (p[1] + 1) for p in pools])


def described(batches):
    """(doc_id, stats) of whole texts, and ``label`` where the rows have one."""
    for batch in in_parts(batches):
        stats = [np.asarray(describe(t), "<f8").tobytes() for t in binary_lists(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(stats, pa.binary()), batch.column("label")], names=["doc_id", "stats", "label"]
        )


def matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, len(STATISTICS))


def partition_sums(rows: DataFrame, make) -> list[np.ndarray]:
    """Sums that every partition makes of its rows' (statistics, labels, calibration rows), added up; FIT_PARTS partitions at most."""

    def summed(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                folds = np.array([fold_of(i) for i in batch.column("doc_id").to_pylist()])
                part = make(matrix(batch.column("stats")), np.asarray(batch.column("label"), float), folds)
                total = part if total is None else [a + b for a, b in zip(total, part, strict=True)]
        if total is not None:
            sums = [np.asarray(a, "<f8").tobytes() for a in total]
            yield pa.RecordBatch.from_arrays([pa.array([sums], pa.list_(pa.binary()))], names=["sums"])

    parts = rows.coalesce(FIT_PARTS).mapInArrow(summed, "sums array<binary>").collect()
    parts = sorted([bytes(s) for s in p["sums"]] for p in parts)
    return [sum(np.frombuffer(s, "<f8") for s in column) for column in zip(*parts, strict=True)]


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, features: int = FEATURES, ridge: float = RIDGE) -> Scorer:
    n_stats = len(STATISTICS)
    empty = Scorer(np.zeros(n_stats), np.ones(n_stats), np.zeros(features), 0.5, (np.array([0.0]), np.array([0.5])))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"))
    n = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    # about fit_rows ids and labels, whatever the corpus: small enough for every task
    chosen = known.where(draw < min(1.0, fit_rows / max(n, 1)))
    rows = texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    rows = materialise(rows.mapInArrow(described, "doc_id long, stats binary, label int"), "statistics")

    def moments(x, y, folds):
        return [np.array([len(y), y.sum()]), x.sum(axis=0), (x * x).sum(axis=0)]

    sums = partition_sums(rows, moments)
    if not sums:
        return empty
    count, ones = sums[0]
    if ones in (0, count):
        empty.corners = (np.array([0.0]), np.array([ones / count]))
        return empty
    mean = sums[1] / count
    scale = np.sqrt(np.maximum(sums[2] / count - mean * mean, 0))
    model = Scorer(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(features), 0.0, empty.corners)

    def normal(x, y, folds):
        own = folds != CALIBRATION_FOLD
        z, t = model.features(x[own]), y[own]
        return [(z.T @ z).ravel(), z.T @ t, z.sum(axis=0), np.array([len(t), t.sum()])]

    gram, cross, total, (m, hits) = partition_sums(rows, normal)
    if not m:
        return empty
    model.level = hits / m
    gram = gram.reshape(features, features) - np.outer(total, total) / m
    model.weights = np.linalg.solve(gram + ridge * np.eye(features), cross - total * model.level)
    model.level -= float(total @ model.weights) / m
    found = rows.toPandas()
    own = found["doc_id"].map(fold_of) == CALIBRATION_FOLD
    found = found[own] if own.any() else found
    x = np.frombuffer(b"".join(map(bytes, found["stats"])), "<f8").reshape(-1, n_stats)
    model.corners = isotonic(model.raw(x), found["label"].to_numpy(float))
    return model


def quality(docs: DataFrame, labels: DataFrame, model: Scorer | None = None, threshold: float = PREDICT) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels) if model is None else model

    def scored(batches):
        for batch in in_parts(batches):
            x = np.array([describe(t) for t in binary_lists(batch.column("text"))]).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(x), pa.float64())], names=["doc_id", "score"]
            )

    found = texts(docs).mapInArrow(scored, "doc_id long, score double")
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )
