"""Language identification by averaged hashed subword embeddings and a linear softmax.

Byte n-grams inside words, word ends included, are hashed into buckets; a text is the mean of its buckets' vectors, and a
linear softmax on the mean gives the language.  Vectors and weights are trained together by stochastic gradient
descent in NumPy on a bounded sample of the labelled rows (about ``FIT_PER_LANG`` whole texts of each language; fewer
where ``FIT_ROWS`` is divided among more languages than that allows, 32 at least).  Every language is learned.  The
fold that is not held out but not trained on either sets a temperature, so that the score is a probability, and texts
whose score is below ``REJECT`` are rejected.  Scoring reads whole texts; since mean and softmax layer are both
linear, the two tables are multiplied once and a text's logits are sums of table rows.

Defined results: null texts and texts without a letter are ``und`` with score 0 and rejected; without any labelled
row every text is; rows with a null language are scored like others; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from engage.llm.common import column_bytes, fold_of, held_out, in_parts

BITS = 15
DIM = 16
SIZES = (2, 3, 4)
EPOCHS = 6
RATE = 0.5
SEED = 7
# Bounds of the sample a model is fitted on: rows of a language and of all.
FIT_PER_LANG = 1200
FIT_ROWS = 240_000
# Fold of the rows that set the temperature; with HELD_OUT aside, the others train.
CALIBRATION_FOLD = 3
REJECT = 0.5
# Bytes of text that are hashed at a time.
BLOCK = 512 << 10

# Lower-case ASCII letters and all bytes of other scripts stay; everything else is a word end.
KEEP = np.zeros(256, np.uint8)
KEEP[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
KEEP[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
KEEP[128:] = np.arange(128, 256)


def grams(data: np.ndarray, bits: int = BITS, sizes=SIZES) -> tuple[np.ndarray, np.ndarray]:
    """(position, bucket) of every n-gram that lies in one word or has a word end as its first or last byte."""
    letters = KEEP[data]
    inside = letters != 0
    at, buckets = [], []
    for n in sizes:
        m = len(letters) - n + 1
        if m <= 0:
            continue
        value = np.zeros(m, np.uint32)
        for i in range(n):
            value = (value << np.uint32(8)) | letters[i : i + m]
        good = inside[:m] | inside[n - 1 : n - 1 + m]
        for i in range(1, n - 1):
            good &= inside[i : i + m]
        where = np.flatnonzero(good)
        hashed = (value[where] + np.uint32(n)) * np.uint32(2654435761)
        at.append(where)
        buckets.append(hashed >> np.uint32(32 - bits))
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    return np.concatenate(at), np.concatenate(buckets)


def framed(text: bytes) -> np.ndarray:
    return np.frombuffer(b" " + text + b" ", np.uint8)


def features(batches, bits: int = BITS):
    """(doc_id, lang, buckets, counts) of sampled rows."""
    for batch in in_parts(batches):
        data, at = column_bytes(batch.column("text"))
        found = [np.unique(grams(framed(data[a:b].tobytes()), bits)[1], return_counts=True) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("lang"),
                pa.array([f[0].astype("<u4").tobytes() for f in found], pa.binary()),
                pa.array([f[1].astype("<f4").tobytes() for f in found], pa.binary()),
            ],
            names=["doc_id", "lang", "buckets", "counts"],
        )


@dataclass
class Model:
    """Learned languages, and per bucket the logits its vector adds; ``bias`` and ``temperature`` finish them."""

    langs: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def probabilities(self, sums: np.ndarray, n: np.ndarray) -> np.ndarray:
        return softmax((sums / np.maximum(n, 1)[:, None] + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], bits=BITS, dim=DIM, epochs=EPOCHS, rate=RATE, seed=SEED) -> Model:
    """Stochastic gradient descent on vectors and softmax weights over (lang, buckets, counts) rows."""
    langs = sorted({r[0] for r in rows})
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 1 / dim, (1 << bits, dim)).astype(np.float32)
    weights = np.zeros((dim, len(langs)), np.float32)
    bias = np.zeros(len(langs), np.float32)
    index = {lang: i for i, lang in enumerate(langs)}
    rows = [(index[lang], b, c / c.sum()) for lang, b, c in rows if len(b)]
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            y, buckets, share = rows[i]
            step = rate * (1 - done / steps)
            done += 1
            mean = share @ vectors[buckets]
            slope = softmax(mean @ weights + bias)
            slope[y] -= 1
            back = weights @ slope
            weights -= step * np.outer(mean, slope)
            bias -= 0.1 * step * slope
            # a bucket's share of the mean is small, so its vector moves by the share's root
            vectors[buckets] -= step * np.sqrt(share)[:, None] * back
    return Model(langs, (vectors @ weights).astype(np.float32), bias)


def calibrate(model: Model, rows: list[tuple[str, np.ndarray, np.ndarray]]) -> Model:
    """The temperature with the lowest log loss on rows that training did not see."""
    index = {lang: i for i, lang in enumerate(model.langs)}
    rows = [r for r in rows if r[0] in index and len(r[1])]
    if not rows:
        return model
    logits = np.array([(c / c.sum()) @ model.table[b] + model.bias for _, b, c in rows])
    truth = np.array([index[r[0]] for r in rows])

    # as in Platt scaling, targets stop short of certainty by what so many rows can tell
    doubt = 1 / (len(truth) + 2)
    wanted = np.full(logits.shape, doubt / max(1, len(model.langs) - 1))
    wanted[np.arange(len(truth)), truth] = 1 - doubt

    def loss(t: float) -> float:
        return float(-(wanted * np.log(softmax(logits / t) + 1e-12)).sum(axis=1).mean())

    model.temperature = min(np.geomspace(0.05, 20, 60), key=loss)
    return model


def fit(docs: DataFrame, bits: int = BITS, per_lang: int = FIT_PER_LANG, fit_rows: int = FIT_ROWS) -> Model:
    """A model of the labelled rows that are not held out, from a sample of at most about ``per_lang`` each."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    counts = rows.groupBy("lang").count().orderBy("lang").collect()
    if not counts:
        return Model([], np.zeros((1 << bits, 0), np.float32), np.zeros(0, np.float32))
    # 32 rows of a language are drawn at least, so that none of them goes without
    per_lang = min(per_lang, max(32, fit_rows // len(counts)))
    # a row is in the sample when its hash is below its language's share
    share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, per_lang / r["count"])))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where(draw < F.try_element_at(share, F.col("lang")))
    found = (
        sample.mapInArrow(lambda b: features(b, bits), "doc_id long, lang string, buckets binary, counts binary")
        .toPandas()
        .sort_values(["doc_id", "lang"])
    )
    parts = {True: [], False: []}
    for r in found.itertuples(index=False):
        doc_id = None if r.doc_id != r.doc_id else int(r.doc_id)
        row = (r.lang, np.frombuffer(r.buckets, "<u4"), np.frombuffer(r.counts, "<f4"))
        parts[fold_of(doc_id) == CALIBRATION_FOLD].append(row)
    if not parts[False]:
        parts[False] = parts[True]
    return calibrate(train(parts[False], bits), parts[True])


def predicted(text, letters: np.ndarray, model: Model, bits: int = BITS) -> tuple[list[str], np.ndarray]:
    """(language, score) of the texts of an Arrow column, whole."""
    names = model.langs
    data, at = column_bytes(text)
    n = len(at) - 1
    if not names:
        return ["und"] * n, np.zeros(n)
    sums, counts = np.zeros((n, len(names)), np.float64), np.zeros(n, np.float64)
    for first, last, block, starts, limit in blocks(data, at):
        where, buckets = grams(block, bits)
        if limit < len(block):
            where, buckets = where[where < limit], buckets[where < limit]
        owner = np.searchsorted(starts, where, side="right") - 1
        size = last - first
        counts[first:last] += np.bincount(owner, minlength=size)
        for k in range(len(names)):
            sums[first:last, k] += np.bincount(owner, model.table[:, k][buckets], minlength=size)
    p = model.probabilities(sums, counts)
    best = p.argmax(axis=1)
    return [names[b] if k else "und" for b, k in zip(best, letters)], np.where(letters, p.max(axis=1), 0.0)


def scored(batches, model: Model, bits: int = BITS):
    """(doc_id, lang_pred, score) of every row."""
    for batch in in_parts(batches):
        letters = np.array(batch.column("letters").to_pylist(), bool)
        langs, score = predicted(batch.column("text"), letters, model, bits)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(score, pa.float64())],
            names=["doc_id", "lang_pred", "score"],
        )


def filtered(batches, text: int, model: Model, bits: int, reject: float):
    """The rows, as they are, that are not rejected; ``letters`` is the last column, the one of number ``text`` the text."""
    for batch in in_parts(batches):
        n = batch.num_columns
        letters = np.array(batch.column(n - 1).to_pylist(), bool)
        _, score = predicted(batch.column(text), letters, model, bits)
        yield batch.select(list(range(n - 1))).filter(pa.array(score >= reject))


def blocks(data: np.ndarray, at: np.ndarray):
    """Runs of texts of about BLOCK bytes, each text set between spaces: (first, last, bytes, starts, limit).

    A text longer than a block is cut into blocks that overlap by the bytes an n-gram may need; only n-grams that start
    before ``limit`` count.
    """
    first, n = 0, len(at) - 1
    reach = max(SIZES)
    while first < n:
        if at[first + 1] - at[first] > BLOCK:
            whole = framed(data[at[first] : at[first + 1]].tobytes())
            for start in range(0, len(whole), BLOCK):
                yield first, first + 1, whole[start : start + BLOCK + reach - 1], np.zeros(1, np.int64), BLOCK
            first += 1
            continue
        last = int(np.searchsorted(at, at[first] + BLOCK, side="right")) - 1
        last = max(last, first + 1)
        sizes = np.diff(at[first : last + 1])
        # two spaces between neighbours keep n-grams from crossing and give each text both its ends
        starts = at[first:last] - at[first] + 2 * np.arange(last - first)
        block = np.full(int(sizes.sum() + 2 * len(sizes)), 32, np.uint8)
        target = np.repeat(starts + 1 - (at[first:last] - at[first]), sizes) + np.arange(int(sizes.sum()))
        block[target] = data[at[first] : at[last]]
        yield first, last, block, starts, len(block)
        first = last


def identify(docs: DataFrame, model: Model | None = None, bits: int = BITS, reject: float = REJECT) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""
    model = fit(docs, bits) if model is None else model
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    found = rows.mapInArrow(lambda b: scored(b, model, bits), "doc_id long, lang_pred string, score double")
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        "score",
        (F.col("score") < reject).alias("rejected"),
    )


def accepted(docs: DataFrame, model: Model | None = None, bits: int = BITS, reject: float = REJECT) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    model = fit(docs, bits) if model is None else model
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*[F.col(f"`{c}`") for c in docs.columns], letters)
    rows = rows.toDF(*[f"c{i}" for i in range(len(docs.columns) + 1)])
    text = [c.lower() for c in docs.columns].index("text")
    kept = T.StructType([T.StructField(f"c{i}", f.dataType, True) for i, f in enumerate(docs.schema.fields)])
    return rows.mapInArrow(lambda b: filtered(b, text, model, bits, reject), kept).toDF(*docs.columns)
