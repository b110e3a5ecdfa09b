"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Equal vectors are one class from the start.  Spherical k-means on a bounded sample places centres; centres closer
than ``APART`` are merged, so that a dense group is not cut up.  Every class joins its ``PROBES`` nearest cells, and
classes that share a cell are compared: a cell is cut into blocks of about ``BLOCK`` rows, each pair of
blocks is one group, and its cosines are one matrix product in double precision.  A pair that shares several
cells counts in the first of them only.  A group answers with counts and one link per row, never with its pairs.

Recall is not exact by construction, because two vectors may share none of their nearest cells.  Of random pairs at
cosine 0.90 to 0.92, the hardest, in random vectors, which have no groups, 99.9 % or more share one of their ``PROBES``
at 256 and 1,024 cells, with 64 and 384 dimensions (tests/llm).  ``MAX_CELLS`` and ``FIT_ROWS`` bound the centres and
the sample.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do
vectors of different lengths; rows that share a vec_id count as one vector's rows; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from engage.llm.components import components
from engage.session import materialise

SIMILARITY = 0.9
CELL_ROWS = 256
MAX_CELLS = 2048
FIT_ROWS = 20_000
ROUNDS = 6
PROBES = 8
APART = 0.8
BLOCK = 1024
SEED = 11


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, key, size) with key the vector's doubles as bytes; rows that can link with nothing have a null key."""

    def keys(batches):
        for batch in batches:
            v = batch.column("v")
            sizes = pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False)
            at = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
            flat = pc.fill_null(v.flatten().cast(pa.float64()), np.nan)
            # -0.0 and 0.0 are one number
            x = flat.to_numpy(zero_copy_only=False) + 0.0
            total = lambda mask: np.diff(np.r_[0, np.cumsum(mask)][at])  # noqa: E731, B023
            good = (total(~np.isfinite(x)) == 0) & (total(x != 0) > 0)
            valid = pa.array(good.tolist(), pa.bool_()).buffers()[1]
            places = pa.py_buffer((at * 8).astype(np.int64))
            key = pa.Array.from_buffers(pa.large_binary(), len(good), [valid, places, pa.py_buffer(x.astype("<f8"))])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), key.cast(pa.binary())], names=["vec_id", "key"])

    return rows.mapInArrow(keys, "vec_id long, key binary")


def unit(keys) -> np.ndarray:
    x = np.frombuffer(b"".join(keys), "<f8").reshape(len(keys), -1)
    # scaled first, so that squares neither overflow nor vanish
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def centres_of(x: np.ndarray, k: int, rounds: int = ROUNDS, apart: float = APART, seed: int = SEED) -> np.ndarray:
    """Spherical k-means; centres closer than ``apart`` to an earlier one are left out."""
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]]
    for _ in range(rounds):
        own = np.concatenate([(x[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), centres)
    kept: list[int] = []
    for i in range(len(centres)):
        if not kept or (centres[kept] @ centres[i]).max() < apart:
            kept.append(i)
    return centres[kept]


def fit(classes: DataFrame, n: int, fit_rows: int, cell_rows: int, max_cells: int) -> dict[int, np.ndarray]:
    """Centres by vector length in bytes, from a sample of about ``fit_rows`` classes."""
    draw = F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    sample = classes.where(draw < min(1.0, fit_rows / max(n, 1))).select("key").toPandas()["key"]
    out = {}
    for size, keys in sample.groupby(sample.map(len)):
        share = len(keys) / len(sample)
        k = max(1, min(max_cells, math.ceil(n * share / cell_rows), len(keys)))
        out[int(size)] = centres_of(unit(sorted(map(bytes, keys))), k)
    return out


def celled(batches, centres: dict[int, np.ndarray], probes: int):
    """Every class with its nearest cells, in order of the cells' numbers."""
    for batch in batches:
        keys = batch.column("key").to_pylist()
        cells: list = [None] * len(keys)
        for size in {len(k) for k in keys}:
            rows = [i for i, k in enumerate(keys) if len(k) == size]
            if size not in centres:
                near = np.zeros((len(rows), 1), int)
            else:
                products = unit([keys[i] for i in rows]) @ centres[size].T
                near = np.sort(np.argsort(-products, axis=1, kind="stable")[:, :probes], axis=1)
            for i, own in zip(rows, near, strict=True):
                cells[i] = own.tolist()
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"]
        )


def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Per row, the smallest cell number that stands in both lists."""
    same = a[:, :, None] == b[:, None, :]
    return np.where(same.any(axis=2), a, np.iinfo(np.int32).max).min(axis=1)


def compare(group: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """Links between two blocks of a cell, or within one: per class with links, their number and the smallest linked id reached."""
    cell, i, j = (int(group[c].iloc[0]) for c in ("cell", "i", "j"))
    group = group.sort_values("id", kind="stable").reset_index(drop=True)
    ids, times = group["id"].to_numpy(np.int64), group["times"].to_numpy(np.int64)
    block = group["block"].to_numpy()
    x = unit(group["key"].tolist())
    cells = np.array(group["cells"].tolist(), np.int32)
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
    hits = []
    for start in range(0, len(left), 512):
        rows = left[start : start + 512]
        a, b = np.nonzero(x[rows] @ x[right].T >= similarity)
        hits.append((rows[a], right[b]))
    if hits:
        a, b = np.concatenate([h[0] for h in hits]), np.concatenate([h[1] for h in hits])
        keep = a < b if i == j else np.ones(len(a), bool)
        a, b = a[keep], b[keep]
        for s in range(0, len(a), 1 << 18):
            p, q = a[s : s + (1 << 18)], b[s : s + (1 << 18)]
            own = first_shared(cells[p], cells[q]) == cell
            np.add.at(links, p[own], times[q[own]])
            np.add.at(links, q[own], times[p[own]])
        while len(a):
            least = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, a, least)
            np.minimum.at(root, b, least)
            root = root[root]
            if (root == before).all():
                break
    linked = (links > 0) | (root != np.arange(len(ids)))
    return pd.DataFrame({"id": ids[linked], "links": links[linked], "root": ids[root[linked]]})


def embed_dedup(
    vectors: DataFrame,
    similarity: float = SIMILARITY,
    cell_rows: int = CELL_ROWS,
    max_cells: int = MAX_CELLS,
    fit_rows: int = FIT_ROWS,
    probes: int = PROBES,
    block: int = BLOCK,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = materialise(
        usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))), "vectors"
    )
    good = rows.where("key is not null and vec_id is not null")
    classes = materialise(
        good.groupBy("key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("times")), "classes"
    )
    n = classes.count()
    centres = fit(classes, n, fit_rows, cell_rows, max_cells)
    placed = classes.mapInArrow(
        lambda b: celled(b, centres, probes), "key binary, id long, times long, cells array<int>"
    ).select("*", F.explode("cells").alias("cell"), F.length("key").alias("size"))
    placed = materialise(placed, "cells")
    # one count per cell: at most max_cells of each vector length
    counts = placed.groupBy("size", "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = placed.join(counts, ["size", "cell"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.withColumn("other", other).select(
        "size", "cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "id", "times", "cells", "key",
    )
    found = materialise(
        dealt.groupBy("size", "cell", "i", "j").applyInPandas(
            lambda group: compare(group, similarity), "id long, links long, root long"
        ),
        "links",
    )
    totals = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = classes.join(totals, "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left")
    named = named.select(
        "key",
        (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    whole = rows.join(named, "key", "left")
    linked = F.col("vec_id").isNotNull()
    component = F.when(linked, F.coalesce("component_id", "vec_id"))
    return whole.select(
        "vec_id",
        F.when(linked, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
