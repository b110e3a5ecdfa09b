"""Vector near-dedup against all pairs."""

import numpy as np
import pytest

from engage.llm import embed_dedup as op

SCHEMA = "vec_id long, embedding array<float>, label int, size string, cells string"


def expected(rows):
    good = {}
    for i, v in rows:
        if v and all(c is not None for c in v) and np.isfinite(v).all() and any(v):
            good.setdefault(i, []).append(np.array(v, float))
    flat = [(i, v / np.linalg.norm(v)) for i, vs in good.items() for v in vs]
    links, parent = {i: 0 for i, _ in rows}, {i: i for i, _ in rows}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, (i, x) in enumerate(flat):
        for j, y in flat[a + 1 :]:
            if len(x) == len(y) and x @ y >= 0.9:
                links[i] += 1
                links[j] += 1
                r, s = root(i), root(j)
                parent[max(r, s)] = min(r, s)
    return {i: (links[i], root(i), root(i) == i) for i, _ in rows}


def vectors(n, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, 32))
    close = base[: n // 4] + 0.15 * rng.normal(size=(n // 4, 32))
    dense = base[0] + 0.1 * rng.normal(size=(n // 2, 32))
    whole = np.concatenate([base, close, dense, base[:5], 3 * base[5:8]]).astype(np.float32)
    return [(i, v.tolist()) for i, v in enumerate(whole)]


@pytest.mark.parametrize("settings", [{}, {"cell_rows": 16, "block": 32}])
def test_equals_all_pairs(spark, settings):
    rows = vectors(200, 3)
    extra = [None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] + [0.0] * 31, [None] + [1.0] * 31, [1.0, 0.0], [2.0, 0.1], [-0.0, 1.0], [0.0, 1.0]]
    rows += [(1000 + i, v) for i, v in enumerate(extra)]
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in op.embed_dedup(df, **settings).collect()}
    want = expected(rows)
    pairs = sum(w[0] for w in want.values())
    assert sum(g[0] for g in got.values()) >= 0.99 * pairs
    assert all(got[i][0] <= want[i][0] for i in want)
    if not settings:
        assert got == want


def test_empty_table(spark):
    assert op.embed_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("width, cells", [(64, 256), (64, 1024), (384, 1024)])
def test_pairs_at_the_threshold_share_a_cell(width, cells):
    rng = np.random.default_rng(width + cells)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    centres = op.centres_of(unit(rng.normal(size=(8 * cells, width))), cells, rounds=3)
    assert len(centres) > 0.9 * cells
    v = unit(rng.normal(size=(2000, width)))
    away = rng.normal(size=v.shape)
    away = unit(away - (away * v).sum(axis=1, keepdims=True) * v)
    cosine = rng.uniform(0.9, 0.92, (len(v), 1))
    u = cosine * v + np.sqrt(1 - cosine**2) * away
    near = [np.argsort(-(x @ centres.T), axis=1)[:, : op.PROBES] for x in (v, u)]
    met = (near[0][:, :, None] == near[1][:, None, :]).any(axis=(1, 2))
    assert met.mean() >= 0.995


def test_all_pairs_with_many_cells(spark):
    rows = vectors(900, 4)
    df = spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in op.embed_dedup(df, cell_rows=8).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = ((x @ x.T) >= 0.9).sum() - len(x)
    assert 0.999 * want <= sum(g[0] for g in got.values()) <= want
