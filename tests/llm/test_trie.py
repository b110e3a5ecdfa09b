"""The prefix trie against its definition, at several shard sizes."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from engage.llm import prefix_trie as op

TURNS = "conv_id long, turn long, role string, text string, node string, shard string, side string"


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, digest), (role, text)))
    turns = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + turns[c][h:])
    nodes = {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            nodes.setdefault(path[:d], []).append(c)
    kids, under = {}, {}
    for key in nodes:
        if key:
            kids.setdefault(key[:-1], []).append(key)
        for d in range(len(key) + 1):
            under.setdefault(key[:d], []).append(key)
    out = []
    for key, convs in nodes.items():
        saved = sum((len(nodes[k]) - 1) * (len(k[-1][1].split()) if k else 0) for k in under[key])
        ends = ",".join(map(str, sorted(c for c in convs if built[c] == key)))
        out.append(
            (
                min(convs), len(key), min(nodes[key[:-1]]) if key else None, len(convs), len(kids.get(key, [])),
                sum(1 for k in under[key] if k not in kids), saved, hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], TURNS)


def rows():
    rng = random.Random(3)
    found = []
    for c in range(120):
        shared = rng.random() < 0.4
        for t in range(rng.randint(1, 7)):
            text = f"turn {t} of all" if shared and t < 4 else f"{rng.choice('ab')} word {rng.randint(0, 2)}"
            found.append((c, t, rng.choice(["user", "assistant"]) if not shared else "user", text))
    same = [(c, t, "user", f"the same {t}") for c in range(200, 400) for t in range(5)]
    odd = [(500, None, "user", "first"), (500, 1, None, None), (500, 1, None, None), (500, 1, "user", "tie"), (500, 1, "a", "tie")]
    odd += [(None, 1, "user", "nobody's"), (-7, 0, "user", "before zero"), (-20, 0, "user", "base"), (701, 0, "u", "only"), (702, 0, "u", "only")]
    return found + same + odd + [(900, t, "user", f"long {t}") for t in range(700)]


@pytest.mark.parametrize("shard_turns", [op.SHARD_TURNS, 400, 40])
def test_equals_the_definition(spark, shard_turns):
    data = rows()
    got = op.digest(op.prefix_trie(op.rebuilt(table(spark, data)), shard_turns)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(data)


def test_empty_table_and_turnless_conversations(spark):
    assert op.prefix_trie(op.rebuilt(table(spark, []))).collect() == []
    # the heads of 1 and 3 are taken from conversation 0, which is absent
    few = [(c, 0, "user", "x") for c in (1, 2, 3, 5)]
    got = op.digest(op.prefix_trie(op.rebuilt(table(spark, few))))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted([tuple(r) for r in got.select(*columns).collect()], key=str) == brute(few)


def test_closing_parentheses():
    rng = random.Random(1)
    for n in (1, 2, 40, 700, 5000):
        bits, depth, left = [], 0, n
        while left or depth:
            if left and (depth == 0 or rng.random() < 0.55):
                bits.append(True)
                depth, left = depth + 1, left - 1
            else:
                bits.append(False)
                depth -= 1
        stack, want = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                want[stack.pop()] = i
        opens = np.flatnonzero(bits)
        assert op.Parentheses(np.array(bits)).close_of(opens).tolist() == [want[i] for i in opens.tolist()]


def test_least_between():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1000, 300)
    low = rng.integers(0, 299, 500)
    high = low + 1 + (rng.random(500) * (300 - low - 1)).astype(int)
    assert op.least_between(values, low, high).tolist() == [values[a:b].min() for a, b in zip(low, high)]
