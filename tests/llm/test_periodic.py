"""Periodic runs against their definition, at several segment lengths."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from engage.llm import periodic as op


def brute_runs(words):
    found, n = {}, len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def row_of(doc_id, words):
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)))


def texts():
    rng = random.Random(8)
    found = ["", "one", "ha " * 23, "ha " * 24, "x " * 200, "a b " * 12, "a b c " * 400 + "d " + "a b c " * 30]
    for letters in (1, 2, 3, 9):
        found += [" ".join(rng.choice("abcdefghi"[:letters]) for _ in range(rng.randint(20, 150))) for _ in range(4)]
    for _ in range(40):
        words = [f"w{rng.randrange(60)}" for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(1, 3)):
            q = rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 31, 33, 64, 100, 150])
            unit = [f"w{rng.randrange(60)}" for _ in range(q)]
            length = int(q * rng.choice([2, 2.9, 3, 3.1, 5, 9]))
            words += (unit * (length // q + 1))[:length]
            words += [f"w{rng.randrange(60)}" for _ in range(rng.randint(0, 40))]
        found.append(" \t".join(words))
    return found


def test_fragments_stitch_to_the_runs():
    for text in texts():
        words = text.split()
        for size in (64, 256, 1 << 16):
            codes, found = op.numbered([w.encode() for w in words]), []
            for first, last, base, part in op.segments(codes, size) if len(words) else ():
                found += [(q, a + base, b + base) for q, a, b in op.fragments(part, first, last)]
            got = sorted((a, b - a, q) for q, a, b in op.stitched(found) if b - a >= max(24, 3 * q))
            assert got == brute_runs(words), (size, text[:200])


def test_z_function():
    rng = random.Random(2)
    for _ in range(200):
        s = [rng.randrange(2) for _ in range(rng.randint(1, 30))]
        z = op.z_values(s, len(s))
        assert z[1:] == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(1, len(s))]


@pytest.mark.parametrize("segment", [op.SEGMENT_WORDS, 64])
def test_equals_the_definition(documents, segment):
    rows = list(enumerate(texts())) + [(900, None), (900, None), (None, "a b " * 40), (5, "a b " * 40), (5, "a b " * 40)]
    got = op.digest(op.periodic_runs(documents(rows), segment)).collect()
    want = [row_of(i, (t or "").split()) for i, t in rows]
    assert sorted([tuple(r) for r in got], key=str) == sorted(want, key=str)


def test_kept_text(documents):
    (row,) = op.periodic_runs(documents([(1, "start " + "a b c " * 10 + "end")])).collect()
    assert row["kept"] == b"start a b c end" and [tuple(r) for r in row["runs"]] == [(1, 30, 3)]


def test_continued_texts(documents):
    rows = [(i, " ".join(f"w{j}" for j in range(i % 50))) for i in range(300)] + [(None, "a b"), (301, None), (90, " x\ty\n")]
    got = sorted([(r["doc_id"], r["text"].split()) for r in op.with_runs(documents(rows)).collect()], key=str)
    want = []
    for i, text in rows:
        words = (text or "").split()
        h, n = zlib.crc32(str(i).encode()) if i is not None else 1, len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if j < a else words[a + (j - a) % p] for j, w in enumerate(words)]
        want.append((i, words))
    assert got == sorted(want, key=str)


def test_empty_table(documents):
    assert op.periodic_runs(documents([])).collect() == []


def test_hash_gate_keeps_every_boundary_of_a_run():
    codes = np.array(([*range(20)] * 9)[:170] + [99] * 5, np.int64)
    found = op.fragments(codes, 3, 5)
    assert (20, 0, 170) in op.stitched(found)
