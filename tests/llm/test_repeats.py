"""Suffix arrays and automata against counting every window."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from engage.llm import automaton_dedup, repeats, suffix_dedup


def marked(sequences, window):
    seen = Counter(tuple(s[i : i + window]) for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        removed = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i : i + window])] > 1:
                removed[i : i + window] = [True] * window
        out.append(removed)
    return out


@pytest.mark.parametrize("local", [suffix_dedup.repeated, automaton_dedup.repeated])
def test_local_index_equals_counting(local):
    rng = random.Random(3)
    for _ in range(200):
        window, letters = rng.choice([3, 5, 8]), rng.choice([1, 2, 4])
        parts = [[rng.randrange(letters) for _ in range(rng.randint(window, 40))] for _ in range(rng.randint(1, 6))]
        parts += parts[:1] * rng.randint(0, 1)
        seen = Counter(tuple(p[i : i + window]) for p in parts for i in range(len(p) - window + 1))
        want = [[seen[tuple(p[i : i + window])] > 1 for i in range(len(p) - window + 1)] for p in parts]
        kind = np.uint8 if local is suffix_dedup.repeated else np.uint64
        got = local([np.array(p, kind) for p in parts], [len(p) - window + 1 for p in parts], window)
        assert [g.tolist() for g in got] == want


def test_suffix_array_is_sorted_and_prefixes_are_exact():
    rng = np.random.default_rng(1)
    parts = [rng.integers(97, 99, rng.integers(1, 60)).astype(np.uint8) for _ in range(12)]
    array, text, ends = suffix_dedup.suffix_array(parts)
    suffixes = [text[i : ends[i]].tobytes() for i in array]
    assert suffixes == sorted(suffixes)
    lengths, before = suffix_dedup.common_prefixes(array, text, ends)
    for a, b in zip(array[:-1], array[1:]):
        x, y = text[a : ends[a]].tobytes(), text[b : ends[b]].tobytes()
        same = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert before[b] == a and lengths[b] == same


def test_pieces_cover_every_window_once_and_follow_content():
    rng = np.random.default_rng(2)
    symbols = rng.integers(0, 3, 4000).astype(np.uint8)
    _, firsts, sizes = repeats.pieces_of(symbols, 40, 8)
    assert firsts[0] == 0 and (firsts[1:] == firsts[:-1] + sizes[:-1]).all() and sizes.sum() == 4000 - 39
    anchors, first, size = repeats.pieces_of(symbols[100:], 40, 8)
    whole = dict(zip(firsts[2:-1].tolist(), repeats.pieces_of(symbols, 40, 8)[0][2:-1].tolist()))
    shifted = dict(zip((first + 100).tolist(), anchors.tolist()))
    assert all(whole[f] == shifted[f] for f in whole if f in shifted)


def corpus(words):
    rng = random.Random(6)
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for i in range(60):
        body = [rng.choice(words) for _ in range(rng.randint(0, 50))]
        if i % 2:
            body += passage[rng.randint(0, 9) : rng.randint(45, 60)] + [rng.choice(words) for _ in range(9)]
        rows.append((i, " ".join(body)))
    rows += [(100, rows[3][1]), (101, None), (102, ""), (103, "ab " * 9000), (104, rows[5][1]), (104, rows[5][1]), (None, rows[7][1])]
    return rows


@pytest.mark.parametrize("group", [None, 1])
def test_bytes_equal_brute_force(documents, group):
    rows = corpus(["alpha", "été", "of", "the"])
    spec = suffix_dedup.spec(window=60, gram=16, shard_bytes=4000, group=group)
    got = suffix_dedup.digest(suffix_dedup.suffix_dedup(documents(rows), spec)).collect()
    raw = [(t or "").encode() for _, t in rows]
    want = []
    for (i, _), b, removed in zip(rows, raw, marked(raw, 60)):
        kept = bytes(c for c, r in zip(b, removed) if not r)
        runs = sum(1 for j, r in enumerate(removed) if r and (j == 0 or not removed[j - 1]))
        want.append((i, len(b), sum(removed), runs, hashlib.sha256(kept).hexdigest()))
    assert sorted([tuple(r) for r in got], key=str) == sorted(want, key=str)


@pytest.mark.parametrize("group", [1000, 1])
def test_words_equal_brute_force(documents, group):
    rows = corpus(["alpha", "été", "of", "the"])
    spec = automaton_dedup.spec(window=12, gram=4, shard_words=500, group=group)
    got = automaton_dedup.digest(automaton_dedup.automaton_dedup(documents(rows), spec)).collect()
    raw = [(t or "").encode().split() for _, t in rows]
    want = []
    for (i, _), w, removed in zip(rows, raw, marked(raw, 12)):
        kept = b" ".join(c for c, r in zip(w, removed) if not r)
        want.append((i, len(w), sum(removed), hashlib.sha256(kept).hexdigest()))
    assert sorted([tuple(r) for r in got], key=str) == sorted(want, key=str)


def test_empty_tables(documents):
    assert suffix_dedup.suffix_dedup(documents([])).collect() == []
    assert automaton_dedup.automaton_dedup(documents([])).collect() == []
