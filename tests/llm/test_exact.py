"""Exact duplicates: tries, spilling, and the defined results of special cases."""

import hashlib
import random
import re

from engage.llm import exact_dedup as op


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0))
    out = []
    for doc_id, text in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        _, none, best = min(groups[key])
        best = None if none else best
        out.append((doc_id, best, len(groups[key]), doc_id == best, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=str)


def rows():
    rng = random.Random(4)
    texts = ["", " ", "\t\n", "a", "a b", "ab", "aéb", "a éb ", "long " * 30_000, "x" * 50, "x" * 49 + "y", "x" * 50 + " "]
    found = [(i, rng.choice(texts)) for i in range(60)] + [(100, None), (101, None), (None, "ab"), (7, "ab"), (7, "ab")]
    return found


def test_equals_brute_force(documents):
    data = rows()
    got = op.exact_dedup(documents(data)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(data)


def test_collisions_and_spilling_change_nothing(documents):
    # two hash bits put nearly all texts into the same partitions; a small budget spills after almost every text
    data = rows()
    got = op.exact_dedup(documents(data), hash_bits=2, budget=2_000).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(data)


def test_empty_table(documents):
    assert op.exact_dedup(documents([])).collect() == []


def test_trie_keeps_the_best_of_each_string():
    rng = random.Random(2)
    trie, want = op.Patricia(), {}
    for i in range(2000):
        key = bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 9)))
        trie.insert(key, (rng.randint(0, 3), False, i), 1)
        best, n = want.get(key, (None, 0))
        new = next(b for k, b, _ in trie.drain() if k == key) if best is None else best
        want[key] = (new, n + 1)
    found = {k: n for k, _, n in trie.drain()}
    assert found == {k: n for k, (_, n) in want.items()}


def test_spill_cuts_whole_subtrees():
    trie = op.Patricia()
    keys = [b"abc", b"abd", b"ab", b"xyz", b""]
    for i, key in enumerate(keys):
        trie.insert(key, (0, False, i), 1)
    out = [k for k, _, _ in trie.spill()]
    rest = [k for k, _, _ in trie.drain()]
    assert sorted(out + rest) == sorted(keys) and out and rest
