"""Packing: exact ids, gapless sequences, little padding."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from engage.llm import packing as op

PIECES = ["a", "B", "'s", "'re", " ", "\n", "\x0b", "\x1c", "\x85", "\xa0", "é", "é", "ß", "İ", "Σ", "ﬁ", "9", "½", "$", "$$$", "…", "<|endoftext|>", "<|", "中文", "\x00", "d", "ǅ"]


def test_ids_by_word_equal_ids_of_the_text():
    path = op.default_tokenizer()
    words, whole = op.Words(path), Tokenizer.from_file(path)
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))
        ids = np.frombuffer(words.ids([text])[0], words.kind).tolist()
        assert ids == whole.encode(text, add_special_tokens=False).ids, text


def test_ids_of_runs_equal_ids_of_the_texts(monkeypatch):
    path = op.default_tokenizer()
    words, whole = op.Words(path), Tokenizer.from_file(path)
    rng = random.Random(7)
    letters = ["́", "̈", "q", "z0", "0", "'", "''s", "ǆ", "ΑΣ", "Ⅷ", "٣", " ", "\r\n", "-", "_", "o'clock", "<|startoftext|>"]
    texts = ["".join(rng.choice(PIECES + letters) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    # 40 bytes a run cut nearly every text in pieces; 7 parts a call try every border between parts
    for run, parts in ((8 << 20, 2048), (40, 2048), (8 << 20, 7)):
        monkeypatch.setattr(op, "RUN_BYTES", run)
        monkeypatch.setattr(op, "PARTS_AT_ONCE", parts)
        got = words.ids(texts if run > 40 else texts[:400])
        assert [np.frombuffer(x, words.kind).tolist() for x in got] == want[: len(got)]


def check(rows, pieces, capacity):
    whole = Tokenizer.from_file(op.default_tokenizer())
    want = sorted([(i, [*whole.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in rows], key=str)
    sequences, ids = {}, {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        ids.setdefault(p["doc_id"], []).append(p)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for i, tokens in want:
        if sum(1 for j, _ in want if j == i) > 1:
            continue
        at = 0
        for p in sorted(ids[i], key=lambda p: p["start"]):
            part = tokens[p["start"] : p["start"] + p["length"]]
            assert p["start"] == at and p["doc_tokens"] == len(tokens)
            assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p["length"]
        assert at == len(tokens)
    total = sum(len(t) for _, t in want)
    assert sum(p["length"] for p in pieces) == total
    return total, len(sequences)


@pytest.mark.parametrize("shard_bytes", [op.SHARD_BYTES, 20_000])
def test_round_trip(documents, shard_bytes):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["of", "the", "Word$", "été,", "x9"]) for _ in range(rng.choice([0, 3, 40, 900])))) for i in range(90)]
    rows += [(200, None), (201, ""), (202, "word " * 30_000), (203, "same"), (203, "same"), (None, "no id")]
    pieces = op.packed(documents(rows), op.default_tokenizer(), capacity=512, shard_bytes=shard_bytes).collect()
    total, sequences = check(rows, pieces, 512)
    if shard_bytes == op.SHARD_BYTES:
        assert sequences == -(-total // 512)


def test_costs_are_balanced():
    rng = random.Random(3)
    lengths = [rng.randint(1, 900) for _ in range(4000)]
    cost = {}
    for _, _, n, s, _ in op.pack(lengths, 4096):
        cost[s] = cost.get(s, 0) + op.cost_of(n)
    values = np.array(list(cost.values()))
    assert values.std() / values.mean() < 0.1


def test_empty_table(documents):
    assert op.packed(documents([]), op.default_tokenizer()).collect() == []
