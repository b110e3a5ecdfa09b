"""Near duplicates: alignment, sketches, components, and whole runs against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from engage.llm import near_dedup as op
from engage.llm.components import components


def distance(x, y):
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        new = [i]
        for j, b in enumerate(y, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return row[-1]


def changed(rng, words, rate, vocabulary):
    out = []
    for w in words:
        draw = rng.random()
        if draw < rate / 3:
            continue
        out.append(rng.choice(vocabulary) if draw < 2 * rate / 3 else w)
        if draw > 1 - rate / 3:
            out.append(rng.choice(vocabulary))
    return out


def test_banded_alignment_equals_the_full_table():
    rng = random.Random(1)
    pairs, want = [], []
    for _ in range(400):
        x = [rng.randint(0, 20) for _ in range(rng.randint(0, 50))]
        y = changed(rng, x, rng.random() * 0.5, range(21))
        pairs.append((np.array(x, np.uint32), np.array(y, np.uint32)))
        want.append(distance(x, y) <= op.allowed(np.int64(max(len(x), len(y))), 0.8))
    assert op.similar(pairs).tolist() == want


def test_repeats_do_not_change_first_occurrences():
    x = np.arange(50, dtype=np.uint32)
    y = np.concatenate([x, x[:10]])
    assert set(op.kmers(x).tolist()) <= set(op.kmers(y).tolist())


@pytest.mark.parametrize("n, edits", [(5, 1), (8, 1), (10, 1), (10, 2), (15, 3), (20, 4), (30, 6), (60, 12), (75, 15), (76, 15), (120, 24), (200, 40), (1000, 200)])
def test_entries_meet_at_the_threshold(n, edits):
    """The largest number of changed words that the similarity allows."""
    rng = random.Random(n)
    kinds, met = op.drawn(op.K, op.ENTRIES), 0
    for _ in range(200):
        x = [rng.randrange(20_000) for _ in range(n)]
        y = list(x)
        for at in rng.sample(range(n), edits):
            y[at] = 20_000 + rng.randrange(20_000)
        x, y = np.array(x, np.uint32), np.array(y, np.uint32)
        assert op.similar([(x, y)]).all()
        met += bool(set(op.entries_of(x, kinds).tolist()) & set(op.entries_of(y, kinds).tolist()))
    assert met >= 180


def test_every_linkable_length_has_entries():
    kinds = op.drawn(op.K, op.ENTRIES)
    sizes = [len(op.entries_of(np.arange(n, dtype=np.uint32), kinds)) for n in range(80)]
    assert sizes[:4] == [0] * 4 and all(sizes[4:])
    # "a b c d" and "a b c d e" reach 0.8, no text of three words reaches it with another
    assert op.similar([(np.arange(4, dtype=np.uint32), np.arange(5, dtype=np.uint32))]).all()


def test_sketches_meet_at_the_similarity():
    rng = random.Random(3)
    factors, shifts = op.seeds(op.ENTRIES)
    met = 0
    for _ in range(100):
        x = [rng.randrange(5000) for _ in range(300)]
        y = changed(rng, x, 0.1, range(5000))
        a, b = (set(op.sketch(np.array(z, np.uint32), 5, 2, factors, shifts).tolist()) for z in (x, y))
        met += bool(a & b)
    assert met >= 98


def test_long_texts_are_sketched_in_blocks():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 3 * op.BLOCK + 5, dtype=np.uint64)
    factors, shifts = op.seeds(4)
    keys = (values * factors + shifts) >> np.uint64(32)
    want = np.sort(np.argsort(keys, axis=1, kind="stable")[:, :2], axis=1)
    assert (op.smallest(values, 2, factors, shifts) == want).all()


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    links += [(600, i) for i in range(601, 700)]
    parent = {n: n for link in links for n in link}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(n, root(n)) for link in links if link[0] != link[1] for n in link}


def expected(rows):
    words = {i: (t or "").split() for i, t in rows}
    ids = sorted(words)
    parent = {i: i for i in ids}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in ids:
        for b in ids:
            x, y = words[a], words[b]
            longer = max(len(x), len(y))
            if a < b and min(len(x), len(y)) >= 0.8 * longer and (x == y or distance(x, y) <= 0.2 * longer):
                r, s = root(a), root(b)
                parent[max(r, s)] = min(r, s)
    return {i: root(i) for i in ids}


def corpus(copies):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(900)]
    rows = []
    passage = [rng.choice(vocabulary) for _ in range(20)]
    for base in range(4):
        words = [rng.choice(vocabulary) for _ in range(60)]
        rows.append(words)
        rows += [changed(rng, words, 0.05, vocabulary) for _ in range(copies)]
    # different texts around one passage
    rows += [passage + [rng.choice(vocabulary) for _ in range(25)] for _ in range(copies)]
    rows = [(10 + i, " ".join(w)) for i, w in enumerate(rows)]
    return rows + [(1, ""), (2, None), (3, "one"), (4, "one"), (5, "one two")]


@pytest.mark.parametrize("paired", [op.PAIRED, 2])
def test_groups_equal_brute_force(documents, paired):
    rows = corpus(8)
    got = op.near_dedup(documents(rows), paired=paired).collect()
    want = expected(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("block", [op.BLOCK_ROWS, 50])
def test_near_copies_around_a_common_passage(documents, block):
    rng = random.Random(14)
    vocabulary = [f"w{i}" for i in range(20_000)]
    passage = [rng.choice(vocabulary) for _ in range(140)]
    rows = [passage + [rng.choice(vocabulary) for _ in range(60)] for _ in range(300)]
    # copies that differ from their text in 36 of 200 words, most of them in the passage, and near no other text
    spots = [sorted(rng.sample(range(140), 30)) + sorted(rng.sample(range(140, 200), 6)) for _ in range(40)]
    for base, places in enumerate(spots):
        words = list(rows[base])
        for at in places:
            words[at] = rng.choice(vocabulary)
        rows.append(words)
    got = {r["doc_id"]: r["component_id"] for r in op.near_dedup(documents([(i, " ".join(w)) for i, w in enumerate(rows)]), block=block).collect()}
    factors, shifts = op.seeds(op.ENTRIES)
    words = [np.frombuffer(b"".join(map(op.WordHashes().__getitem__, " ".join(w).encode().split())), "<u4") for w in rows]
    sketches = [set(op.sketch(w, op.K, op.PER_ENTRY, factors, shifts).tolist()) for w in words]
    meet = [(a, 300 + a) for a in range(40) if sketches[a] & sketches[300 + a]]
    assert len(meet) >= 15
    assert all(got[a] == got[b] == a for a, b in meet)
    assert [i for i in range(40, 300) if got[i] != i] == []


def test_short_texts_with_a_changed_word(documents):
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(20_000)]
    rows = []
    for base in range(60):
        words = [rng.choice(vocabulary) for _ in range(10 + base % 40)]
        near = list(words)
        near[len(words) // 2] = "changed"
        rows += [(2 * base, " ".join(words)), (2 * base + 1, " ".join(near))]
    got = {r["doc_id"]: r["component_id"] for r in op.near_dedup(documents(rows)).collect()}
    assert got == expected(rows)


def test_words_whose_checksums_agree_are_different_texts(documents):
    # a fixed pair of words with the same CRC-32
    assert op.WordHashes()[b"plumless"] == op.WordHashes()[b"buckeroo"]
    got = op.near_dedup(documents([(1, "plumless"), (2, "buckeroo"), (3, "plumless ")])).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {1: 1, 2: 2, 3: 1}


def test_special_rows(documents):
    rows = [(1, "a b c d e f g h i j"), (1, "a b c d e f g h i j"), (None, "a b c d e f g h i j"), (None, "q r s")]
    got = sorted([(r["doc_id"], r["component_id"], r["kept"]) for r in op.near_dedup(documents(rows)).collect()], key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (None, 1, False), (None, None, True)], key=str)
    assert op.near_dedup(documents([])).collect() == []


def test_similar_texts_share_one_of_their_rarest_words():
    rng = random.Random(31)
    vocabulary = range(400)
    texts = []
    for _ in range(60):
        x = [rng.randrange(400) for _ in range(rng.randint(5, 90))]
        texts += [x, changed(rng, x, 0.15, vocabulary) or x, x[: -(-len(x) * 4 // 5)]]
    texts = [np.array(x, np.uint32) for x in texts]
    counts = np.zeros(1 << op.RARE_BITS, np.int64)
    for x in texts:
        np.add.at(counts, op.rare_bins(x)[1], 1)
    tokens = [set(op.rarest(x, counts, 0.8).tolist()) for x in texts]
    pairs = [(a, b) for a in range(len(texts)) for b in range(a)]
    close = [p for p, near in zip(pairs, op.similar([(texts[a], texts[b]) for a, b in pairs]), strict=True) if near]
    assert len(close) > 60
    assert all(tokens[a] & tokens[b] for a, b in close)


def test_shards_find_the_pairs_of_a_token_in_blocks():
    rng = np.random.default_rng(5)
    rows = []
    for token, blocks, size in ((1, 1, 7), (2, 3, 40), (3, 2, 1), (4, 1, 60)):
        for at in range(size):
            block = at % blocks
            n, c, bins = 20 + at % 9, at % 4, rng.integers(0, 2, op.FINE_BINS).astype("u1").tobytes()
            rows += [(token, min(block, o), max(block, o), block, 100 * token + at, n, c, bins) for o in range(blocks)]
    names = ["token", "i", "j", "block", "id", "n_words", "c", "bins"]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    table = pa.table({name: [r[i] for r in rows] for i, name in enumerate(names)})
    got = set(zip(*op.meeting(table, 0.0).to_pydict().values()))
    facts = {r[4]: r for r in rows}
    want = set()
    for a, x in facts.items():
        for b, y in facts.items():
            change = np.frombuffer(x[7], "u1").astype(int) - np.frombuffer(y[7], "u1")
            least = max(np.maximum(change, 0).sum(), np.maximum(-change, 0).sum())
            if a < b and x[0] == y[0] and x[6] != y[6] and least <= max(x[5], y[5]):
                want.add((a, b))
    assert got == want
    assert op.meeting(table.slice(0, 1), 0.8).num_rows == 0


def test_texts_around_a_long_common_tail_are_told_apart_in_the_shard():
    """Few of the pairs that the words rule out leave the shard, and none that they do not."""
    rng = random.Random(17)
    tail, common = [7, 9] * 95, range(100, 500)
    texts = [np.array([rng.choice(common) for _ in range(60)] + tail, np.uint32) for _ in range(120)]
    counts = np.full(1 << op.RARE_BITS, 2, np.int64)
    batch = pa.RecordBatch.from_pydict({"id": list(range(120)), "words": [t.tobytes() for t in texts]})
    facts = [r for b in op.prefixed([batch], counts, 0.8) for r in b.to_pylist()]
    shards = [[], [], [], []]
    for f in facts:
        for token in f["tokens"]:
            row = {"token": token, "i": 0, "j": 0, "block": 0, "id": f["id"], "n_words": f["n_words"], "c": f["id"], "bins": f["bins"]}
            shards[token % 4].append(row)
    made = [pair for rows in shards for pair in zip(*op.meeting(pa.Table.from_pylist(rows), 0.8).to_pydict().values())]
    got = set(made)
    limit = int(op.allowed(np.int64(250), 0.8))
    least = {(a, b): op.least_distance(texts[a], texts[b]) for b in range(120) for a in range(b)}
    want = {pair for pair, d in least.items() if d <= limit}
    assert 0 < len(want) < 0.5 * len(least)
    # each pair that shares a token at all leaves one shard
    share = {(a, b) for a, b in want if set(facts[a]["tokens"]) & set(facts[b]["tokens"])}
    assert share <= got and len(got) <= 1.3 * len(want)
    assert len(made) <= 1.05 * len(got)


def test_one_long_pair_does_not_widen_all_others():
    short, long = np.arange(10), np.arange(20_000)
    pairs = [(0, short, short, 0)] * 5000 + [(0, long, long, 0)]
    parts = list(op.portions(pairs, 8))
    assert sum(map(len, parts)) == 5001
    assert all(len(p) * max(len(x[1]) for x in p) <= max(op.PADDED, 20_000) for p in parts)


def test_words_of_texts_of_unfit_lengths_are_left_out(spark):
    # per token: unfit lengths; connected; the widest fit; a chain whose ends do not fit, and one far text
    rows = [(1, 1, 100, 1), (1, 2, 200, 2), (1, 3, 900, 3), (2, 1, 100, 1), (2, 4, 101, 1), (3, 5, 80, 5), (3, 6, 100, 6)]
    rows += [(4, 7, 70, 7), (4, 8, 85, 8), (4, 9, 100, 9), (4, 3, 900, 3)]
    tokens = op.in_bands(spark.createDataFrame(rows, "token long, id long, n_words long, c long"), 0.8)
    kept = tokens.join(op.apart_by(tokens), ["token", "band"])
    assert {(r["token"], r["id"]) for r in kept.collect()} == {(3, 5), (3, 6), (4, 7), (4, 8), (4, 9)}
    assert {(r["token"], r["rows"]) for r in kept.collect()} == {(3, 2), (4, 3)}


@pytest.mark.parametrize("similarity", [0.5, 0.8, 0.9, 1.0])
def test_lengths_that_fit_are_within_reach(spark, similarity):
    longer = list(range(1, 3000)) + [10**6, 12_500_000]
    pairs = [(n, n - int(op.allowed(n, similarity))) for n in longer]
    lengths = spark.createDataFrame([(n,) for p in pairs for n in p if n], "n_words long").distinct()
    band = {r["n_words"]: r["band"] for r in op.in_bands(lengths, similarity).collect()}
    assert all(0 <= band[a] - band[b] <= op.BANDS for a, b in pairs if b)
