"""Chunking, nearest chunks and prompts."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from engage.operators import nearest, rag, score, subwords
from engage.plans import jobs, retrieval
from engage.session import shared_dir
from tests.conftest import as_set


@pytest.mark.parametrize("n, windows", [(0, 0), (1, 1), (128, 1), (129, 2), (224, 2), (225, 3), (1000, 11)])
def test_windows(spark, n, windows):
    words = [f"w{i}" for i in range(n)]
    df = spark.createDataFrame([(1, "  " + " \n\t".join(words) + " ")], "doc_id long, text string")
    rows = rag.chunk(df).orderBy("chunk_ix").collect()
    assert len(rows) == windows
    for r in rows:
        start = r["chunk_ix"] * 96
        assert r["chunked_text"].split(" ") == words[start : start + 128]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text("ab \n", max_size=40), min_size=1, max_size=5), st.integers(1, 6), st.data())
def test_windows_cover_every_token(spark, texts, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = rag.chunk(df, size=size, overlap=overlap).orderBy("doc_id", "chunk_ix").collect()
    for i, text in enumerate(texts):
        rebuilt = []
        for r in rows:
            if r["doc_id"] == i:
                toks = r["chunked_text"].split(" ")
                assert 0 < len(toks) <= size
                rebuilt = rebuilt[: r["chunk_ix"] * (size - overlap)] + toks
        assert rebuilt == text.split()


def test_chunk_ids_are_stable(spark):
    df = spark.createDataFrame([(i, "a b c") for i in range(50)], "doc_id long, text string")
    assert as_set(rag.chunk(df)) == as_set(rag.chunk(df.repartition(9)))


ODD = ["", None, "a", "über naïve café", "日本語のテキスト " * 40, "e\u0301" * 90, "<|endoftext|> plain <|endoftext|>", " \n\t x  ", "word " * 500, "🙂🙃" * 80]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("size, overlap", [(128, 0), (128, 32), (5, 2)])
def test_subword_windows_lie_in_the_text(spark, name, size, overlap):
    tokenizers = pytest.importorskip("public_tokenizers")
    vocabulary = open(tokenizers.path(name)).read()
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string").repartition(2)
    rows = subwords.subword_windows(df, vocabulary, size=size, overlap=overlap).orderBy("doc_id", "chunk_ix").collect()
    for i, text in enumerate(ODD):
        own = [r for r in rows if r["doc_id"] == i]
        assert all(text[r["start"] : r["end"]] == r["chunked_text"] and 0 < r["n_tokens"] <= size for r in own)
        if not text:
            assert own == []
            continue
        assert own[0]["start"] == 0 and own[-1]["end"] == len(text)
        # all but the last are full, and without overlap they are the text
        assert all(r["n_tokens"] == size for r in own[:-1])
        assert all(b["start"] <= a["end"] for a, b in zip(own, own[1:]))
        if not overlap:
            assert "".join(r["chunked_text"] for r in own) == text


def test_windows_are_held_against_the_text_beside_them(spark):
    texts = [t for t in ODD if t] + ["ascii only " * 30]
    rows = [(t, a, min(a + 7, len(t)), t[a : a + 7]) for t in texts for a in range(0, len(t), 50)]
    rows += [(t, a + 1, b + 1, c) for t, a, b, c in rows if t[a + 1 : b + 1] != c]
    df = spark.createDataFrame(rows, "text string, start long, end long, piece string")
    cells, there = subwords.in_place(*map(F.col, df.columns))
    got = df.withColumn("cells", cells).withColumn("there", there).collect()
    assert all(r["there"] == (r["text"][r["start"] : r["end"]] == r["piece"]) for r in got)
    assert {r["there"] for r in got} == {True, False}


def test_chunk_subwords_moves_no_text(spark):
    plan = retrieval.chunk_subwords(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    # what a text is made into is made once, before its windows become rows
    assert plan.index("Generate") < plan.index("UTF-32", plan.index("Generate"))


def test_subword_windows_follow_the_whitespace_rule():
    for n in range(0, 400):
        found = subwords.windows_of(n, 128, 32)
        assert len(found) == (0 if n == 0 else 1 + max(0, -(-(n - 128) // 96)))
        assert not found or found[-1][1] == n


def brute(q, c, k, skip):
    unit = lambda m: m / np.where(np.linalg.norm(m, axis=1, keepdims=True) == 0, 1, np.linalg.norm(m, axis=1, keepdims=True))
    sims = np.round(unit(q) @ unit(c).T, 9)
    out = set()
    for i in range(len(q)):
        best = sorted((-s, j) for j, s in enumerate(sims[i]) if not (skip and i == j))[:k]
        out |= {(i, rank, j) for rank, (_, j) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("skip", [False, True])
@pytest.mark.parametrize("kind", ["spread", "clustered", "copies"])
def test_top_k_both_ways_equal_brute_force(spark, kind, skip):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 8))
    if kind == "clustered":
        base = rng.normal(size=(6, 8))[rng.integers(0, 6, 300)] * 5 + base * 0.1
    if kind == "copies":
        base[:120] = base[0]
        base[130] = 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "id long, embedding array<double>").repartition(4)
    q, c = df.withColumnRenamed("id", "query_id"), df.withColumnRenamed("id", "chunk_id")
    want = brute(base, base, 3, skip)
    few = rag.top_k(q, c, 3, skip_self=skip)
    many = rag.top_k(q, c, 3, skip_self=skip, block_bytes=2000)
    assert as_set(few.select("query_id", "rank", "chunk_id")) == want
    assert as_set(many.select("query_id", "rank", "chunk_id")) == want
    path = shared_dir(spark, "index")
    nearest.build_index(c, path, cells=12, block_bytes=2000)
    found, looked = nearest.search_index(spark, path, q, 3, skip_self=skip, block_bytes=4000)
    assert as_set(found) == as_set(few)
    if kind == "clustered":
        assert looked.count() < 300 * 12 / 2


def test_top_k_with_fewer_chunks_than_k_and_with_none(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, embedding array<double>")
    c = spark.createDataFrame([(5, [1.0, 0.0]), (6, [0.0, 1.0])], "chunk_id long, embedding array<double>")
    assert as_set(rag.top_k(q, c, 3)) == {(1, 1, 5, 1.0), (1, 2, 6, 0.0)}
    assert rag.top_k(q, c.limit(0), 3).isEmpty() and rag.top_k(q.limit(0), c, 3).isEmpty()
    assert rag.top_k(q, c.limit(0), 3, block_bytes=8).isEmpty()


def test_index_reads_few_cells_and_covers_odd_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(20, 6))[rng.integers(0, 20, 2000)] * 9 + rng.normal(size=(2000, 6)) * 0.05
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(3000, [0.0] * 6), (3001, [0.0] * 6), (3002, None)]
    rows += [(3003, [float("nan")] * 6)]
    c = spark.createDataFrame(rows, "chunk_id long, embedding array<double>").repartition(4)
    q = c.where("chunk_id in (5, 6, 3000, 3002, 3003)").withColumnRenamed("chunk_id", "query_id")
    path = shared_dir(spark, "index")
    nearest.build_index(c, path, cells=20)
    found, looked = nearest.search_index(spark, path, q.where("query_id < 10"), 3)
    assert as_set(found) == as_set(rag.top_k(q.where("query_id < 10"), c, 3))
    assert looked.count() <= 8
    found, _ = nearest.search_index(spark, path, q, 3)
    assert as_set(found) == as_set(rag.top_k(q, c, 3))


def test_plan_of_many_blocks_is_that_of_one(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "query_id long, embedding array<double>")
    c = df.withColumnRenamed("query_id", "chunk_id")
    nodes = [
        [line.split("(")[0].strip(" +-:*|") for line in rag.top_k(df, c, block_bytes=b)._jdf.queryExecution().optimizedPlan().toString().splitlines()]
        for b in (80, 1 << 20)
    ]
    assert len(nodes[0]) == len(nodes[1])


def test_many_blocks_of_a_table_are_read_and_not_written_for_each_other(spark, tmp_path):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(400, 6))
    base[:40], base[50] = base[0], 0
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    spark.createDataFrame(rows, "chunk_id long, embedding array<double>").repartition(8).write.parquet(str(tmp_path / "c"))
    c = spark.read.parquet(str(tmp_path / "c"))
    # an id that comes twice, and vectors that ask for nothing
    odd = [(3, rows[90][1]), (500, None), (501, []), (502, [float("nan")] * 6), (None, rows[1][1])]
    q = spark.createDataFrame(rows[:60] + odd, "query_id long, embedding array<double>")
    found = rag.top_k(q, c, 3, block_bytes=480)
    unit = nearest.unit_rows(base)
    wanted = {}
    for i, v in [(i, v) for i, v in rows[:60] + odd[:1]]:
        sims = np.round(nearest.unit_rows(np.array([v]))[0] @ unit.T, 9)
        wanted[i] = sorted(wanted.get(i, []) + [(-s, j) for j, s in enumerate(sims)])[:3]
    got = found.select("query_id", "rank", "chunk_id").orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(i, n, j) for i in range(60) for n, (_, j) in enumerate(wanted[i], 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    # the queries once, and the hits; no row is copied per block of the other side
    assert plan.count("Exchange") == 2 and "CartesianProduct" in plan and "Generate" not in plan


CHAT = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "why?"),
    (2, 0, "user", "alone"),
    (3, 0, "system", "be brief"), (3, 1, "user", "what?"),
]


def chat(spark):
    return spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string").repartition(3)


def test_split_and_history(spark):
    assert as_set(rag.split_chat(chat(spark))) == {(1, "why?", 3, 3), (2, "alone", 0, 0), (3, "what?", 1, 1)}
    assert as_set(rag.chat_history(chat(spark))) == {(1, 1, "user", "hi"), (1, 2, "assistant", "hello")}


def test_rewrite_branches(spark):
    rows = as_set(rag.rewrite_prompt(chat(spark), template="H={chat_history};Q={question}"))
    assert rows == {
        (1, -1, "rewrite", "system", "H="), (1, 1, "rewrite", "user", "hi"), (1, 2, "rewrite", "assistant", "hello"),
        (1, 3, "rewrite", "user", ";Q=why?"),
        (2, 0, "question", "user", "alone"),
        (3, -1, "rewrite", "system", "H="), (3, 1, "rewrite", "user", ";Q=what?"),
    }


def test_long_chats_have_the_same_shape(spark):
    rows = [(1, t, "user", f"m{t}") for t in range(2501)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    messages = rag.rewrite_prompt(df).orderBy("position").collect()
    assert [r["content"] for r in messages[1:-1]] == [f"m{t}" for t in range(2500)] and messages[0]["role"] == "system"


def test_context_and_prompt(spark):
    hits = spark.createDataFrame([(1, 2, 20, 0.5), (1, 1, 10, 0.9)], "query_id long, rank int, chunk_id long, similarity double")
    chunks = spark.createDataFrame([(10, "ten"), (20, "twenty")], "chunk_id long, chunked_text string")
    context = rag.context(hits, chunks)
    assert as_set(context) == {(1, "Passage: ten\nPassage: twenty\n")}
    got = as_set(rag.prompt(chat(spark), context, template="C:{context}").where("conv_id in (1, 2)"))
    assert got == {
        (1, -1, "system", "C:Passage: ten\nPassage: twenty\n"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
        (1, 3, "user", "why?"), (2, -1, "system", "C:"), (2, 0, "user", "alone"),
    }


def test_embedders(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "c d e")], "id int, text string")
    fitted = rag.embed(df, "text", rag.fit_embedder(df, "text", 32)).collect()
    assert all(len(r["embedding"]) == 32 and np.linalg.norm(r["embedding"]) == pytest.approx(1) for r in fitted)
    own = rag.embed(df, "text", lambda batch: [[float(len(t)), 1.0] for t in batch])
    assert {r["id"]: r["embedding"] for r in own.collect()} == {1: [3.0, 1.0], 2: [5.0, 1.0]}


def test_whole_chain_equals_brute_force(spark):
    docs = spark.createDataFrame(
        [(1, "claims and premiums"), (2, "hello why hello"), (3, "alone at last alone"), (4, "other words")], "doc_id long, text string"
    )
    chunks = rag.chunk(docs)
    embedder = rag.fit_embedder(chunks, "chunked_text", 64)
    asked = rag.split_chat(chat(spark)).select(F.col("conv_id").alias("query_id"), "question")
    questions = rag.embed(asked, "question", embedder)
    vectors = rag.embed(chunks, "chunked_text", embedder)
    q, c = questions.orderBy("query_id").collect(), vectors.orderBy("chunk_id").collect()
    want = set()
    for row in q:
        sims = sorted((-round(float(np.dot(row["embedding"], x["embedding"])), 9), x["chunk_id"]) for x in c)[:3]
        want |= {(row["query_id"], rank, chunk) for rank, (_, chunk) in enumerate(sims, 1)}
    got = rag.top_k(questions, vectors, 3)
    assert as_set(got.select("query_id", "rank", "chunk_id")) == want


def test_scorer_reports_failures(spark):
    def scorer(name, body):
        if not body:
            raise ValueError("empty")
        return f"/out/{name}"

    df = spark.createDataFrame([("a", "x"), ("b", "")], "transcript string, body string")
    rows = as_set(score.unpack(score.apply_scorer(df, scorer, "transcript", "body", "2024-01-01")).drop("body"))
    assert rows == {("a", "Success", None, "2024-01-01", "/out/a"), ("b", "Failed", "empty", "2024-01-01", None)}


def test_questions_are_embedded_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def embedder(texts):
        seen.add(len(texts))
        return [[float(len(t)), 1.0] for t in texts]

    chat = spark.createDataFrame([(1, 0, "user", "a bc"), (2, 0, "user", "d")], "conv_id long, turn long, role string, text string")
    index = spark.createDataFrame([(7, "x", [1.0, 0.0]), (8, "y", [0.0, 1.0])], "chunk_id long, chunked_text string, embedding array<double>")
    assert jobs.answer_prompts(chat, index, embedder, k=1).count() == 4
    assert seen.value == 2


def test_many_vectors_are_cut_into_blocks_for_every_core(spark):
    rows = nearest._vectors(spark.range(3 * nearest.LEAST_ROWS).select("id", F.array(F.lit(1.0)).alias("v")), "id", "v")
    assert nearest._n_blocks(rows, nearest.BLOCK_BYTES) == 3


@pytest.mark.parametrize("skip_self", [False, True])
def test_best_of_a_block_equals_sorting_all_with_copies_ties_and_odd_vectors(skip_self):
    rng = np.random.default_rng(3)
    for whole in (False, True):
        rows = rng.integers(0, 3, (5000, 6)).astype(float) if whole else rng.normal(size=(5000, 6))
        rows[100:400], rows[7], rows[8, 2] = rows[3], 0, np.nan
        ids, units = rng.permutation(9000)[:5000], nearest.unit_rows(rows)
        asked = np.r_[np.arange(12), np.arange(95, 105), np.arange(4000, 4300)]
        got = nearest._best(ids[asked], units[asked], ids, units, 3, skip_self, 9)
        sims = np.round(units[asked] @ units.T, 9)
        sims[np.isnan(sims)] = -np.inf
        if skip_self:
            sims[np.arange(len(asked)), asked] = -np.inf
        wanted = []
        for i, row in zip(ids[asked], sims):
            best = [j for j in np.lexsort((ids, -row))[:3] if np.isfinite(row[j])]
            wanted += [(i, ids[j], row[j]) for j in best]
        found = [tuple(r) for r in got.itertuples(index=False)]
        assert [f[:2] for f in sorted(found)] == [w[:2] for w in sorted(wanted)]
        assert max(abs(f[2] - w[2]) for f, w in zip(sorted(found), sorted(wanted))) < 2e-9
    # a large group of copies costs a few candidates, not all of them
    assert len(nearest._copies(np.arange(5000), np.ones((5000, 4)), 4)[0]) == 4


def test_a_query_is_sent_once_per_group_of_cells(spark):
    """Not once per cell; wide cells lie in several groups, and every wanted cell arrives once in each of its groups."""
    table = pd.DataFrame({"cell": [-1, 0, 1, 2, 3, 4, 5], "n": [1, 4, 4, 30, 4, 4, 4], "blocks": [1, 1, 1, 3, 1, 1, 1]})
    groups = nearest._groups(table, 4)
    assert groups.groupby("cell")["group"].nunique().to_dict() == {-1: 1, 0: 1, 1: 1, 2: 3, 3: 1, 4: 1, 5: 1}
    cells = {1: [0, 1, 5, -1], 2: [3], 3: [2, 4], 4: [5, 4, 3, 2, 1, 0, -1]}
    visits = spark.createDataFrame([(i, [float(i)], c) for i, c in cells.items()], "id long, v array<double>, cells array<int>")
    sent = nearest._by_group(visits, groups).collect()
    assert len({(r["id"], r["group"]) for r in sent}) == len(sent)
    assert all(r["v"] == [r["id"]] for r in sent)
    want = {(i, c, g) for i, own in cells.items() for c, g in zip(groups["cell"], groups["group"]) if c in own}
    got = [(r["id"], c, r["group"]) for r in sent for c in r["cells"]]
    assert set(got) == want and len(got) == len(want)
    # seven cells, but fewer groups with a row each
    assert sum(r["id"] == 4 for r in sent) == groups["group"].nunique() < len(groups)
