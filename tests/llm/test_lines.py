"""Line deduplication: brute force, common lines, and the defined results of special cases."""

import hashlib
import random

import pytest

from engage.llm import line_dedup as op

WHITE = " \t\n\x0b\x0c\r"
FOLD = str.maketrans(op.UPPER, op.LOWER)


def brute(rows, min_chars, min_docs):
    keys = {}
    split = [(i, (t or "").split("\n")) for i, t in rows]
    for i, lines in split:
        for line in lines:
            keys.setdefault(line.strip(WHITE).translate(FOLD), set()).add(i)
    out = []
    for i, lines in split:
        kept = []
        for line in lines:
            key = line.strip(WHITE).translate(FOLD)
            ids = keys[key]
            last = max((x for x in ids if x is not None), default=None)
            if len(key) < min_chars or len(ids) < min_docs or i == last:
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def rows():
    rng = random.Random(5)
    lines = ["", "short", "A line with Ärger", " \tA LINE with Ärger\r", "a line with ärger", "common " * 4, "COMMON " * 4]
    lines += [f"a line of number {i}" for i in range(12)]
    found = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 9)))) for i in range(80)]
    found += [(100, None), (101, ""), (102, "\n"), (103, "\n\n" + "common " * 4 + "\n"), (7, found[3][1]), (8, found[8][1])]
    found += [(None, found[4][1]), (None, found[5][1]), (-5, "common " * 4), (104, "long line " * 20_000)]
    return found + [(105, "\n".join(f"line {i} of very many" for i in range(3000)))] * 3


@pytest.mark.parametrize("hot_keys, min_docs", [(5000, 3), (5, 3), (1, 2)])
def test_equals_brute_force(documents, hot_keys, min_docs):
    data = rows()
    got = op.digest(op.line_dedup(documents(data), 16, min_docs, hot_keys)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(data, 16, min_docs)


def test_a_line_of_rows_without_an_id(documents):
    line = "the very same line of text"
    got = op.line_dedup(documents([(None, line), (1, line), (2, line), (None, "x\n" + line)]))
    assert sorted([(r["doc_id"], r["n_dropped"], r["kept"]) for r in got.collect()], key=str) == [
        (1, 1, ""), (2, 0, line), (None, 1, ""), (None, 1, "x"),
    ]


def test_length_counts_code_points(documents):
    long, short = "é" * 20, "é" * 19
    got = op.line_dedup(documents([(i, f"{long}\n{short}\n{long}") for i in range(3)]))
    assert sorted((r["doc_id"], r["n_dropped"], r["kept"]) for r in got.collect()) == [
        (0, 2, short), (1, 2, short), (2, 0, f"{long}\n{short}\n{long}"),
    ]


def test_empty_table(documents):
    assert op.line_dedup(documents([])).collect() == []


def test_no_python_in_the_plan(documents, spark):
    plan = op.digest(op.line_dedup(documents(rows())))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
