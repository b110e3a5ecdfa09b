"""Exact duplicates by Patricia tries.

Texts are equal when their bytes agree once ASCII white space is deleted.  Every input task inserts its normalised
texts into a compressed radix trie, whose terminal nodes keep the best identifier and a count, so a text that a
third of all rows share leaves the task as one row.  Rows are then dealt by length and content hash, and tries over
the full byte strings of each partition merge them.  A trie that outgrows its budget spills its largest subtree:
the subtree's terminals leave as partial rows, which the closing sum per text joins again.

Defined results: null text counts as empty and all empty texts are one group; of equal texts the row with the most
code points, then the smallest doc_id, stays (a null id comes after all others); repeated rows each count in
``group_size`` and rows that agree in doc_id and text stand or fall together; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from engage.llm.common import WHITE, binary_lists, in_parts, texts

TRIE_BYTES = 64 << 20


class Node:
    """A trie node: the bytes on the edge into it, children by first byte, and what ends here."""

    __slots__ = ("label", "children", "best", "count")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, Node] = {}
        self.best = None
        self.count = 0


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low, high = 0, most
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


class Patricia:
    """A compressed radix trie from byte strings to (best, count)."""

    def __init__(self):
        self.root = Node(b"")
        self.bytes = 0

    def insert(self, key: bytes, best: tuple, count: int) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = Node(key[at:])
                node.children[key[at]] = child
                self.bytes += len(child.label) + 200
                node, at = child, len(key)
                continue
            rest = key[at : at + len(child.label)]
            if rest != child.label:
                shared = common_prefix(rest, child.label)
                upper = Node(child.label[:shared])
                child.label = child.label[shared:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = upper
                self.bytes += 200
                child = upper
            node, at = child, at + len(child.label)
        node.best = best if node.best is None else min(node.best, best)
        node.count += count

    def drain(self, node: Node | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, tuple, int]]:
        """The terminals at and below a node, each with its whole key."""
        stack = [(self.root if node is None else node, prefix)]
        while stack:
            node, prefix = stack.pop()
            whole = prefix + node.label
            if node.count:
                yield whole, node.best, node.count
            stack.extend((child, whole) for child in node.children.values())

    def spill(self) -> Iterator[tuple[bytes, tuple, int]]:
        """Cut off the largest subtree below the first branching node and give its terminals."""
        node, prefix = self.root, b""
        while len(node.children) == 1 and not node.count:
            (child,) = node.children.values()
            if not child.children:
                break
            node, prefix = child, prefix + child.label
        heaviest = max(node.children, key=lambda first: weight(node.children[first]))
        cut = node.children.pop(heaviest)
        self.bytes -= weight(cut)
        yield from self.drain(cut, prefix)


def weight(node: Node) -> int:
    total, stack = 0, [node]
    while stack:
        node = stack.pop()
        total += len(node.label) + 200
        stack.extend(node.children.values())
    return total


def rank(n_chars: int, doc_id: int | None) -> tuple:
    return (-n_chars, doc_id is None, doc_id or 0)


def digest(key: bytes, hash_bits: int) -> tuple[int, str]:
    whole = hashlib.sha256(key).digest()
    return int.from_bytes(whole[:8], "big", signed=True) >> (64 - hash_bits), whole.hex()


def digests(batches, hash_bits: int = 64):
    """(doc_id, n_bytes, content_hash, text_sha256) of every row."""
    for batch in in_parts(batches):
        keys = [t.translate(None, WHITE) for t in binary_lists(batch.column("text"))]
        hashes = [digest(k, hash_bits) for k in keys]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(k) for k in keys], pa.int64()),
                pa.array([h[0] for h in hashes], pa.int64()),
                pa.array([h[1] for h in hashes], pa.string()),
            ],
            names=["doc_id", "n_bytes", "content_hash", "text_sha256"],
        )


def chunks(rows: Iterator, make, bytes_each: int = 8 << 20):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[0]) + 100
        if size > bytes_each:
            yield make(held)
            held, size = [], 0
    if held:
        yield make(held)


def terminals(batches, hash_bits: int = 64, budget: int = TRIE_BYTES):
    """Partial terminals of one input task: its texts, each once unless spilled."""

    def rows():
        trie = Patricia()
        for batch in in_parts(batches):
            ids, lengths = batch.column("doc_id").to_pylist(), batch.column("n_chars").to_pylist()
            for text, doc_id, n in zip(binary_lists(batch.column("text")), ids, lengths, strict=True):
                trie.insert(text.translate(None, WHITE), rank(n, doc_id), 1)
                while trie.bytes > budget:
                    yield from trie.spill()
        yield from trie.drain()

    def make(held):
        keys, best, counts = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([len(k) for k in keys], pa.int64()),
                pa.array([digest(k, hash_bits)[0] for k in keys], pa.int64()),
                pa.array(keys, pa.binary()),
                pa.array([-b[0] for b in best], pa.int64()),
                pa.array([None if b[1] else b[2] for b in best], pa.int64()),
                pa.array(counts, pa.int64()),
            ],
            names=["n_bytes", "content_hash", "key", "n_chars", "keep_id", "n"],
        )

    yield from chunks(rows(), make)


def merged(batches, hash_bits: int = 64, budget: int = TRIE_BYTES):
    """Owners of one (length, hash) partition from the partial terminals dealt to it."""

    def rows():
        trie = Patricia()
        for batch in in_parts(batches):
            values = [batch.column(c).to_pylist() for c in ("key", "n_chars", "keep_id", "n")]
            for key, n_chars, keep_id, n in zip(*values, strict=True):
                trie.insert(key, rank(n_chars, keep_id), n)
                while trie.bytes > budget:
                    yield from trie.spill()
        yield from trie.drain()

    def make(held):
        keys, best, counts = zip(*held, strict=True)
        hashes = [digest(k, hash_bits) for k in keys]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([len(k) for k in keys], pa.int64()),
                pa.array([h[0] for h in hashes], pa.int64()),
                pa.array([h[1] for h in hashes], pa.string()),
                pa.array([-b[0] for b in best], pa.int64()),
                pa.array([None if b[1] else b[2] for b in best], pa.int64()),
                pa.array(counts, pa.int64()),
            ],
            names=["n_bytes", "content_hash", "text_sha256", "n_chars", "keep_id", "n"],
        )

    yield from chunks(rows(), make)


def owners(docs: DataFrame, hash_bits: int = 64, budget: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct normalised text: n_bytes, content_hash, text_sha256, keep_id, group_size."""
    rows = texts(docs).withColumn("n_chars", F.length("text").cast("long"))
    partial = rows.mapInArrow(
        lambda batches: terminals(batches, hash_bits, budget),
        "n_bytes long, content_hash long, key binary, n_chars long, keep_id long, n long",
    )
    # the trie's partitions: every copy of a text has its length and its hash
    dealt = partial.repartition("n_bytes", "content_hash")
    found = dealt.mapInArrow(
        lambda batches: merged(batches, hash_bits, budget),
        "n_bytes long, content_hash long, text_sha256 string, n_chars long, keep_id long, n long",
    )
    best = F.struct((-F.col("n_chars")).alias("a"), F.col("keep_id").isNull().alias("b"), F.col("keep_id").alias("c"))
    return found.groupBy("n_bytes", "text_sha256").agg(
        F.min(best)["c"].alias("keep_id"), F.sum("n").alias("group_size")
    )


def exact_dedup(docs: DataFrame, hash_bits: int = 64, budget: int = TRIE_BYTES) -> DataFrame:
    """One row per document with its group: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = texts(docs).mapInArrow(
        lambda batches: digests(batches, hash_bits),
        "doc_id long, n_bytes long, content_hash long, text_sha256 string",
    )
    # a plain join, so that a hot text's rows can be split between tasks at run time
    return rows.join(owners(docs, hash_bits, budget), ["n_bytes", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
             count(*) OVER (PARTITION BY norm) AS group_size FROM t)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
