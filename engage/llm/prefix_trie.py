"""The trie of conversations' prefixes, and what storing each shared prefix once would save.

1. Conversations are rebuilt (see ``rebuilt``) and become one row each: the 16-byte digests of their turns joined to a
   path, and the turns' words.  Paths in byte order hold all conversations with a common prefix side by side.
2. Rows are range-sorted by path and conversation into shards of about ``SHARD_TURNS`` turns, so that neither a prefix nor a whole
   conversation that a third of all rows share is more than its part of a shard.
3. A shard's trie is a sequence of balanced parentheses in preorder, with the least and greatest excess of every block in a
   tree above them.  ``close_of`` delimits a node's subtree, the rank of its opening parenthesis numbers it, the rank of
   "()" pairs counts leaves, and sums cumulated in preorder give members and savings.
4. Only nodes on the paths of a shard's first and last conversation can occur in other shards.  Everything else is final.
   These spines leave as partial rows, merged by node: counts add up, children that are spine nodes
   themselves are counted once, and a spine passes what its deeper nodes hold up to the nodes above it.

Defined results: rows without a conv_id belong to no conversation and are left out; rows of one turn number are ordered
by the digest of role and text, repeated rows are turns of their own; a null role or text is empty; an empty table gives
an empty result; other columns are left alone.  A conversation is one row, so its digests must fit a task.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from engage.llm.exact_dedup import common_prefix
from engage.session import materialise

SHARD_TURNS = 1 << 16
GROUP = 20
HEADS = 4
BLOCK = 64
DIGEST = 16
NONE = hashlib.sha256(b"").hexdigest()

NODES = pa.schema(
    [
        ("shard", pa.int32()),
        ("side", pa.int32()),
        ("depth", pa.int64()),
        ("node", pa.binary()),
        ("parent", pa.binary()),
        ("conv_id", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("parent_side", pa.int32()),
        ("parent_depth", pa.int64()),
        ("words", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()),
        ("ids", pa.string()),
    ]
)
NODES_DDL = (
    "shard int, side int, depth long, node binary, parent binary, conv_id long, parent_conv_id long, parent_side int, "
    "parent_depth long, words long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ids string"
)


# -- balanced parentheses ----------------------------------------------------------------------------------


class Parentheses:
    """A sequence of parentheses with the range of excess per block, and a tree of ranges over the blocks."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.rank = np.cumsum(bits)
        self.excess = 2 * self.rank - np.arange(1, len(bits) + 1)
        blocks = -(-len(bits) // BLOCK)
        size = 1 << max(0, (blocks - 1).bit_length())
        padded = np.full(size * BLOCK, self.excess[-1])
        padded[: len(bits)] = self.excess
        low, high = padded.reshape(size, BLOCK).min(1), padded.reshape(size, BLOCK).max(1)
        # per level the range of every run of 2^level blocks
        self.levels = [(low, high)]
        while len(low) > 1:
            low, high = low.reshape(-1, 2).min(1), high.reshape(-1, 2).max(1)
            self.levels.append((low, high))

    def holds(self, level: int, index: np.ndarray, value: np.ndarray) -> np.ndarray:
        low, high = self.levels[level]
        return (low[index] <= value) & (value <= high[index])

    def scan(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The first place of an excess from ``at`` to the end of its block, else -1."""
        found = np.full(len(at), -1)
        open_ = np.arange(len(at))
        at = at.copy()
        while len(open_):
            inside = at[open_] < len(self.excess)
            open_ = open_[inside]
            hit = self.excess[at[open_]] == value[open_]
            found[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit]
            at[open_] += 1
            open_ = open_[at[open_] % BLOCK != 0]
        return found

    def close_of(self, opens: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one."""
        value = self.excess[opens] - 1
        found = np.full(len(opens), -1)
        inner = opens % BLOCK != BLOCK - 1
        found[inner] = self.scan(opens[inner] + 1, value[inner])
        far = np.flatnonzero(found < 0)
        index, level = opens[far] // BLOCK + 1, np.zeros(len(far), np.int64)
        block = np.full(len(far), -1)
        for height in range(len(self.levels)):
            # at this level: take the block, or its right neighbour, or go up
            for _ in range(2):
                here = np.flatnonzero((block < 0) & (level == height))
                hit = here[self.holds(height, np.minimum(index[here], len(self.levels[height][0]) - 1), value[far[here]])]
                hit = hit[index[hit] < len(self.levels[height][0])]
                block[hit] = index[hit]
                left = np.setdiff1d(here, hit, assume_unique=True)
                index[left] += 1
                up = left[index[left] % 2 == 0]
                index[up] //= 2
                level[up] += 1
        for height in range(len(self.levels) - 1, 0, -1):
            down = np.flatnonzero(level == height)
            block[down] *= 2
            right = down[~self.holds(height - 1, block[down], value[far[down]])]
            block[right] += 1
            level[down] -= 1
        found[far] = self.scan(block * BLOCK, value[far])
        return found


def least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The minimum of each range [low, high) of ``values``, by a table of doubling ranges."""
    table = [values]
    while 2 << (len(table) - 1) <= len(values):
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    level = np.frexp(high - low)[1] - 1
    out = np.empty(len(low), values.dtype)
    for i, row in enumerate(table):
        here = level == i
        out[here] = np.minimum(row[low[here]], row[high[here] - (1 << i)])
    return out


def chain(path: bytes) -> list[bytes]:
    """The names of the nodes along a path, each a digest of all turns up to it."""
    out = [b""]
    for i in range(0, len(path), DIGEST):
        out.append(hashlib.md5(out[-1] + path[i : i + DIGEST]).digest())
    return out


def encoded(paths: list[bytes], convs: np.ndarray, words: list[np.ndarray], shard: int) -> list[dict]:
    """A sorted shard's nodes as columns: those that are final, and those of its first and last path."""
    depths = np.array([len(p) // DIGEST for p in paths])
    shared = np.array([0, *(common_prefix(a, b) // DIGEST for a, b in zip(paths, paths[1:]))])
    opens, closes = depths - shared, np.r_[0, depths[:-1] - shared[1:]]
    counts = np.r_[1, np.c_[closes, opens].ravel(), depths[-1] + 1]
    values = np.r_[True, np.tile([False, True], len(paths)), False]
    tree = Parentheses(np.repeat(values, counts))
    n = int(tree.rank[-1])
    nodes = np.arange(n)
    opened = np.flatnonzero(tree.bits)
    closed = tree.close_of(opened)
    after = tree.rank[closed]  # the number of the first node behind the subtree
    depth = tree.excess[opened] - 1
    word = np.concatenate([[0], *(w[s:] for w, s in zip(words, shared))]).astype(np.int64)
    ends = np.cumsum(opens)
    # the first new node of a conversation hangs on what it shares, the others on the one before
    parent, path = nodes - 1, [0]
    for new, last, at in zip((ends - opens + 1).tolist(), ends.tolist(), shared.tolist()):
        del path[at + 1 :]
        if new <= last:
            parent[new] = path[at]
            path.extend(range(new, last + 1))

    members = np.r_[0, np.cumsum(np.bincount(ends, minlength=n))]
    low, high = members[:-1], members[after]
    n_convs = high - low
    conv = least_between(convs, low, high)
    spine = np.zeros(n, bool)
    spine[: depths[0] + 1] = True
    spine[path] = True
    pairs = np.zeros(len(tree.bits) + 1, np.int64)
    leaf = ~tree.bits[opened + 1]
    pairs[opened[leaf & ~spine] + 1] = 1
    pairs = np.cumsum(pairs)
    leaves = pairs[closed] - pairs[opened]
    saving = np.r_[0, np.cumsum(np.where(spine, 0, (n_convs - 1) * word))]
    saved = saving[after] - saving[:-1]
    children = np.bincount(parent[1:][~spine[1:]], minlength=n)
    # what lies under a spine node but under no deeper one
    below = nodes[1:][spine[1:]]
    own_leaves, own_saved = leaves.copy(), saved.copy()
    np.subtract.at(own_leaves, parent[below], leaves[below])
    np.subtract.at(own_saved, parent[below], saved[below])

    ids = {}
    ending = np.flatnonzero(np.diff(members))
    for node, a, b in zip(ending.tolist(), members[ending].tolist(), members[ending + 1].tolist()):
        ids[node] = ",".join(map(str, convs[a:b].tolist()))
    inner = nodes[~spine]
    under = spine[parent[inner]]
    side = np.where(parent[inner] <= depths[0], 0, 1)
    final = {
        "shard": np.full(len(inner), shard),
        "depth": depth[inner],
        "conv_id": conv[inner],
        "parent_conv_id": pa.array(conv[parent[inner]], mask=under),
        "parent_side": pa.array(side, mask=~under),
        "parent_depth": pa.array(depth[parent[inner]], mask=~under),
        "words": word[inner],
        "n_convs": n_convs[inner],
        "n_children": children[inner],
        "n_leaves": leaves[inner],
        "saved_tokens": saved[inner],
        "ends_sha256": [hashlib.sha256(ids[i].encode()).hexdigest() if i in ids else NONE for i in inner.tolist()],
    }
    out = [final]
    for side, (line, names) in enumerate(((range(depths[0] + 1), chain(paths[0])), (path, chain(paths[-1])))):
        line = np.array(line)
        held = line > depths[0] if side else np.ones(len(line), bool)
        if not held.any():
            continue
        out.append(
            {
                "shard": np.full(len(line), shard),
                "side": np.full(len(line), side),
                "depth": depth[line],
                "node": names,
                "parent": [None, *names[:-1]],
                "conv_id": pa.array(conv[line], mask=~held),
                "words": word[line],
                **{
                    c: np.where(held, x[line], 0)
                    for c, x in (
                        ("n_convs", n_convs), ("n_children", children), ("n_leaves", own_leaves), ("saved_tokens", own_saved)
                    )
                },
                "ids": [ids.get(i) if h else None for i, h in zip(line.tolist(), held.tolist())],
            }
        )
    return out


def encoded_shard(batches):
    paths, convs, words = [], [], []
    for batch in batches:
        paths += batch.column("path").to_pylist()
        convs += batch.column("conv_id").to_pylist()
        flat = batch.column("words")
        cuts = flat.offsets.to_numpy() - flat.offsets[0].as_py()
        words += np.split(flat.flatten().to_numpy(zero_copy_only=False), cuts[1:-1])
    if paths:
        for columns in encoded(paths, np.array(convs, np.int64), words, TaskContext.get().partitionId()):
            length = len(columns["depth"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(length, f.type) for f in NODES],
                schema=NODES,
            )


# -- rebuilding -----------------------------------------------------------------------------------------------


def rebuilt(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """(conv_id, path, words): conversation c starts with the first h turns of conversation c - c % group, then has its own
    after its first h; h is crc32 of c modulo ``heads``.  The remainder has the sign of c, as in SQL."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    n_words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    c = F.col("conv_id").cast("long")
    rows = conversations.where(c.isNotNull()).select(
        (c - c % group).alias("base"), c.alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), digest.alias("digest"), n_words.alias("words")).alias("turn"),
    )
    # one shuffle: a group's conversations are gathered where their first one is
    own = rows.repartition("base").groupBy("base", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    first = F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, heads - 1))
    head = F.first(first, ignorenulls=True).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    turns = F.concat(
        F.coalesce(F.slice(head, F.lit(1), h), F.slice("turns", 1, 0)), F.slice("turns", h + 1, F.size("turns"))
    )
    whole = own.withColumn("whole", turns)
    return whole.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("whole", lambda t: F.hex(t["digest"])), "")).alias("path"),
        F.transform("whole", lambda t: t["words"]).alias("words"),
    )


# -- spines ---------------------------------------------------------------------------------------------------


def joined_ids(batches):
    """The digest of a node's conversation ids, whose parts arrive in order."""
    node, state = None, None
    for batch in batches:
        done: list = []
        for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if key != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield ended(done)
    if node is not None:
        yield ended([(node, state.hexdigest())])


def ended(done):
    return pa.RecordBatch.from_arrays(
        [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=["node", "ends_sha256"]
    )


def merged_spines(spines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The spine nodes, each once, and by shard, side and depth the conversation that names the node there."""
    merged = spines.groupBy("node").agg(
        F.min("depth").alias("depth"),
        F.max("parent").alias("parent"),
        F.min(F.struct("shard", "side")).alias("holder"),
        F.min("conv_id").alias("conv_id"),
        F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    kids = merged.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("kids"))
    merged = merged.join(kids, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("kids", F.lit(0)))
    merged = materialise(merged, "spine-nodes")
    # each node's own share lies on one spine; a spine hands on what it holds at and below each of its nodes
    held = merged.select(
        "holder.shard", "holder.side", "depth",
        (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("l"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words")).alias("s"),
    )
    up = Window.partitionBy("shard", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    sums = (
        spines.select("shard", "side", "depth", "node")
        .join(held, ["shard", "side", "depth"], "left")
        .select("node", F.sum("l").over(up).alias("l"), F.sum("s").over(up).alias("s"))
        .groupBy("node")
        .agg(F.sum("l").alias("n_leaves"), F.sum("s").alias("saved_tokens"))
    )
    ends = (
        spines.where("ids is not null").select("node", "shard", "ids")
        .repartition("node").sortWithinPartitions("node", "shard")
        .select("node", "ids").mapInArrow(joined_ids, "node binary, ends_sha256 string")
    )
    above = merged.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = (
        merged.drop("n_leaves", "saved_tokens").join(sums, "node").join(ends, "node", "left").join(above, "parent", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NONE)))
    )
    names = spines.select("shard", "side", "depth", "node").join(merged.select("node", F.col("conv_id").alias("name")), "node")
    return nodes, names.select("shard", F.col("side").alias("parent_side"), F.col("depth").alias("parent_depth"), "name")


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "words"]


def prefix_trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the trie of ``paths`` (conv_id, path, words): its place, its subtree's counts and savings, its ends."""
    paths = materialise(paths, "paths")
    turns, convs = paths.agg(F.sum(F.size("words")), F.count(F.lit(1))).first()
    shards = max(1, math.ceil(((turns or 0) + convs) / shard_turns))
    dealt = paths.repartitionByRange(shards, "path", "conv_id").sortWithinPartitions("path", "conv_id")
    nodes = materialise(dealt.mapInArrow(encoded_shard, NODES_DDL), "nodes")
    spine_nodes, names = merged_spines(nodes.where("side is not null"))
    final = nodes.where("side is null")
    under = final.where("parent_side is not null").join(names, ["shard", "parent_side", "parent_depth"])
    return (
        final.where("parent_side is null").select(*COLUMNS)
        .union(under.withColumn("parent_conv_id", F.col("name")).select(*COLUMNS))
        .union(spine_nodes.select(*COLUMNS))
    )


def digest(found: DataFrame) -> DataFrame:
    return found.drop("words")


ORACLE = r"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
r AS (SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS dg,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, dg) AS pos FROM r),
c AS (SELECT i.conv_id, i.conv_id - i.conv_id % 20 AS base,
             xor(list_reduce(list_transform(string_split(CAST(i.conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda a, b: xor(tab.t[(xor(a, b) & 255) + 1], a >> 8), 4294967295), 4294967295) % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM o) i, tab),
b AS (SELECT c.conv_id, o.pos, o.dg, o.words FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.h
      UNION ALL SELECT c.conv_id, o.pos + 4, o.dg, o.words FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h),
p AS (SELECT conv_id, string_agg(dg, '' ORDER BY pos) AS path, list(words ORDER BY pos) AS words FROM b GROUP BY conv_id),
a AS (SELECT c.conv_id, coalesce(p.path, '') AS path, p.words FROM c LEFT JOIN p ON c.conv_id = p.conv_id),
m AS (SELECT conv_id, path, unnest(range(0, length(path) // 32 + 1)) AS depth, words FROM a),
k AS (SELECT left(path, depth * 32) AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             max(CASE WHEN depth = 0 THEN 0 ELSE words[depth] END) AS w,
             coalesce(string_agg(CASE WHEN length(path) = depth * 32 THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '') AS ids
      FROM m GROUP BY 1, 2),
j AS (SELECT left(node, (depth - 1) * 32) AS parent, count(*) AS n_children FROM k WHERE depth > 0 GROUP BY 1),
x AS (SELECT k.*, coalesce(j.n_children, 0) AS n_children FROM k LEFT JOIN j ON k.node = j.parent),
u AS (SELECT unnest(range(0, depth + 1)) AS d, node, n_children, (n_convs - 1) * w AS s FROM x),
t AS (SELECT left(node, d * 32) AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(s) AS saved FROM u GROUP BY 1)
SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, y.conv_id AS parent_conv_id, CAST(x.n_convs AS BIGINT) AS n_convs, CAST(x.n_children AS BIGINT) AS n_children,
       CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, sha256(x.ids) AS ends_sha256
FROM x JOIN t ON x.node = t.node LEFT JOIN k y ON x.depth > 0 AND y.depth = x.depth - 1 AND y.node = left(x.node, (x.depth - 1) * 32)
"""
