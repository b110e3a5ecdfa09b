"""Removing what repeats: the common part of byte-wise and word-wise substring deduplication.

A window is N consecutive symbols of one document; a symbol is removed when a window over it also starts somewhere else.

1. Every window has an anchor: of the k-grams in it, the one with the smallest hash, the leftmost of equal ones.  Equal
   windows have equal anchors at equal places.  The consecutive windows of one anchor form a piece.
2. Pieces are counted by anchor and content, combined before they are shuffled.  An anchor that occurs once in the
   corpus rules out its windows; a piece that occurs twice has no unique window.  What is left are pieces that are
   unique as a whole but share their anchor with others, as at both ends of a common passage.
3. These, and one copy of each repeated piece that they share an anchor with, go to shards by anchor, where a local
   index (a suffix array, a suffix automaton) says which of their windows repeat in the shard.
4. An anchor with more than ``GROUP`` different pieces is spread over several shards.  Each of them cuts the sorted
   128-bit hashes of its distinct windows into ranges by binary search, and a range's task looks every run up in
   what the runs have in common.  So no task reads more than its share of a passage that a third of all documents hold.
5. Windows found are marked in their documents, and the marked symbols are cut out.

Nothing is capped: the bounds only choose between steps 3 and 4.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from engage.llm.common import binary_lists, in_parts
from engage.session import materialise

BLOCK = 1 << 20
GROUP = 2048
FACTOR = np.uint64(0x9E3779B97F4A7C15)
RANGE_WINDOWS = 1 << 20


@dataclass(frozen=True)
class Spec:
    """What a repeat is: ``symbols`` of a text and their ``count``, ``joined`` turns kept ones back to bytes, ``local`` finds repeats in a shard."""

    window: int
    gram: int
    shard_symbols: int
    symbols: Callable[[bytes], np.ndarray]
    count: Callable[[bytes], int]
    joined: Callable[[bytes, np.ndarray], bytes]
    local: Callable[[list[np.ndarray], list[int], int], list[np.ndarray]]
    kind: str
    group: int = GROUP


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(31))


def spread(symbols: np.ndarray, seed: int) -> np.ndarray:
    """Symbols as 64-bit hashes."""
    if symbols.dtype == np.uint8:
        table = np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64)
        return table[symbols]
    return mixed((symbols.astype(np.uint64) + np.uint64(2 * seed + 1)) * FACTOR)


def gram_hashes(symbols: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` symbols, by doubling."""
    if len(symbols) < n:
        return np.zeros(0, np.uint64)
    power, size = spread(symbols, seed), 1
    total, covered = None, 0
    count = len(symbols) - n + 1
    while True:
        if n & size:
            part = power[covered : covered + count]
            total = part.copy() if total is None else mixed(total * FACTOR + part)
            covered += size
        if size * 2 > n:
            return total
        power = mixed(power[:-size] * FACTOR + power[size:])
        size *= 2


def least_over(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` keys."""
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[: len(keys) - (width - size)], keys[width - size :]) if width > size else keys


def pieces_of(symbols: np.ndarray, window: int, gram: int):
    """(anchor hash, first window start, number of windows) of a document's pieces, as three arrays."""
    found = []
    step = BLOCK - window
    mask = np.uint64(BLOCK - 1)
    for start in range(0, max(0, len(symbols) - window + 1), step):
        part = symbols[start : start + step + window - 1]
        hashes = gram_hashes(part, gram, 1)
        keys = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
        anchor = (least_over(keys, window - gram + 1) & mask).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        found.append((hashes[anchor[first]], first + start, np.diff(np.r_[first, len(anchor)])))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, doc, text): ``doc`` identifies the row by its id and a hash of its text; equal rows are alike."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.struct(
            F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"), F.xxhash64(text).alias("hash")
        ).alias("doc"),
        text.alias("text"),
    )


def occurrences(batches, spec: Spec):
    """Every document's different pieces: (doc, anchor, piece, windows, n, first, starts)."""
    for batch in in_parts(batches):
        rows: list[list] = [[], [], [], [], [], [], []]
        docs = batch.column("doc").to_pylist()
        for doc, text in zip(docs, binary_lists(batch.column("text")), strict=True):
            symbols = spec.symbols(text)
            anchors, firsts, sizes = pieces_of(symbols, spec.window, spec.gram)
            content = memoryview(np.ascontiguousarray(symbols).view(np.uint8)) if len(symbols) else b""
            width = symbols.itemsize
            seen: dict[tuple, list[int]] = {}
            for anchor, first, size in zip(anchors.view(np.int64).tolist(), firsts.tolist(), sizes.tolist(), strict=True):
                end = (first + size - 1 + spec.window) * width
                piece = signed(xxhash.xxh3_64_intdigest(content[first * width : end]))
                seen.setdefault((anchor, piece, size), []).append(first)
            for (anchor, piece, size), starts in seen.items():
                for column, value in zip(rows, (doc, anchor, piece, size, len(starts), starts[0], np.array(starts, "<i8").tobytes()), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows[0], pa.struct([("id", pa.string()), ("hash", pa.int64())])),
                *[pa.array(c, pa.int64()) for c in rows[1:6]],
                pa.array(rows[6], pa.binary()),
            ],
            names=["doc", "anchor", "piece", "windows", "n", "first", "starts"],
        )


def contents(batches, spec: Spec):
    """The symbols of every piece that a shard needs, one copy each; of a unique piece with its document and place."""
    for batch in in_parts(batches):
        rows: list[list] = [[], [], [], [], [], [], [], []]
        columns = [batch.column(c).to_pylist() for c in ("doc", "wanted")]
        for doc, wanted, text in zip(*columns, binary_lists(batch.column("text")), strict=True):
            symbols = spec.symbols(text)
            for g in wanted:
                first = g["first"]
                part = symbols[first : first + g["windows"] - 1 + spec.window]
                for column, value in zip(
                    rows,
                    (doc, g["anchor"], g["piece"], g["windows"], g["total"], g["different"], first, part.tobytes()),
                    strict=True,
                ):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows[0], pa.struct([("id", pa.string()), ("hash", pa.int64())])),
                *[pa.array(c, pa.int64()) for c in rows[1:7]],
                pa.array(rows[7], pa.binary()),
            ],
            names=["doc", "anchor", "piece", "windows", "total", "different", "first", "symbols"],
        )


MARKS = "doc struct<id:string,hash:bigint>, first long, bits binary, shard long, range int, high binary, low binary, place binary"


def in_shard(shard: pd.DataFrame, spec: Spec, ranges: int) -> pd.DataFrame:
    """Repeated windows of a shard's unique pieces; of a spread anchor also its distinct windows' hashes by range."""
    shard = shard.sort_values(["anchor", "piece"], kind="stable").reset_index(drop=True)
    parts = [np.frombuffer(s, spec.kind) for s in shard["symbols"]]
    sizes = shard["windows"].tolist()
    repeated = spec.local(parts, sizes, spec.window)
    rows = []
    unique = (shard["total"] == 1).to_numpy()
    for i in np.flatnonzero(unique):
        if repeated[i].any():
            doc = shard["doc"].iloc[i]
            rows.append((doc, shard["first"].iloc[i], np.packbits(repeated[i]).tobytes(), None, None, None, None, None))
    if (shard["different"] > spec.group).any():
        high, low, owner, at = [], [], [], []
        for i, part in enumerate(parts):
            high.append(gram_hashes(part, spec.window, 2)[: sizes[i]])
            low.append(gram_hashes(part, spec.window, 3)[: sizes[i]])
            owner.append(np.full(sizes[i], i))
            at.append(np.arange(sizes[i]))
        high, low, owner, at = (np.concatenate(x) for x in (high, low, owner, at))
        order = np.lexsort((low, high))
        high, low, owner, at = high[order], low[order], owner[order], at[order]
        fresh = np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]
        high, low, owner, at = high[fresh], low[fresh], owner[fresh], at[fresh]
        # a window that repeats here is settled, but others must still find it
        settled = ~unique[owner] | np.array([repeated[o][a] for o, a in zip(owner, at, strict=True)], bool)
        place = np.where(settled, -1, (owner << 32) | at)
        cuts = np.searchsorted(high, np.array([(r << 64) // ranges for r in range(1, ranges)], np.uint64))
        number = int(shard["shard"].iloc[0])
        for r, (a, b) in enumerate(zip(np.r_[0, cuts], np.r_[cuts, len(high)], strict=True)):
            if a < b:
                rows.append((None, None, None, number, r, high[a:b].tobytes(), low[a:b].tobytes(), place[a:b].astype("<i8").tobytes()))
    names = ["doc", "first", "bits", "shard", "range", "high", "low", "place"]
    # nullable integers from the values themselves: shard numbers do not survive a detour over doubles
    kinds = {"first": "Int64", "shard": "Int64", "range": "Int32"}
    return pd.DataFrame({c: pd.array([r[i] for r in rows], dtype=kinds.get(c, "object")) for i, c in enumerate(names)})


def across_shards(runs: pd.DataFrame) -> pd.DataFrame:
    """The places, by shard, of windows that also stand in another shard's run of the same range."""
    high = [np.frombuffer(x, "<u8") for x in runs["high"]]
    low = [np.frombuffer(x, "<u8") for x in runs["low"]]
    all_high, all_low = np.concatenate(high), np.concatenate(low)
    order = np.lexsort((all_low, all_high))
    all_high, all_low = all_high[order], all_low[order]
    # a run holds a window once, so equal neighbours come from two shards
    twice = (all_high[1:] == all_high[:-1]) & (all_low[1:] == all_low[:-1])
    common_high, common_low = all_high[1:][twice], all_low[1:][twice]
    rows = []
    for shard, h, l, place in zip(runs["shard"], high, low, runs["place"], strict=True):
        a, b = np.searchsorted(common_high, h, "left"), np.searchsorted(common_high, h, "right")
        found = np.zeros(len(h), bool)
        while True:
            # equal first halves are nearly always one window
            open_ = (a < b) & ~found
            if not open_.any():
                break
            found[open_] = common_low[a[open_]] == l[open_]
            a = a + 1
        place = np.frombuffer(place, "<i8")[found]
        place = place[place >= 0]
        if len(place):
            rows.append((int(shard), place.tobytes()))
    return pd.DataFrame(rows, columns=["shard", "place"])


def located(key, members: pd.DataFrame, hits: pd.DataFrame, spec: Spec) -> pd.DataFrame:
    """Hits of a shard, turned from places in the shard to places in documents."""
    rows = []
    if len(hits):
        members = members.sort_values(["anchor", "piece"], kind="stable").reset_index(drop=True)
        places = np.concatenate([np.frombuffer(p, "<i8") for p in hits["place"]])
        owner, at = places >> 32, places & 0xFFFFFFFF
        order = np.argsort(owner, kind="stable")
        owner, at = owner[order], at[order]
        for i in np.unique(owner):
            bits = np.zeros(int(members["windows"].iloc[i]), bool)
            bits[at[np.searchsorted(owner, i, "left") : np.searchsorted(owner, i, "right")]] = True
            rows.append((members["doc"].iloc[i], int(members["first"].iloc[i]), np.packbits(bits).tobytes()))
    return pd.DataFrame(rows, columns=["doc", "first", "bits"])


def cut(batches, spec: Spec):
    """The documents without what repeats."""
    for batch in in_parts(batches):
        n_units, spans, kept, digests = [], [], [], []
        columns = [batch.column(c).to_pylist() for c in ("gone", "marks")]
        for text, gone, marks in zip(binary_lists(batch.column("text")), *columns, strict=True):
            n = spec.count(text)
            n_units.append(n)
            change = np.zeros(n + 1, np.int32)
            for g in gone or ():
                starts = np.frombuffer(g["starts"], "<i8")
                np.add.at(change, starts, 1)
                np.add.at(change, starts + g["windows"] - 1 + spec.window, -1)
            for mark in marks or ():
                starts = np.flatnonzero(np.unpackbits(np.frombuffer(mark["bits"], np.uint8))) + mark["first"]
                np.add.at(change, starts, 1)
                np.add.at(change, starts + spec.window, -1)
            removed = np.cumsum(change[:n]) > 0
            runs = np.flatnonzero(np.diff(np.r_[False, removed, False])).reshape(-1, 2)
            spans.append([{"start": int(a), "end": int(b)} for a, b in runs])
            rest = spec.joined(text, ~removed)
            kept.append(rest if len(runs) else None)
            digests.append(hashlib.sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_units, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                pa.array(kept, pa.binary()),
                pa.array(digests, pa.string()),
            ],
            names=["doc_id", "n_units", "spans", "kept", "kept_sha256"],
        )


def share(value: Column, parts) -> Column:
    return F.pmod(F.xxhash64(value), parts if isinstance(parts, Column) else F.lit(parts))


def remove_repeats(docs: DataFrame, spec: Spec) -> DataFrame:
    """One row per document: doc_id, n_units, spans removed, kept (null: all of it) and kept_sha256."""
    rows = keyed(docs)
    doc = "doc struct<id:string,hash:bigint>"
    keys = ["anchor", "piece", "windows"]
    found = materialise(
        rows.select("doc", "text").mapInArrow(
            lambda b: occurrences(b, spec),
            f"{doc}, anchor long, piece long, windows long, n long, first long, starts binary",
        ),
        "pieces",
    )
    # read twice in one job, for the pieces and for their anchors, but shuffled once
    counted = found.groupBy(*keys).agg(F.sum("n").alias("total"), F.min(F.struct("doc", "first")).alias("holder"))
    anchors = (
        counted.groupBy("anchor")
        .agg(F.sum("total").alias("seen"), F.count(F.lit(1)).alias("different"))
        .where("seen > 1")
        .drop("seen")
    )
    gated = materialise(counted.join(anchors, "anchor"), "gated")
    # what goes without a further look, by document
    gone = found.join(gated.where("total > 1").select(*keys), keys, "left_semi")
    gone = gone.groupBy(F.col("doc").alias("g")).agg(F.collect_set(F.struct("windows", "starts")).alias("gone"))
    # and one copy of each piece that shares its anchor with others, from its holder
    wanted = gated.where("different > 1").groupBy(F.col("holder.doc").alias("w")).agg(
        F.collect_list(F.struct(*keys, "total", "different", "holder.first")).alias("wanted")
    )
    needed = materialise(
        rows.join(wanted, F.col("doc") == F.col("w"))
        .drop("w")
        .mapInArrow(
            lambda b: contents(b, spec),
            f"{doc}, anchor long, piece long, windows long, total long, different long, first long, symbols binary",
        )
        # equal rows of one document would give a piece twice
        .dropDuplicates(keys),
        "contents",
    )
    size = F.col("windows") + spec.window - 1
    spread_ = F.col("different") > spec.group
    n_symbols, n_spread = needed.agg(F.sum(size), F.sum(F.when(spread_, F.col("windows")))).first()
    shards = max(1, math.ceil((n_symbols or 0) / spec.shard_symbols))
    ranges = max(1, math.ceil((n_spread or 0) / RANGE_WINDOWS))
    salt = F.when(spread_, share(F.col("piece"), F.ceil(F.col("different") / spec.group))).otherwise(0)
    # a spread anchor's shards are its own; the others' are filled by a hash of the anchor
    shard = F.when(spread_, F.xxhash64("anchor", salt)).otherwise(share(F.col("anchor"), shards))
    sharded = needed.withColumn("shard", shard)
    marks = materialise(
        sharded.groupBy("shard").applyInPandas(lambda s: in_shard(s, spec, ranges), MARKS), "marks"
    )
    inside = marks.where("range is null").select("doc", "first", "bits")
    if n_spread:
        hits = (
            marks.where("range is not null")
            .select("shard", "range", "high", "low", "place")
            .groupBy("range")
            .applyInPandas(across_shards, "shard long, place binary")
        )
        members = sharded.where(spread_).select("shard", "doc", "first", "windows", "anchor", "piece")
        outside = (
            members.groupBy("shard")
            .cogroup(hits.groupBy("shard"))
            .applyInPandas(lambda k, m, h: located(k, m, h, spec), f"{doc}, first long, bits binary")
        )
        inside = inside.union(outside)
    by_doc = inside.groupBy(F.col("doc").alias("d")).agg(F.collect_list(F.struct("first", "bits")).alias("marks"))
    return (
        rows.join(gone, F.col("doc") == F.col("g"), "left")
        .join(by_doc, F.col("doc") == F.col("d"), "left")
        .select("doc_id", "text", "gone", "marks")
        .mapInArrow(
            lambda b: cut(b, spec),
            "doc_id long, n_units long, spans array<struct<start:bigint,end:bigint>>, kept binary, kept_sha256 string",
        )
    )
