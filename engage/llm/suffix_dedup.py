"""Removing repeated byte strings with per-shard suffix arrays.

What may repeat (see ``repeats``) is sorted in shards: Larsson-Sadakane refinement ranks suffixes by their first bytes
and doubles the compared length, touching only groups that are still tied; Kasai's common prefixes, in the
form that extends only the entries their left neighbour does not determine, tell which neighbours in
the array agree in a whole window; shards that hold one spread anchor merge their sorted windows by binary search.

Defined results: null text is empty; a text shorter than the window loses nothing; repeated rows repeat
everything in them that a window covers; matches never cross documents; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from engage.llm.repeats import Spec, remove_repeats

WINDOW = 400
GRAM = 128
SHARD_BYTES = 1 << 20
PACKED = 7  # symbols of nine bits in the first key


def suffix_array(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffix array, text, end of each position's part) of byte strings that each end in an own mark below all bytes."""
    sizes = np.array([len(p) for p in parts])
    text = np.concatenate(parts)
    n = len(text)
    ends = np.repeat(np.cumsum(sizes), sizes)
    owner = np.repeat(np.arange(len(parts)), sizes)
    at = np.arange(n)
    key = np.zeros(n, np.int64)
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(PACKED, np.int64)])
    for j in range(PACKED):
        key = (key << 9) | np.where(at + j < ends, padded[j : j + n], 0)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    start = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    size = np.diff(np.r_[start, n])
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(start, size)
    active = order[np.repeat(size, size) > 1]
    length = PACKED
    while len(active):
        # past its end a suffix meets its part's mark, and marks differ
        after = active + length
        inside = after < ends[active]
        second = np.where(inside, rank[np.minimum(after, n - 1)] + len(parts), owner[active])
        first = rank[active]
        order = np.argsort(first * (n + len(parts)) + second, kind="stable")
        active, first, second = active[order], first[order], second[order]
        new_group = np.r_[True, first[1:] != first[:-1]]
        new_rank = new_group | np.r_[True, second[1:] != second[:-1]]
        place = np.arange(len(active))
        group_start = np.maximum.accumulate(np.where(new_group, place, 0))
        rank_start = np.maximum.accumulate(np.where(new_rank, place, 0))
        rank[active] = first + rank_start - group_start
        begin = np.flatnonzero(new_rank)
        size = np.diff(np.r_[begin, len(active)])
        active = active[np.repeat(size, size) > 1]
        length *= 2
    array = np.empty(n, np.int64)
    array[rank] = at
    return array, text, ends


def common_prefixes(array: np.ndarray, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(length in common with the preceding suffix, that suffix), both in text order; -1 precedes the first."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    starts_part = np.r_[True, ends[1:] != ends[:-1]]
    at = np.arange(n)
    # where the bytes to the left agree as well, the left neighbour's length less one is exact
    left = (before > 0) & ~starts_part & ~starts_part[np.maximum(before, 0)]
    left &= text[np.maximum(at - 1, 0)] == text[np.maximum(before - 1, 0)]
    lengths = np.zeros(n, np.int64)
    open_ = np.flatnonzero(~left & (before >= 0))
    step = 16
    padded = np.concatenate([text, np.zeros(step, text.dtype)])
    reach = np.arange(step)
    while len(open_):
        a, b = open_ + lengths[open_], before[open_] + lengths[open_]
        room = np.minimum(np.minimum(ends[open_] - a, ends[before[open_]] - b), step)
        same = padded[a[:, None] + reach] == padded[b[:, None] + reach]
        same &= reach < room[:, None]
        more = np.where(same.all(axis=1), step, same.argmin(axis=1))
        lengths[open_] += more
        open_ = open_[more == step]
    source = np.maximum.accumulate(np.where(left, 0, at))
    return np.where(left, lengths[source] - (at - source), lengths), before


def repeated(parts: list[np.ndarray], windows: list[int], window: int) -> list[np.ndarray]:
    """Per part, which of its first windows also start elsewhere in the parts."""
    array, text, ends = suffix_array(parts)
    lengths, before = common_prefixes(array, text, ends)
    hit = lengths >= window
    found = hit.copy()
    found[before[hit]] = True
    starts = np.cumsum([0, *[len(p) for p in parts[:-1]]])
    return [found[s : s + w] for s, w in zip(starts, windows, strict=True)]


def as_bytes(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8)


def kept_bytes(text: bytes, keep: np.ndarray) -> bytes:
    return text if keep.all() else as_bytes(text)[keep].tobytes()


SPEC = Spec(WINDOW, GRAM, SHARD_BYTES, as_bytes, len, kept_bytes, repeated, "u1")


def spec(window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES, group: int | None = None) -> Spec:
    """The settings for windows of ``window`` bytes."""
    return Spec(window, gram, shard_bytes, as_bytes, len, kept_bytes, repeated, "u1", SPEC.group if group is None else group)


def suffix_dedup(docs: DataFrame, settings: Spec = SPEC) -> DataFrame:
    """One row per document: doc_id, n_units (bytes), spans, kept, kept_sha256."""
    return remove_repeats(docs, settings)


def digest(found: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select(
        "doc_id",
        F.col("n_units").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )
