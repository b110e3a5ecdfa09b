"""Removing repeated word sequences with suffix automata.

What may repeat (see ``repeats``) is held in reference shards.  A shard's task builds the suffix automaton of its
pieces, which knows every substring and how often it ends anywhere, and streams the shard's pieces through it
for their matching statistics: after each word, the state of the longest match is cut back to the window's length, and
the window is repeated when that state has two ends or more.  The automaton is as large as its shard, whose size is bounded,
and lives in the task that streams through it; pieces are sent to the shards that hold their anchor only.

Defined results: null text has no words; a text with fewer words than the window loses nothing; repeated rows repeat
everything in them that a window covers; matches never cross documents; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from engage.llm.repeats import Spec, remove_repeats

WINDOW = 35
GRAM = 8
SHARD_WORDS = 60_000
CACHED_WORDS = 200_000
SPACE = re.compile(rb"[\x20\x09-\x0D]+")


class Automaton:
    """The suffix automaton of several sequences, with the number of ends of each state."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = array("q", [-1])
        self.size = array("q", [0])
        self.ends = array("q", [0])

    def add(self, sequence: list[int]) -> None:
        next_, link, size, ends = self.next, self.link, self.size, self.ends
        last = 0
        for word in sequence:
            known = next_[last].get(word)
            if known is not None:
                if size[known] == size[last] + 1:
                    last = known
                else:
                    last = self.copy(known, last, word)
                ends[last] += 1
                continue
            new = len(next_)
            next_.append({})
            link.append(0)
            size.append(size[last] + 1)
            ends.append(1)
            state = last
            while state >= 0 and word not in next_[state]:
                next_[state][word] = new
                state = link[state]
            if state >= 0:
                known = next_[state][word]
                link[new] = known if size[known] == size[state] + 1 else self.copy(known, state, word)
            last = new

    def copy(self, known: int, state: int, word: int) -> int:
        """Split off the shorter part of a state's substrings, those that end after ``state``."""
        next_, link, size = self.next, self.link, self.size
        new = len(next_)
        next_.append(next_[known].copy())
        link.append(link[known])
        size.append(size[state] + 1)
        self.ends.append(0)
        link[known] = new
        while state >= 0 and next_[state].get(word) == known:
            next_[state][word] = new
            state = link[state]
        return new

    def count(self) -> None:
        """Add every state's ends to the states of its suffixes."""
        for state in np.argsort(np.array(self.size), kind="stable")[:0:-1].tolist():
            self.ends[self.link[state]] += self.ends[state]

    def windows(self, sequence: list[int], window: int) -> np.ndarray:
        """Which windows of a sequence end at least twice in the automaton, from its matching statistics."""
        next_, link, size, ends = self.next, self.link, self.size, self.ends
        found = np.zeros(max(0, len(sequence) - window + 1), bool)
        state = length = 0
        for i, word in enumerate(sequence):
            while state and word not in next_[state]:
                state = link[state]
                length = size[state]
            if word in next_[state]:
                state = next_[state][word]
                length += 1
            while size[link[state]] >= window if state else False:
                state = link[state]
                length = size[state]
            if length >= window and ends[state] > 1:
                found[i - window + 1] = True
        return found


def repeated(parts: list[np.ndarray], windows: list[int], window: int) -> list[np.ndarray]:
    """Per part, which of its first windows also start elsewhere in the parts."""
    sequences = [p.tolist() for p in parts]
    automaton = Automaton()
    for sequence in sequences:
        automaton.add(sequence)
    automaton.count()
    return [automaton.windows(s, window)[:n] for s, n in zip(sequences, windows, strict=True)]


class WordHashes(dict):
    """64-bit hashes of words as eight bytes; a bounded cache."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_digest(word)
        return value


HASHES = WordHashes()


def as_words(text: bytes) -> np.ndarray:
    return np.frombuffer(b"".join(map(HASHES.__getitem__, text.split())), "<u8")


def n_words(text: bytes) -> int:
    return len(text.split())


def kept_words(text: bytes, keep: np.ndarray) -> bytes:
    words = text.split()
    return b" ".join(words if keep.all() else [w for w, k in zip(words, keep.tolist(), strict=True) if k])


def spec(window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS, group: int = 1000) -> Spec:
    """The settings for windows of ``window`` words."""
    return Spec(window, gram, shard_words, as_words, n_words, kept_words, repeated, "<u8", group)


SPEC = spec()


def automaton_dedup(docs: DataFrame, settings: Spec = SPEC) -> DataFrame:
    """One row per document: doc_id, n_units (words), spans, kept, kept_sha256."""
    return remove_repeats(docs, settings)


def digest(found: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select("doc_id", F.col("n_units").alias("n_words"), removed.alias("n_removed"), "kept_sha256")
