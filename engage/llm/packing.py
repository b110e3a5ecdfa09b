"""Packing documents into sequences of bounded length, balanced by cost.

A piece of n tokens costs LINEAR * n + QUADRATIC * n^2, the linear layers and the attention of a training step.
Documents are dealt by a hash of the row into shards of about ``SHARD_BYTES`` of text; the number of shards follows
the corpus, and a shard's waste is under one sequence.  In a shard, whole sequences are cut from long documents, and
the rest are taken in descending cost, each to the sequence of lowest cost that has room for it.  What fits nowhere whole is
cut over the room that is left, so that only the shard's last tokens leave padding.

Defined results: null and empty texts are one piece, the end token alone; repeated rows are packed each; the same rows
give the same sequences on every run; an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import json
import math
import os
import re
import unicodedata
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from engage.llm.common import column_bytes, texts

CAPACITY = 4096
END = 2
LINEAR = 1.0
QUADRATIC = 1.0 / 2048
SHARD_BYTES = 8 << 20
RUN_BYTES = 8 << 20
PARTS_AT_ONCE = 2048
SPACE = re.compile(rb"[\x20\x09-\x0D]")

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, cost double"


def expanded(offsets: np.ndarray, values: np.ndarray, inner: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lists of numbers with each number replaced by its own list: offsets and items of the result."""
    lengths = np.diff(inner)[values]
    ends = np.cumsum(lengths)
    source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(inner[values] - (ends - lengths), lengths)
    return np.r_[0, ends][offsets], items[source]


class Words:
    """Token ids of texts by way of their different words.

    The vocabulary's pre-tokenizer never joins text across white space, and its normalizer lower-cases, so a text's ids are
    those of its words, ASCII letters lower-cased, in turn.  A run of texts is split and its words numbered by Arrow.  Words of
    ASCII and precomposed Latin letters are cut where the class of characters changes, each part being what the pre-tokenizer
    would give; the different parts of a run go to the vocabulary's merges directly, thousands in a call, and come apart
    after tokens that end a word.  Words of other characters, or with apostrophes, are cut by the pre-tokenizer's own pattern or
    before closing punctuation, and encoded as they are.  Nothing is kept from run to run.
    """

    # Fixed value: the pre-tokenizer's pattern, for lower-case ASCII without white space.
    ASCII = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
    CLOSING = re.compile(rb"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+\Z")
    OTHER, LETTER, DIGIT, HARD = range(4)

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.markers = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        tokens = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(tokens.values()) + 1, bool)
        self.ends_word[[i for token, i in tokens.items() if token.endswith("</w>")]] = True
        # the merges alone, over words that are already normalised, cut and spelt in the vocabulary's alphabet of bytes
        bare = json.loads(self.tokenizer.to_str()) | {
            "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "added_tokens": []
        }
        self.merges = Tokenizer.from_str(json.dumps(bare))
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in printable]
        spelt = {b: chr(256 + i) for i, b in enumerate(rest)} | {0x20: " "}
        self.alphabet = "".join(spelt.get(b, chr(b)) for b in range(256))
        self.classes = np.full(256, self.HARD, np.uint8)
        self.classes[0x21:0x7F] = self.OTHER
        self.classes[ord("a") : ord("z") + 1], self.classes[ord("0") : ord("9") + 1] = self.LETTER, self.DIGIT
        self.classes[ord("'")] = self.HARD

    def classes_of(self, data: np.ndarray) -> np.ndarray:
        """The class of every byte; both bytes of U+00C0 to U+017F are letters but for the signs among them and dotted I."""
        kind = self.classes[data]
        lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC5))
        pair = data[lead].astype(np.int64) << 8 | data[lead + 1]
        lead = lead[~np.isin(pair, (0xC397, 0xC3B7, 0xC4B0))]
        kind[lead] = kind[lead + 1] = self.LETTER
        return kind

    def cut(self, word: bytes) -> list[bytes]:
        if word.isascii():
            return self.ASCII.findall(word)
        end = self.CLOSING.search(word)
        if end and end.start():
            last = unicodedata.normalize("NFC", word[: end.start()].decode()[-1]).lower()[-1]
            if last.isalpha():
                return [word[: end.start()], *self.ASCII.findall(end[0])]
        return [word]

    def of_parts(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of parts that are one pre-token each."""
        if not len(parts):
            return np.zeros(1, np.int64), np.zeros(0, self.kind)
        groups = pa.LargeListArray.from_arrays(pa.array([*range(0, len(parts), PARTS_AT_ONCE), len(parts)], pa.int64()), parts)
        texts = [
            codecs.charmap_decode(joined.decode().lower().encode(), "strict", self.alphabet)[0]
            for joined in pc.binary_join(groups, pa.scalar(b" ", pa.large_binary())).to_pylist()
        ]
        found = self.merges.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(f.ids, self.kind) for f in found])
        offsets = np.r_[0, np.flatnonzero(self.ends_word[ids]) + 1]
        if len(offsets) != len(parts) + 1:
            raise ValueError("the vocabulary does not end words as expected")
        return offsets, ids

    def of_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of words that the pattern has to cut."""
        known: dict[bytes, int] = {}
        lists = [[known.setdefault(p, len(known)) for p in self.cut(w)] for w in words]
        found = self.tokenizer.encode_batch_fast([p.decode() for p in known], add_special_tokens=False)
        inner = np.r_[0, np.cumsum([len(f.ids) for f in found])].astype(np.int64)
        ids = np.array([i for f in found for i in f.ids], self.kind)
        offsets = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int64)
        return expanded(offsets, np.array([p for x in lists for p in x], np.int64), inner, ids)

    def of_segments(self, segments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of different segments, parts or words to be cut."""
        data, at = column_bytes(segments)
        owner = np.repeat(np.arange(len(segments)), np.diff(at))
        hard = np.bincount(owner[self.classes_of(data) == self.HARD], minlength=len(segments)) > 0
        plain, plain_ids = self.of_parts(segments.filter(pa.array(~hard)))
        cut, cut_ids = self.of_words(segments.filter(pa.array(hard)).to_pylist())
        # where each segment's ids are in the two results, one behind the other
        place = np.empty(len(segments), np.int64)
        place[~hard], place[hard] = np.arange((~hard).sum()), (~hard).sum() + np.arange(hard.sum())
        inner = np.r_[plain, cut[1:] + plain[-1]]
        return expanded(np.arange(len(segments) + 1), place, inner, np.concatenate([plain_ids, cut_ids]))

    def of_run(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of a run of texts, or of pieces cut at white space."""
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(pieces, pa.large_binary()).cast(pa.large_string())))
        words = lists.flatten().dictionary_encode()
        data, at = column_bytes(words.dictionary)
        lengths = np.diff(at)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        kind = self.classes_of(data)
        hard = np.bincount(owner[kind == self.HARD], minlength=len(lengths)) > 0
        cut = np.r_[True, kind[1:] != kind[:-1]] | (kind == self.DIGIT) if len(kind) else np.zeros(0, bool)
        cut &= ~hard[owner]
        cut[at[:-1][lengths > 0]] = True
        starts = np.flatnonzero(cut)
        buffers = [None, pa.py_buffer(np.r_[starts, len(data)].astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        segments = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
        inner, ids = self.of_segments(segments.dictionary)
        per_word = np.r_[0, np.cumsum(np.bincount(owner[starts], minlength=len(lengths)))]
        of_word, ids = expanded(per_word, segments.indices.to_numpy().astype(np.int64), inner, ids)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        return expanded(offsets - offsets[0], words.indices.to_numpy().astype(np.int64), of_word, ids)

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of texts, as bytes of one integer type; long texts are cut at white space, so that runs stay small."""
        pieces, first = [], [0]
        for text in texts:
            whole, at = text.encode(), 0
            while len(whole) - at > RUN_BYTES:
                space = SPACE.search(whole, at + RUN_BYTES)
                if not space:
                    break
                pieces.append(whole[at : space.start()])
                at = space.end()
            pieces.append(whole[at:])
            first.append(len(pieces))
        found: list[bytes] = []
        start = size = 0
        for i, piece in enumerate(pieces):
            size += len(piece)
            if size >= RUN_BYTES or i + 1 == len(pieces):
                offsets, ids = self.of_run(pieces[start : i + 1])
                found += [ids[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                start, size = i + 1, 0
        out = [found[a] if b == a + 1 else b"".join(found[a:b]) for a, b in zip(first, first[1:])]
        for i, text in enumerate(texts):
            # markers may span words, and are tokens of their own
            if any(m in text for m in self.markers):
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        return out


def tokenised(batches, path: str):
    words = Words(path)
    for whole in batches:
        sizes = pc.cumulative_sum(pc.binary_length(whole.column("text"))).to_numpy()
        cuts = np.flatnonzero(np.diff(sizes // RUN_BYTES)) + 1
        for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, whole.num_rows].tolist(), strict=True):
            if a < b:
                batch = whole.slice(a, b - a)
                ids = words.ids(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("shard"), pa.array(ids, pa.binary())], names=["doc_id", "shard", "ids"]
                )


def cost_of(n: int) -> float:
    return LINEAR * n + QUADRATIC * n * n


def pack(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) for documents of the given lengths, by their number here."""
    n_sequences = -(-sum(lengths) // capacity)
    pieces, rest, left = [], [], []
    room, cost = np.full(n_sequences, capacity), np.zeros(n_sequences)

    def put(doc: int, start: int, n: int, sequence: int) -> None:
        pieces.append((doc, start, n, sequence, int(capacity - room[sequence])))
        room[sequence] -= n
        cost[sequence] += cost_of(n)

    full = 0
    for doc, n in enumerate(lengths):
        for start in range(0, n - n % capacity, capacity):
            put(doc, start, capacity, full)
            full += 1
        if n % capacity:
            rest.append((n % capacity, doc, n - n % capacity))
    rest.sort(key=lambda x: (-x[0], x[1]))
    for n, doc, start in rest:
        open_ = np.where(room >= n, cost, np.inf)
        s = int(open_.argmin()) if n_sequences else 0
        if np.isinf(open_[s]):
            left.append((n, doc, start))
        else:
            put(doc, start, n, s)
    gaps = np.argsort(-room, kind="stable").tolist()
    at = 0
    for n, doc, start in left:
        while n:
            while room[gaps[at]] == 0:
                at += 1
            s = gaps[at]
            part = min(n, int(room[s]))
            put(doc, start, part, s)
            start, n = start + part, n - part
    return pieces


def pack_shard(shard: pd.DataFrame, capacity: int, end: int, kind: str) -> pd.DataFrame:
    shard = shard.sort_values(["doc_id", "ids"], kind="stable", na_position="last").reset_index(drop=True)
    size = np.dtype(kind).itemsize
    texts_ids, keys = shard["ids"].tolist(), shard["doc_id"].astype("Int64").tolist()
    lengths = [len(x) // size + 1 for x in texts_ids]
    rows = []
    base = int(shard["shard"].iloc[0]) << 32
    for doc, start, n, sequence, offset in pack(lengths, capacity):
        ids = np.frombuffer(texts_ids[doc], kind, min(n, lengths[doc] - 1 - start), start * size).astype("<u4")
        if start + n == lengths[doc]:
            ids = np.append(ids, np.uint32(end))
        checksum = zlib.crc32(ids.astype("<u4").tobytes())
        rows.append((keys[doc], start, n, checksum, lengths[doc], base + sequence, offset, cost_of(n)))
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


def packed(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, with the checksum of its ids."""
    rows = texts(docs)
    whole = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(whole / shard_bytes))
    kind = Words(tokenizer).kind.str
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)))
    ids = dealt.mapInArrow(lambda batches: tokenised(batches, tokenizer), "doc_id long, shard long, ids binary")
    return ids.groupBy("shard").applyInPandas(lambda shard: pack_shard(shard, capacity, end, kind), SCHEMA)


def default_tokenizer() -> str:
    return public_tokenizers.path("word_bpe_49k.json")
