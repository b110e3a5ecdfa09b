"""Token windows by a subword vocabulary, with their places in the text."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# Texts encoded at a time; what the encoder makes of one text is about fifty times its length.
TEXTS_AT_ONCE = 64


def windows_of(n: int, size: int, overlap: int) -> list[tuple[int, int]]:
    """(first, end) token of every window: the last reaches the end, an empty text has none."""
    step = size - overlap
    starts = range(0, max(n - overlap, 1), step) if n else ()
    return [(s, min(s + size, n)) for s in starts]


WINDOW = "struct<chunk_ix: int, n_tokens: int, start: long, end: long, chunked_text: string>"


def window_lists(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", size: int = 128, overlap: int = 32
) -> DataFrame:
    """One row per text: (key, text, windows), the windows as ``subword_windows`` has them, none of a null or empty text.

    Who needs a text beside its windows has it here without a join.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(vocabulary)
        tokenizer.encode_special_tokens = True
        tokenizer.no_truncation()
        tokenizer.no_padding()
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS_AT_ONCE):
                batch = whole.slice(at, TEXTS_AT_ONCE)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                rows: list[list] = [[], [], [], [], []]
                counts = [0]
                for value, found in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True):
                    n = len(found)
                    windows = windows_of(n, size, overlap)
                    for ix, (first, last) in enumerate(windows):
                        # only the borders are asked for: a list of all tokens' places costs half as much as the tokens
                        start = found.token_to_chars(first - 1)[1] if first else 0
                        end = len(value) if last == n else found.token_to_chars(last - 1)[1]
                        for column, cell in zip(rows, (ix, last - first, start, end, value[start:end]), strict=True):
                            column.append(cell)
                    counts.append(counts[-1] + len(windows))
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string())
                each = pa.StructArray.from_arrays(
                    [pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], ["chunk_ix", "n_tokens", "start", "end", "chunked_text"]
                )
                windows = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), each)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), windows], names=[key, text, "windows"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(text).cast("string")).mapInArrow(run, f"`{key}` {kind}, `{text}` string, windows array<{WINDOW}>")


def subword_windows(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", size: int = 128, overlap: int = 32
) -> DataFrame:
    """Windows of ``size`` subword tokens, ``overlap`` shared: rows (chunk_id, key, chunk_ix, n_tokens, start, end, chunked_text).

    ``vocabulary`` is a tokenizer's JSON, as text: it travels with the tasks, so executors need no file.  No special tokens are
    added or recognised.  ``start`` and ``end`` count code points; a window begins where the token before it ended and ends
    with its last token, the first at the text's start and the last at its end, so without overlap the windows are the
    text.  A window may begin inside a character of several tokens; the character is then the earlier window's.
    ``chunk_id`` hashes (key, chunk_ix).  A null or empty text has no window; nothing is shuffled.
    """
    found = window_lists(docs, vocabulary, key, text, size, overlap).select(key, F.inline("windows"))
    return found.select(F.xxhash64(key, "chunk_ix").alias("chunk_id"), *found.columns)


def in_place(text: Column, start: Column, end: Column, piece: Column) -> tuple[Column, Column]:
    """(cells, test): the text with every code point in equally many bytes, and whether the piece lies there from start to end.

    ``test`` reads a column ``cells`` and only the piece's bytes of it, however far into a text the piece begins.
    """
    wide = lambda c: F.encode(c, "UTF-32")
    narrow = lambda c: F.octet_length(c) == F.length(c)
    cells = F.struct(
        F.when(narrow(text), text.cast("binary")).otherwise(wide(text)).alias("bytes"), F.when(narrow(text), 1).otherwise(4).alias("width")
    )
    width = F.col("cells")["width"]
    there = F.substr(F.col("cells")["bytes"], (start * width + 1).cast("int"), ((end - start) * width).cast("int"))
    return cells, there == F.when(width == 1, piece.cast("binary")).otherwise(wide(piece))


def count_vocabulary(merges: list[tuple[str, str]], characters: str) -> str:
    """A byte-pair vocabulary of single characters and a few merges, as JSON; all other characters are one unknown token each."""
    from tokenizers import Tokenizer, models

    whole = ["?", *dict.fromkeys(characters), *[a + b for a, b in merges]]
    names = {token: i for i, token in enumerate(dict.fromkeys(whole))}
    return Tokenizer(models.BPE(vocab=names, merges=merges, unk_token="?", fuse_unk=False)).to_str()
