"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Texts are word sequences.  A k-mer is five consecutive words together with how often it occurred before in the
text.  Each of ``ENTRIES`` sketch entries draws the ``PER_ENTRY`` k-mers with the smallest hashes under its seed and
keeps them in text order, so two texts agree in an entry only where k-mers and their order agree.  ``SHORTER`` adds
entries of shorter k-mers, drawn the same way: at the similarity itself, few k-mers of five words survive the edits, and
in short texts perhaps none.  Texts with equal word sequences are one class from the start.  Classes that agree in an entry are compared, first with the smallest of
them, then all pairs of what is not yet connected.  Buckets of up to ``PAIRED`` classes are paired by a join.  The classes of
larger ones, which share a common passage perhaps, meet by rare words instead: two texts that reach the similarity share one
of their ``allowed`` + 1 rarest words, whatever the rest, so no link between classes of large buckets is lost, and they are again compared
with the smallest text of a word and length first, then with all that are not yet connected; a word whose texts of fitting lengths
are connected is left out.  A pair is linked when its edit similarity, 1 - distance / longer length in
words, is at least ``SIMILARITY``: histograms of hashed words rule out most pairs by a bound on the distance before any
text is moved, a chain of common k-mers proves most others, the rest are aligned within a band that widens until the
distance or its limit fits in it.

Defined results: null text is empty; empty texts are one class; texts shorter than a k-mer have one, themselves; texts
of fewer words than any link allows have no entries and are linked by their class alone;
rows that share a doc_id count as one document; rows without doc_id are not linked beyond their class; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from engage.llm.common import binary_lists, in_parts, texts
from engage.llm.components import components
from engage.session import materialise

K = 5
ENTRIES = 48
PER_ENTRY = 2
# (k, entries, longest): entries of shorter k-mers, for texts of at most so many words; the last bound is 60 words over the
# similarity, so that both texts of a pair have them where one has at most 60.
SHORTER = ((3, 16, 1 << 62), (2, 32, 75))
SIMILARITY = 0.8
PAIRED = 12
BLOCK_ROWS = 4096
SHARD_ROWS = 8192
BINS = 64
# Two steps of finer bins: texts around a long common passage differ in words that few bins do not tell apart.
MIDDLE_BINS = 256
FINE_BINS = 1024
# Bins in which words are counted to tell rare ones, as a power of two.
RARE_BITS = 17
# Of a text's rare words, so many smallest hashes travel with its counts, so that a pair leaves only one shard.
LEAST = 64
# Bands of length in which a word's texts are told apart, to the ratio of lengths that the similarity allows.
BANDS = 4
CACHED_WORDS = 200_000
SEED = 1
BLOCK = 1 << 14
CELLS = 1 << 17
# Words, after padding to the longest, that are aligned at a time, and pairs that are read at a time.
PADDED = 1 << 20
VERIFIED = 2048
# Pairs of a shard that are looked at at a time.
PAIRS = 1 << 13
FAR = np.int32(1 << 29)


class WordHashes(dict):
    """32-bit hashes of words as four bytes; a bounded cache."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > CACHED_WORDS:
            self.clear()
        self[word] = value = zlib.crc32(word).to_bytes(4, "little")
        return value


def words_of(text: bytes, cache: WordHashes) -> np.ndarray:
    return np.frombuffer(b"".join(map(cache.__getitem__, text.split())), "<u4")


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums and products of hashes are spread again."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kmers(words: np.ndarray, k: int = K) -> np.ndarray:
    """A hash of every k-mer together with its occurrence number, in text order."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(k, n)
    value = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        value = value * np.uint64(0x9E3779B97F4A7C15) + words[i : n - k + 1 + i].astype(np.uint64) + np.uint64(1)
    value = mixed(value)
    order = np.argsort(value, kind="stable")
    ranked = value[order]
    fresh = np.r_[True, ranked[1:] != ranked[:-1]]
    if fresh.all():
        return value
    at = np.arange(len(value))
    number = np.empty(len(value), np.uint64)
    number[order] = at - np.maximum.accumulate(np.where(fresh, at, 0))
    # a first occurrence keeps its hash, so that texts with and without repeats agree
    return np.where(number == 0, value, mixed(value + number * np.uint64(0xD6E8FEB86659FD93)))


def seeds(entries: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    draw = lambda: rng.integers(1, 1 << 63, (entries, 1), dtype=np.uint64)
    return draw() | np.uint64(1), draw()


def smallest(values: np.ndarray, per_entry: int, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Positions, per entry, of its ``per_entry`` smallest k-mers, in text order."""
    found = []
    for start in range(0, len(values), BLOCK):
        part = values[start : start + BLOCK]
        keys = ((part * factors + shifts) >> np.uint64(32)).astype(np.uint32)
        rows = np.arange(len(keys))
        for _ in range(min(per_entry, len(part))):
            at = keys.argmin(axis=1)
            found.append((keys[rows, at], at + start))
            keys[rows, at] = np.iinfo(np.uint32).max
    keys, at = np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)
    best = np.argsort(keys, axis=1, kind="stable")[:, :per_entry]
    return np.sort(np.take_along_axis(at, best, 1), axis=1)


def sketch(words: np.ndarray, k: int, per_entry: int, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The sketch entries of a text, as signed 64-bit hashes; an empty text has none."""
    values = kmers(words, k)
    if not len(values):
        return np.zeros(0, np.int64)
    at = smallest(values, per_entry, factors, shifts)
    entry = np.arange(len(factors), dtype=np.uint64) + np.uint64(1)
    for i in range(at.shape[1]):
        entry = mixed(entry * np.uint64(0x9E3779B97F4A7C15) + values[at[:, i]])
    return entry.view(np.int64)


def drawn(k: int, entries: int, shorter=SHORTER) -> list:
    """(k, longest text, factors, shifts) of every kind of entry, in the order in which a text's entries stand."""
    return [(size, longest, *seeds(n)) for size, n, longest in [(k, entries, 1 << 62), *shorter]]


def entries_of(words: np.ndarray, kinds: list, per_entry: int = PER_ENTRY, similarity: float = SIMILARITY) -> np.ndarray:
    """All sketch entries of a text; one too short to be linked with any other text has none."""
    n = len(words)
    if allowed(n + 1, similarity) < 1:
        return np.zeros(0, np.int64)
    return np.concatenate([sketch(words, k, per_entry, *draw) for k, longest, *draw in kinds if n <= longest])


def histogram(words: np.ndarray, bins: int = BINS) -> bytes:
    return np.minimum(np.bincount(words % np.uint32(bins), minlength=bins), 65535).astype("<u2").tobytes()


def sketched(batches, kinds: list, per_entry: int, similarity: float):
    cache = WordHashes()
    for batch in in_parts(batches):
        whole = binary_lists(batch.column("text"))
        words = [words_of(t, cache) for t in whole]
        classes = [hashlib.blake2b(b" ".join(t.split()), digest_size=8).digest() for t in whole]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([int.from_bytes(c, "big", signed=True) for c in classes], pa.int64()),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array([entries_of(w, kinds, per_entry, similarity) for w in words], pa.list_(pa.int64())),
                pa.array([histogram(w) for w in words], pa.binary()),
            ],
            names=["doc_id", "class", "n_words", "entries", "bins"],
        )


def worded(batches):
    cache = WordHashes()
    for batch in in_parts(batches):
        words = [words_of(t, cache).tobytes() for t in binary_lists(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words, pa.binary())], names=["id", "words"])


def stacked(column, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width).astype(np.int32)


def possible(batches, similarity: float, bins: int = BINS):
    """The pairs whose lengths and word histograms allow the similarity."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = [np.asarray(batch.column(c)) for c in ("n_a", "n_b")]
        change = stacked(batch.column("bins_a"), "<u2", bins) - stacked(batch.column("bins_b"), "<u2", bins)
        least = np.maximum(np.maximum(change, 0).sum(axis=1), np.maximum(-change, 0).sum(axis=1))
        keep = least <= allowed(np.maximum(*lengths), similarity)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def allowed(longer, similarity: float):
    """The largest edit distance at which the similarity is still reached."""
    return np.floor((1 - similarity) * longer + 1e-9).astype(np.int64)


def trimmed(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both without their common first and last words, which an alignment never needs to touch."""
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    start = int(differ[0]) if len(differ) else n
    x, y = x[start:], y[start:]
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[len(x) - n :][::-1] != y[len(y) - n :][::-1])
    end = int(differ[0]) if len(differ) else n
    return x[: len(x) - end], y[: len(y) - end]


def least_distance(x: np.ndarray, y: np.ndarray) -> int:
    """A lower bound of the distance from the words that one side has more often."""
    _, inverse = np.unique(np.concatenate([x, y]), return_inverse=True)
    change = np.bincount(inverse[: len(x)], minlength=inverse.max(initial=-1) + 1) - np.bincount(
        inverse[len(x) :], minlength=inverse.max(initial=-1) + 1
    )
    return int(max(np.maximum(change, 0).sum(), np.maximum(-change, 0).sum()))


def rising(values: np.ndarray) -> np.ndarray:
    """Positions of a longest rising subsequence."""
    if (values[1:] > values[:-1]).all():
        return np.arange(len(values))
    ends, at, before = [], [], []
    for i, v in enumerate(values.tolist()):
        k = bisect_left(ends, v)
        before.append(at[k - 1] if k else -1)
        if k == len(ends):
            ends.append(v)
            at.append(i)
        else:
            ends[k], at[k] = v, i
    out, i = [], at[-1]
    while i >= 0:
        out.append(i)
        i = before[i]
    return np.array(out[::-1])


def most_distance(x: np.ndarray, y: np.ndarray, k: int = K) -> int:
    """An upper bound of the distance: common k-mers in rising order stand, what lies between them is replaced."""
    longer = max(len(x), len(y))
    if min(len(x), len(y)) < k:
        return longer
    _, i, j = np.intersect1d(kmers(x, k), kmers(y, k), assume_unique=True, return_indices=True)
    if not len(i):
        return longer
    order = np.argsort(i)
    i, j = i[order], j[order]
    chain = rising(j)
    i, j = i[chain], j[chain]
    # neighbours that overlap stand together only on one diagonal; elsewhere the later one gives up the words shared
    gap_x = np.r_[i, len(x)] - np.r_[0, i + k]
    gap_y = np.r_[j, len(y)] - np.r_[0, j + k]
    return int(np.where(np.minimum(gap_x, gap_y) < 0, np.abs(gap_x - gap_y), np.maximum(gap_x, gap_y)).sum())


def banded(pairs: list[tuple[np.ndarray, np.ndarray]], band: int) -> np.ndarray:
    """Edit distances of many pairs at once; exact where at most ``band``, else some larger number.

    Cell k of row i holds the distance of the first i words of x and the first i + k - band words of y.
    """
    count, width = len(pairs), 2 * band + 1
    n, m = np.array([len(x) for x, _ in pairs]), np.array([len(y) for _, y in pairs])
    rows = int(n.max(initial=0))
    xs = np.full((count, rows + 1), -1, np.int64)
    ys = np.full((count, rows + width + 1), -2, np.int64)
    for i, (x, y) in enumerate(pairs):
        xs[i, : len(x)] = x
        size = min(len(y), rows + width + 1 - band)
        ys[i, band : band + size] = y[:size]
    steps = np.arange(width, dtype=np.int32)
    line = np.where(steps >= band, steps - band, FAR).astype(np.int32)
    cells = np.repeat(line[None, :], count, axis=0)
    final = np.full(count, FAR, np.int32)
    end = np.clip(m - n + band, 0, width - 1)
    for i in range(rows + 1):
        done = n == i
        if done.any():
            final[done] = cells[done, end[done]]
        if i == rows:
            break
        moved = cells + (ys[:, i : i + width] != xs[:, i : i + 1])
        moved[:, :-1] = np.minimum(moved[:, :-1], cells[:, 1:] + 1)
        if i + 1 <= band:
            # the column before y begins: only deletions lead there
            moved[:, : band - i - 1] = FAR
            moved[:, band - i - 1] = i + 1
        cells = (np.minimum.accumulate(moved - steps, axis=1) + steps).astype(np.int32)
    return np.where(np.abs(m - n) <= band, final, FAR)


def portions(pairs: list, band: int):
    """Runs of pairs, which ascend by the length of their shorter side, of bounded cells and padded words."""
    most, start = max(1, CELLS // (2 * band + 1)), 0
    while start < len(pairs):
        end = start + 1
        while end < min(len(pairs), start + most) and (end + 1 - start) * len(pairs[end][1]) <= PADDED:
            end += 1
        yield pairs[start:end]
        start = end


def similar(pairs: list[tuple[np.ndarray, np.ndarray]], similarity: float = SIMILARITY) -> np.ndarray:
    """Whether each pair of word sequences has the edit similarity."""
    out = np.zeros(len(pairs), bool)
    limits = allowed(np.array([max(len(x), len(y)) for x, y in pairs]), similarity)
    open_ = []
    for i, (x, y) in enumerate(pairs):
        if abs(len(x) - len(y)) > limits[i]:
            continue
        x, y = trimmed(x, y)
        if not len(x) or not len(y):
            out[i] = max(len(x), len(y)) <= limits[i]
        elif most_distance(x, y) <= limits[i]:
            out[i] = True
        elif (least := least_distance(x, y)) <= limits[i]:
            x, y = (x, y) if len(x) <= len(y) else (y, x)
            open_.append((i, x.astype(np.int64), y.astype(np.int64), least + least // 4))
    band = 8
    while open_:
        # a pair waits for the first band that its distance may fit; one past its limit settles it
        wait = [min(band, limits[p[0]]) < max(len(p[2]) - len(p[1]), min(p[3], limits[p[0]])) for p in open_]
        now = [p for p, w in zip(open_, wait, strict=True) if not w]
        now.sort(key=lambda p: len(p[1]))
        later = [p for p, w in zip(open_, wait, strict=True) if w]
        for part in portions(now, band):
            for pair, d in zip(part, banded([(p[1], p[2]) for p in part], band), strict=True):
                if d <= band:
                    out[pair[0]] = d <= limits[pair[0]]
                elif band < limits[pair[0]]:
                    later.append(pair)
        open_ = later
        band *= 2
    return out


def verified(batches, similarity: float):
    for batch in in_parts(batches, VERIFIED):
        a, b = ([np.frombuffer(w, "<u4") for w in batch.column(c).to_pylist()] for c in ("words_a", "words_b"))
        keep = similar(list(zip(a, b, strict=True)), similarity)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def links_of(pairs: DataFrame, classes: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of class ids that reach the similarity."""
    facts = classes.select("id", "n_words", "bins")
    sides = pairs.join(facts.toDF("a", "n_a", "bins_a"), "a").join(facts.toDF("b", "n_b", "bins_b"), "b")
    near = sides.mapInArrow(lambda batches: possible(batches, similarity), "a long, b long")
    return verified_links(materialise(near, "pairs"), rows, similarity)


def words_by_id(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, words) of the texts with these doc_ids."""
    # the ids are hashed and the texts not sorted, whatever the sizes
    return rows.join(ids.hint("shuffle_hash"), "doc_id", "left_semi").mapInArrow(worded, "id long, words binary").distinct()


def verified_links(near: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    ids = near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct()
    words = materialise(words_by_id(rows, ids), "words")
    both = near.join(words.toDF("a", "words_a"), "a").join(words.toDF("b", "words_b"), "b")
    return both.mapInArrow(lambda batches: verified(batches, similarity), "a long, b long").distinct()


def rare_bins(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's words with their occurrence numbers, and the bins in which they are counted."""
    values = kmers(words, 1)
    return values, (values >> np.uint64(64 - RARE_BITS)).astype(np.int64)


def counted(batches):
    """In how many texts each bin's words occur."""
    total = np.zeros(1 << RARE_BITS, np.int64)
    for batch in in_parts(batches):
        for words in batch.column("words").to_pylist():
            np.add.at(total, rare_bins(np.frombuffer(words, "<u4"))[1], 1)
    bins = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(total[bins])], names=["bin", "n"])


def rarest(words: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """Of a text's rarest words, one more than the edits it may have, those that may occur in another text too.

    A text within ``allowed`` edits of the longer one of a pair lacks at most as many of its words; of the words that both
    have, the rarest one is among these of either.
    """
    values, bins = rare_bins(words)
    first = np.lexsort((values, counts[bins]))[: int(allowed(len(words), similarity)) + 1]
    return values[first][counts[bins[first]] > 1].view(np.int64)


def smallest_tokens(tokens: np.ndarray) -> np.ndarray:
    """The ``LEAST`` smallest, filled up with the largest number."""
    return np.r_[np.sort(tokens)[:LEAST], np.full(max(0, LEAST - len(tokens)), np.iinfo(np.int64).max)].astype("<i8")


def prefixed(batches, counts: np.ndarray, similarity: float):
    """Per text its tokens, and as ``bins`` the counts of hashed words, a byte each, and the smallest tokens."""
    for batch in in_parts(batches):
        words = [np.frombuffer(w, "<u4") for w in batch.column("words").to_pylist()]
        fine = [np.minimum(np.bincount(w % np.uint32(FINE_BINS), minlength=FINE_BINS), 255).astype("u1") for w in words]
        tokens = [rarest(w, counts, similarity) for w in words]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                pa.array([len(w) for w in words], pa.int64()),
                pa.array(tokens, pa.list_(pa.int64())),
                pa.array([f.tobytes() + smallest_tokens(t).tobytes() for f, t in zip(fine, tokens, strict=True)], pa.binary()),
            ],
            names=["id", "n_words", "tokens", "bins"],
        )


def met_before(first: np.ndarray, second: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Whether the texts of a pair are known, by their smallest tokens, to share one smaller than this."""
    out = np.zeros(len(token), bool)
    for at in range(0, len(token), 1024):
        x, y, t = (v[at : at + 1024] for v in (first, second, token))
        out[at : at + 1024] = ((x[:, :, None] == y[:, None, :]) & (x < t[:, None])[:, :, None]).any(axis=(1, 2))
    return out


def first_rows(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of pairs of rows, the first of each pair of ids."""
    _, at = np.unique(np.sort(ids[rows], axis=1), axis=0, return_index=True)
    return rows[np.sort(at)]


def meeting(group: pa.Table, similarity: float) -> pa.Table:
    """The pairs of a shard that share a token, are not yet connected, and whose lengths and histograms allow a link.

    A pair leaves where its smallest common token is, and again only if texts of many tokens do not tell that.
    """
    group = group.sort_by([(k, "ascending") for k in ("token", "i", "j", "block")])
    token, i, j, block, ids, n, c = (group.column(k).to_numpy() for k in ("token", "i", "j", "block", "id", "n_words", "c"))
    facts = np.frombuffer(b"".join(group.column("bins").to_pylist()), "u1").reshape(len(ids), -1)
    fine, least = facts[:, :FINE_BINS].astype(np.int16), np.ascontiguousarray(facts[:, FINE_BINS:]).view("<i8")
    coarse, middle = (fine.reshape(len(fine), -1, bins).sum(axis=1, dtype=np.int32) for bins in (BINS, MIDDLE_BINS))
    size = len(ids)
    at = np.arange(size)
    fresh = np.r_[True, (token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]
    starts = np.flatnonzero(fresh)
    run = np.cumsum(fresh) - 1
    end = np.r_[starts[1:], size][run]
    # rows of a run's first block stand in front of those of its second, which look for no partner of their own
    second = (starts + np.bincount(run, block == i).astype(np.int64))[run]
    begin = np.where(i == j, at + 1, np.where(block == i, second, end))
    partners = end - begin
    total = np.r_[0, np.cumsum(partners)]
    found = [np.zeros((0, 2), np.int64)]
    for low in range(0, int(total[-1]), PAIRS):
        pair = np.arange(low, min(low + PAIRS, int(total[-1])))
        left = np.searchsorted(total, pair, side="right") - 1
        right = begin[left] + pair - total[left]
        keep = c[left] != c[right]
        left, right = left[keep], right[keep]
        limits = allowed(np.maximum(n[left], n[right]), similarity)
        keep = np.abs(n[left] - n[right]) <= limits
        left, right, limits = left[keep], right[keep], limits[keep]
        for counts in (coarse, middle, fine):
            change = counts[left] - counts[right]
            more = np.maximum(change, 0).sum(axis=1)
            keep = np.maximum(more, more - change.sum(axis=1)) <= limits
            left, right, limits = left[keep], right[keep], limits[keep]
        found.append(first_rows(ids, np.stack([left, right], 1)))
    # the rows ascend by token, so these are of the smallest one here
    left, right = first_rows(ids, np.concatenate(found)).T
    fresh = ~met_before(least[left], least[right], token[left])
    left, right = ids[left[fresh]], ids[right[fresh]]
    return pa.table({"a": np.minimum(left, right), "b": np.maximum(left, right)})


def in_bands(tokens: DataFrame, similarity: float) -> DataFrame:
    """Rows with a ``band`` of their length: two lengths that allow the similarity are at most ``BANDS`` apart."""
    # a little wider than the similarity, so that rounding parts no pair
    width = math.log((1 + 1e-6) / similarity) / BANDS
    return tokens.withColumn("band", F.floor(F.log("n_words") / width))


def apart_by(tokens: DataFrame) -> DataFrame:
    """(token, band, hub, rows) of the bands with a text within reach, among all of the token, that is not connected.

    ``hub`` is the smallest of the band, ``rows`` counts the token's rows in all such bands.
    """
    spans = tokens.groupBy("token", "band").agg(
        F.min("c").alias("least"), F.max("c").alias("most"), F.min(F.struct("id", "n_words")).alias("hub"), F.count(F.lit(1)).alias("n")
    )
    # a token has as many bands as lengths allow, however many texts hold it
    reach = Window.partitionBy("token").orderBy("band").rangeBetween(-BANDS, BANDS)
    apart = spans.withColumns({"least": F.min("least").over(reach), "most": F.max("most").over(reach)}).where("least < most")
    return apart.select("token", "band", "hub", F.sum("n").over(Window.partitionBy("token")).alias("rows"))


def rare_words(members: DataFrame, rows: DataFrame, similarity: float) -> DataFrame:
    """Of the members' ids: (id, n_words, tokens, bins)."""
    words = materialise(words_by_id(rows, members.select(F.col("id").alias("doc_id"))), "words")
    # one number per bin, however many texts there are
    found = words.mapInArrow(counted, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << RARE_BITS, np.int64)
    counts[found.column("bin").to_numpy()] = found.column("n").to_numpy()
    return materialise(
        words.mapInArrow(
            lambda batches: prefixed(batches, counts, similarity), "id long, n_words long, tokens array<long>, bins binary"
        ),
        "facts",
    )


def tokens_of(facts: DataFrame, connected: DataFrame, similarity: float) -> DataFrame:
    """(token, band, id, n_words, c) of the texts, each connected so far as (id, c) says."""
    # texts meet what they are connected to before each becomes as many rows as it has tokens
    named = facts.select("id", "n_words", "tokens").join(connected, "id")
    return in_bands(named.select(F.explode("tokens").alias("token"), "id", "n_words", "c"), similarity)


def pairs_within(facts: DataFrame, tokens: DataFrame, similarity: float, block: int) -> DataFrame:
    """The pairs that share a token (token, band, id, n_words, c) and may be similar, found in tasks of bounded size."""
    apart = apart_by(tokens).select("token", "band", F.ceil(F.col("rows") / block).cast("int").alias("blocks"))
    dealt = tokens.join(apart, ["token", "band"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "n_words", "c"
    )
    dealt = materialise(dealt, "dealt")
    shards = 1 + dealt.count() // SHARD_ROWS
    bins = facts.select("id", "n_words", "bins")
    sharded = dealt.join(bins, ["id", "n_words"]).withColumn("shard", F.pmod(F.xxhash64("token", "i", "j"), F.lit(shards)))
    return sharded.groupBy("shard").applyInArrow(lambda group: meeting(group, similarity), "a long, b long").distinct()


def near_dedup(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    k: int = K,
    entries: int = ENTRIES,
    per_entry: int = PER_ENTRY,
    shorter=SHORTER,
    paired: int = PAIRED,
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per document: doc_id, class_id (equal word sequences), component_id, n_words, kept."""
    rows = texts(docs)
    kinds = drawn(k, entries, shorter)
    sketches = materialise(
        rows.mapInArrow(
            lambda batches: sketched(batches, kinds, per_entry, similarity),
            "doc_id long, class long, n_words long, entries array<long>, bins binary",
        ),
        "sketches",
    )
    # a class's rows have the same sketch; its smallest doc_id stands for it
    classes = materialise(
        sketches.groupBy("class", "n_words").agg(
            F.min("doc_id").alias("id"), F.first("entries").alias("entries"), F.first("bins").alias("bins")
        ),
        "classes",
    )
    placed = classes.where("id is not null").select("id", "n_words", F.explode("entries").alias("entry"))
    buckets = (
        placed.groupBy("entry")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "n_words")).alias("hub"))
        .where("n > 1")
    )
    members = materialise(placed.join(buckets, "entry"), "members")
    fits = F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * similarity
    pair = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    stars = members.select(F.col("hub.id").alias("a"), "id", F.col("hub.n_words").alias("n_a"), F.col("n_words").alias("n_b"))
    stars = stars.withColumnRenamed("id", "b").where("a <> b").where(fits).select(*pair).distinct()
    tested = materialise(stars, "stars")
    links = materialise(links_of(tested, classes, rows, similarity), "verified")
    groups = components(links)
    # what of a bucket is still apart
    named = members.select("entry", "id", "n_words", "n").join(groups.withColumnRenamed("node", "id"), "id", "left")
    named = materialise(named.withColumn("c", F.coalesce("component_id", "id")).drop("component_id"), "named")
    spans = named.groupBy("entry").agg(F.min("c").alias("least"), F.max("c").alias("most")).where("least < most")
    apart = materialise(named.join(spans.select("entry"), "entry"), "apart")
    small = apart.where(F.col("n") <= paired)
    side = lambda s: small.select("entry", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "n_words", "c")])
    both = side("a").join(side("b"), "entry").where("id_a < id_b and c_a <> c_b")
    pairs = both.selectExpr("id_a a", "id_b b", "n_words_a n_a", "n_words_b n_b").where(fits).select(*pair)
    large = materialise(apart.where(F.col("n") > paired).select("id", "c").distinct(), "large")
    crowded = not large.isEmpty()
    if crowded:
        facts = rare_words(large, rows, similarity)
        near = tokens_of(facts, large, similarity)
        hubs = near.join(apart_by(near), ["token", "band"]).where("id <> hub.id")
        hubs = hubs.select(F.col("hub.id").alias("a"), F.col("id").alias("b"), F.col("hub.n_words").alias("n_a"), F.col("n_words").alias("n_b"))
        pairs = pairs.union(hubs.where(fits).select(*pair))
    pairs = materialise(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "rest")
    more = links_of(pairs, classes, rows, similarity)
    groups = components(groups.toDF("a", "b").union(more))
    if crowded:
        now = large.join(groups.withColumnRenamed("node", "id"), "id", "left")
        now = tokens_of(facts, now.select("id", F.coalesce("component_id", "c").alias("c")), similarity)
        near = materialise(pairs_within(facts, now, similarity, block), "pairs")
        groups = components(groups.toDF("a", "b").union(verified_links(near, rows, similarity)))
    named = classes.select("class", "n_words", "id").join(groups.withColumnRenamed("node", "id"), "id", "left")
    return sketches.select("doc_id", "class", "n_words").join(
        named.select("class", "n_words", F.col("id").alias("class_id"), F.coalesce("component_id", "id").alias("component_id")),
        ["class", "n_words"],
    ).select(
        "doc_id",
        "class_id",
        "component_id",
        "n_words",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
