"""Periodic runs of words, and texts without their repetitions.

A run is a stretch of words with a smallest period q, at least ``MIN_WORDS`` and three periods long, that no neighbouring word
extends.

1. Periods are sorted into octaves, 2^k <= q < 2^(k+1); those below 8 are one octave.  A document is exploded into
   overlapping tiles per octave: one around every multiple b of 2^k, four octave steps to either side.  A run of an octave
   contains such a b with a whole period before it and a step behind it, so the step at b also starts q words earlier.
   Tiles where no 64-bit hash says so are passed over, which loses nothing.
2. Every other tile is solved by itself: the Z-function of what follows b, over what precedes it, gives how far each
   period reaches to the right, and the Z-function of what precedes b, read backwards, how far to the left.
   Multiples of a period reach as far as it does and are left out.
3. Fragments are shuffled by document and period, and those that overlap by a period are stitched.
4. Documents with runs meet them again, and each run is cut down to its first period.

Documents of up to ``SEGMENT_WORDS`` words are solved where they are read, many at a time.  Longer ones leave that task as segments
of tiles, a few octaves each, dealt to all tasks; stitching joins what the borders of segments cut.

Defined results: null text has no words and no run; repeated rows of one id and text are alike; an empty table gives an
empty result; columns other than doc_id and text are left alone; a text of any length is one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from engage.llm.common import WHITE, binary_lists, in_parts
from engage.llm.repeats import keyed
from engage.session import materialise

MIN_WORDS = 24
REPEATS = 3
LOWEST = 3
SEGMENT_WORDS = 1 << 16
BATCH_WORDS = 1 << 17
ODD = np.uint64(0x9E3779B97F4A7C15)

DOC = "doc struct<id:string,hash:bigint>"
RUN = "struct<start:bigint,length:bigint,period:bigint>"
EXPLODED = (
    f"doc_id long, {DOC}, n_words long, whole_sha256 string, text binary, "
    "found array<struct<period:bigint,start:bigint,end:bigint>>, first int, last int, base long, codes binary"
)


def folded(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two neighbours' hashes."""
    x = a * ODD + b
    x ^= x >> np.uint64(32)
    return x * ODD


def z_values(s: list, stop: int) -> list[int]:
    """The Z-function of ``s`` at 1 to ``stop``: how many symbols from there on equal those at the start."""
    z, left, right, n = [0] * stop, 0, 0, len(s)
    for i in range(1, stop):
        k = z[i - left] if i < right else 0
        if i + k >= right:
            k = max(0, right - i)
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def gated(codes: np.ndarray, grams: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """(boundary, period) wherever the step at a boundary may also start one period earlier."""
    rows = (len(grams) - 1) // step
    found = []
    if step == 1 << LOWEST and rows >= 1:
        before = grams[1 : 1 + rows * step].reshape(rows, step)[:, :-1]
        row, column = np.nonzero(before == grams[step : rows * step + 1 : step, None])
        found.append(((row + 1) * step, step - 1 - column))
    if rows >= 2:
        before = grams[1 : 1 + (rows - 1) * step].reshape(rows - 1, step)
        row, column = np.nonzero(before == grams[2 * step : rows * step + 1 : step, None])
        found.append(((row + 2) * step, 2 * step - 1 - column))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    boundary, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, boundary))
    return boundary[order], period[order]


def in_tile(codes: np.ndarray, b: int, periods: list[int], step: int) -> Iterator[tuple[int, int, int]]:
    """(period, start, end) of what repeats around b with one of the periods, as far as the tile reaches."""
    reach, most = 4 * step, 2 * step
    before, after = codes[max(0, b - reach) : b].tolist(), codes[b : b + reach].tolist()
    near = before[-most:]
    right = z_values([*after, None, *near, *after], len(after) + 1 + len(near))[len(after) + 1 :]
    left = z_values(before[::-1], min(most, len(before)))
    # what a smaller period covers as far has that one, and this is a multiple of it
    least: dict[tuple[int, int], int] = {}
    for p in range(1, min(len(left), periods[-1] + 1)):
        least.setdefault((p + left[p], right[len(near) - p]), p)
    for q in periods:
        l, r = left[q] if q < len(left) else 0, right[len(near) - q]
        p = least.get((q + l, r), q)
        if r < step or p < q and q % p == 0:
            continue
        cut = l == len(before) - q or r == len(after)
        if cut or q + l + r >= max(MIN_WORDS, REPEATS * q):
            yield q, b - q - l, b + r


def fragments(codes: np.ndarray, first: int, last: int, ends: list[int] | None = None) -> list[tuple[int, int, int]]:
    """(period, start, end) found in the tiles of octaves ``first`` to ``last``; octave k's lie before ``ends[k]``."""
    out = []
    with np.errstate(over="ignore"):
        grams = (codes.astype(np.uint64) + np.uint64(1)) * ODD
        size = 1
        for k in range(first, last + 1):
            end = len(codes) if ends is None else ends[k]
            step = 1 << k
            if end < REPEATS * step:
                break
            while size < step:
                grams = folded(grams[:-size], grams[size:])
                size *= 2
            codes, grams = codes[:end], grams[: end - step + 1]
            boundary, period = gated(codes, grams, step)
            cuts = np.flatnonzero(np.diff(boundary)) + 1
            for b, periods in zip(
                boundary[np.r_[0, cuts]].tolist() if len(boundary) else [], np.split(period, cuts), strict=len(boundary) > 0
            ):
                out.extend(in_tile(codes, b, periods.tolist(), step))
    return out


def stitched(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Fragments of one document joined where they overlap by a period."""
    out: list[tuple[int, int, int]] = []
    for q, start, end in sorted(found):
        if out and out[-1][0] == q and start <= out[-1][2] - q:
            if end > out[-1][2]:
                out[-1] = (q, out[-1][1], end)
        else:
            out.append((q, start, end))
    return out


def octave_of(n: int) -> int:
    """The highest octave that a run in n words can have."""
    return max(LOWEST, (n // REPEATS).bit_length() - 1)


def segments(codes: np.ndarray, size: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(first octave, last octave, base, words) of a long document: tiles of a few octaves, side by side."""
    highest = octave_of(len(codes))
    first, last = LOWEST, max(LOWEST, size.bit_length() - 6)
    while first <= highest:
        last = min(last, highest)
        reach = 4 << last
        span = max(size, 2 * reach)
        for at in range(0, len(codes), span):
            base = max(0, at - reach)
            yield first, last, base, codes[base : at + span + reach]
        first, last = last + 1, last + 3


def numbered(words: list[bytes]) -> np.ndarray:
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)


def solved_together(texts: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """Fragments of several documents, solved as one text whose parts never meet: the longest first, a fresh symbol after each."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    starts, parts, at = [], [], 0
    for number, i in enumerate(order):
        starts.append(at)
        parts += [texts[i], np.array([(1 << 40) + number])]
        at += len(texts[i]) + 1
    sizes = np.array([len(texts[i]) for i in order])
    highest = octave_of(int(sizes[0]))
    bounds = np.r_[starts, at]
    ends = [int(bounds[int((sizes >= max(MIN_WORDS, REPEATS << k)).sum())]) for k in range(highest + 1)]
    ends[LOWEST] = int(bounds[int((sizes >= MIN_WORDS).sum())])
    out: list[list] = [[] for _ in texts]
    found = fragments(np.concatenate(parts), LOWEST, highest, ends)
    owners = np.searchsorted(starts, [start for _, start, _ in found], "right") - 1
    for (q, start, end), owner in zip(found, owners.tolist(), strict=True):
        out[order[owner]].append((q, start - starts[owner], end - starts[owner]))
    return [stitched(x) for x in out]


def exploded(batches, segment: int):
    """Documents with their fragments; of a long document, rows of its tiles instead."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("doc", pa.struct([("id", pa.string()), ("hash", pa.int64())])),
            ("n_words", pa.int64()),
            ("whole_sha256", pa.string()),
            ("text", pa.binary()),
            ("found", pa.list_(pa.struct([("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))),
            ("first", pa.int32()),
            ("last", pa.int32()),
            ("base", pa.int64()),
            ("codes", pa.binary()),
        ]
    )

    def give(rows):
        return pa.RecordBatch.from_pylist(rows, schema=schema)

    for batch in in_parts(batches):
        rows, short, texts, held = [], [], [], 0

        def close():
            for row, found in zip(short, solved_together(texts), strict=True):
                row["found"] = [dict(zip(("period", "start", "end"), x, strict=True)) for x in found]
                row["text"] = row["text"] if found else None

        columns = [batch.column(c).to_pylist() for c in ("doc_id", "doc")]
        for doc_id, doc, text in zip(*columns, binary_lists(batch.column("text")), strict=True):
            words = text.split()
            row = {"doc_id": doc_id, "doc": doc, "n_words": len(words), "text": text, "found": []}
            row["whole_sha256"] = hashlib.sha256(b" ".join(words)).hexdigest()
            rows.append(row)
            if len(words) < MIN_WORDS:
                row["text"] = None
            elif len(words) <= segment:
                short.append(row)
                texts.append(numbered(words))
                held += len(words)
                if held > BATCH_WORDS:
                    close()
                    short, texts, held = [], [], 0
            else:
                for first, last, base, codes in segments(numbered(words), segment):
                    yield give([{"doc": doc, "first": first, "last": last, "base": base, "codes": codes.astype("<i4").tobytes()}])
        if short:
            close()
        yield give(rows)


def solved(batches):
    """Fragments of dealt segments."""
    for batch in in_parts(batches, 1):
        (row,) = batch.select(["doc", "first", "last", "base", "codes"]).to_pylist()
        codes = np.frombuffer(row["codes"], "<i4").astype(np.int64)
        found = stitched(fragments(codes, row["first"], row["last"]))
        q, start, end = np.array(found, np.int64).reshape(-1, 3).T
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([row["doc"]] * len(found), batch.schema.field("doc").type),
                pa.array(q),
                pa.array(start + row["base"]),
                pa.array(end + row["base"]),
            ],
            names=["doc", "period", "start", "end"],
        )


def stitch(found: DataFrame) -> DataFrame:
    """(doc, start, length, period) of the runs that fragments (doc, period, start, end) make up."""
    order = Window.partitionBy("doc", "period").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (reach.isNull() | (F.col("start") > reach - F.col("period"))).cast("long")
    islands = found.distinct().withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(order))
    runs = islands.groupBy("doc", "period", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start")
    runs = runs.select("doc", "start", length.alias("length"), "period")
    return runs.where(F.col("length") >= F.greatest(F.lit(MIN_WORDS), REPEATS * F.col("period")))


def collapsed(batches):
    """Documents with each run cut to its first period, and the run of the greatest exponent."""
    run = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    for batch in in_parts(batches):
        best, kept, digests = [], [], []
        columns = [batch.column(c).to_pylist() for c in ("runs", "whole_sha256")]
        for text, runs, whole in zip(binary_lists(batch.column("text")), *columns, strict=True):
            if not runs:
                best.append(None)
                kept.append(None)
                digests.append(whole)
                continue
            best.append(min(runs, key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"])))
            words = text.split()
            change = np.zeros(len(words) + 1, np.int64)
            for r in runs:
                change[r["start"] + r["period"]] += 1
                change[r["start"] + r["length"]] -= 1
            gone = np.cumsum(change) > 0
            rest = b" ".join([w for w, g in zip(words, gone[:-1].tolist(), strict=True) if not g])
            kept.append(rest)
            digests.append(hashlib.sha256(rest).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("n_words"),
                batch.column("runs").cast(pa.list_(run)),
                pa.array(best, run),
                pa.array(kept, pa.binary()),
                pa.array(digests, pa.string()),
            ],
            names=["doc_id", "n_words", "runs", "best", "kept", "collapsed_sha256"],
        )


def periodic_runs(docs: DataFrame, segment: int = SEGMENT_WORDS) -> DataFrame:
    """One row per document: doc_id, n_words, its runs by start and period, the best, kept (null: all) and collapsed_sha256."""
    table = materialise(keyed(docs).mapInArrow(lambda b: exploded(b, segment), EXPLODED), "tiles")
    whole = table.where("codes is null")
    dealt = table.where("codes is not null").select("doc", "first", "last", "base", "codes")
    far = dealt.repartition("doc", "first", "base").mapInArrow(solved, f"{DOC}, period long, start long, end long")
    near = whole.where("text is not null").select("doc", F.inline("found"))
    runs = stitch(near.union(far)).groupBy(F.col("doc").alias("d")).agg(
        F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs")
    )
    runs = materialise(runs, "runs")
    none = F.array().cast(f"array<{RUN}>")
    plain = whole.where("text is null").select(
        "doc_id", "n_words", none.alias("runs"), F.lit(None).cast(RUN).alias("best"),
        F.lit(None).cast("binary").alias("kept"), F.col("whole_sha256").alias("collapsed_sha256"),
    )
    cut = (
        whole.where("text is not null")
        .join(runs, F.col("doc") == F.col("d"), "left")
        .select("doc_id", "n_words", "whole_sha256", "text", F.coalesce("runs", none).alias("runs"))
        .mapInArrow(
            collapsed,
            f"doc_id long, n_words long, runs array<{RUN}>, best {RUN}, kept binary, collapsed_sha256 string",
        )
    )
    return plain.union(cut)


def digest(found: DataFrame) -> DataFrame:
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


def with_runs(docs: DataFrame) -> DataFrame:
    """The documents, a tenth of them by the hash of their id continued periodically from some word on."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.btrim(text, F.lit(WHITE.decode()))
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.split(bare, r"[\x20\x09-\x0D]+")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    turns = F.ceil((n - a) / p).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), turns)), 1, n - a)
    grown = F.array_join(F.concat(F.slice(words, 1, a), tail), " ")
    return docs.select("doc_id", F.when((h % 10 == 0) & (bare != ""), grown).otherwise(text).alias("text"))
