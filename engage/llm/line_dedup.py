"""Removing lines that many documents share, with DataFrame functions alone.

Every text is split at line feeds.  A line's key is the line without ASCII white space at its ends and with A-Z
lower-cased; keys of ``MIN_CHARS`` code points or more stand as 128 bits of hash.  Keys are counted by different documents:
the count first meets equal (key, document) pairs, so a line that every document holds leaves each task as one row.
A key found in ``MIN_DOCS`` documents is repeated, and its lines go everywhere but in the largest document that holds it.

No task sees more than its share of a common line: fewer than ``HOT_KEYS`` keys can each be on more than that part of all
lines, so these few are broadcast, and the lines of all others are joined by key.  The positions to drop are collected
per document and taken out of the array of its lines.

Defined results: null and empty texts are one empty line; a document is its doc_id, so repeated rows of one id count
once and each keeps or loses its own lines alike; rows without an id count as one document that comes before all others;
a text of any number of lines is one row; columns other than doc_id and text are left alone; an empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from engage.llm.common import WHITE, texts
from engage.session import materialise

MIN_CHARS = 20
MIN_DOCS = 3
HOT_KEYS = 5_000
SEED = 0x5DEECE66D
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(WHITE.decode()))
    # lower() has a fast path for ASCII, but folds other letters too
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def rows_of(docs: DataFrame) -> DataFrame:
    """(doc_id, row, lines): ``row`` is the text's hash, so equal rows of one id are alike."""
    return texts(docs).select("doc_id", F.xxhash64("text").alias("row"), F.split("text", "\n").alias("lines"))


def long_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row, pos, high, low) of every line whose key is long enough."""
    lines = rows_of(docs).select("doc_id", "row", F.posexplode("lines").alias("pos", "line"))
    keys = lines.select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
    return keys.where(F.char_length("key") >= min_chars).select(
        "doc_id", "row", "pos", F.xxhash64("key").alias("high"), F.xxhash64(F.lit(SEED), "key").alias("low")
    )


def counted_keys(lines: DataFrame, min_docs: int, often: int) -> DataFrame:
    """(high, low, n_docs, n_lines, last_id) of the keys in ``min_docs`` documents or on more than ``often`` lines."""
    without = F.max(F.col("doc_id").isNull().cast("int"))
    counted = lines.groupBy("high", "low").agg(
        (F.count_distinct("doc_id") + without).alias("n_docs"),
        F.count(F.lit(1)).alias("n_lines"),
        F.max("doc_id").alias("last_id"),
    )
    return counted.where((F.col("n_docs") >= min_docs) | (F.col("n_lines") > often))


def dropped_lines(lines: DataFrame, keys: DataFrame, min_docs: int, often: int) -> DataFrame:
    """(doc_id, row, drops): the positions of every row that go."""
    gone = (F.col("n_docs") >= min_docs) & ~F.col("doc_id").eqNullSafe(F.col("last_id"))
    hot = F.broadcast(keys.where(F.col("n_lines") > often))
    found = lines.join(hot, ["high", "low"]).where(gone).select("doc_id", "row", "pos")
    rest = lines.join(hot, ["high", "low"], "left_anti").join(keys.where(F.col("n_lines") <= often), ["high", "low"])
    found = found.union(rest.where(gone).select("doc_id", "row", "pos"))
    return found.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("drops"))


def line_dedup(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, hot_keys: int = HOT_KEYS
) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped and the text that is kept."""
    lines = materialise(long_lines(docs, min_chars), "lines")
    # fewer than hot_keys keys can be on more lines than this
    often = lines.count() // hot_keys
    keys = materialise(counted_keys(lines, min_docs, often), "line-keys")
    drops = materialise(dropped_lines(lines, keys, min_docs, often), "line-drops").toDF("d", "r", "drops")
    rows = rows_of(docs).join(drops, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r")), "left")
    n_lines = F.size("lines").cast("long")
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drops")
    kept = F.when(F.col("drops").isNull(), F.col("lines")).otherwise(F.transform(left, lambda i: F.get("lines", i)))
    return rows.select(
        "doc_id",
        n_lines.alias("n_lines"),
        F.when(F.col("drops").isNull(), 0).otherwise(F.size("drops")).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"),
    )


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
n AS (SELECT row_no, doc_id, len(lines) AS n_lines, unnest(range(1, len(lines) + 1)) AS pos, lines FROM d),
l AS (SELECT row_no, doc_id, n_lines, pos, lines[pos] AS line FROM n),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS last_id FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.last_id AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, CAST(max(n_lines) AS BIGINT) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN gone THEN NULL ELSE line END, chr(10) ORDER BY pos), '')) AS kept_sha256
FROM m GROUP BY row_no, doc_id
"""
