"""A corpus pipeline: documents in, packed training sequences out.

STAGES are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns what it keeps.  ``run`` writes
each stage's result as Parquet to the shared folder and gives the table, read again, to the next.  All stages but the
last return the columns of ``documents``.

Each stage's result is defined for its operator's special cases: null and empty texts have no letter, so language
identification removes them; exact dedup decides by row, so of repeated rows of one doc_id and text one stays, with or
without an id; near dedup decides by doc_id, so different texts under one id stand or fall together; other columns are
carried along; an empty table passes through every stage as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from engage.llm import exact_dedup, langid, mixing, near_dedup, packing
from engage.llm.common import WHITE, read
from engage.session import delete, materialise, scratch, shared_dir


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known and not rejected."""
    return langid.accepted(docs)


def chosen(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id has a kept decision, null ids included."""
    ids = decisions.where("kept").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_kept_id"))
    # the ids are the side that is hashed; the texts are not sorted
    right = ids.distinct().hint("shuffle_hash")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return docs.join(right, key == F.col("_kept_id"), "left_semi")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts; where rows share the id that stays, one with the most code points."""
    decided = exact_dedup.exact_dedup(docs).where("kept").groupBy("doc_id", "text_sha256")
    # a table, so that its size is known where the few repeated ones are joined
    kept = materialise(decided.agg(F.count(F.lit(1)).alias("n")), "kept")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("id"),
        F.sha2(F.translate(text, WHITE.decode(), ""), 256).alias("sha"),
        F.struct(F.length(text), F.xxhash64(text)).alias("rank"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
    )
    same = lambda right: rows["id"].eqNullSafe(right["doc_id"]) & (rows["sha"] == right["text_sha256"])
    # the keys are the side that is hashed; the texts are not sorted
    single = kept.where("n = 1").hint("shuffle_hash")
    once = rows.join(single, same(single), "left_semi").select("row.*")
    repeated = kept.where("n > 1")
    if repeated.isEmpty():
        return once
    several = rows.join(repeated, same(repeated), "left_semi").groupBy("id", "sha").agg(F.max_by("row", "rank").alias("row"))
    return once.union(several.select("row.*"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return chosen(docs, near_dedup.near_dedup(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: a row for every pass over a document."""
    return mixing.curriculum(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row of the mix and where they lie."""
    return packing.packed(docs, packing.default_tokenizer())


STAGES = [
    ("language ID", keep_languages),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

# Language identification and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote on the way goes when its result stands, and that with the next."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = shared_dir(spark, name.replace(" ", "-"))
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
