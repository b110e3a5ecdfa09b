"""The registered queries of this subpackage, one per operator over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from engage.llm import (
    automaton_dedup,
    embed_dedup,
    exact_dedup,
    langid,
    licenses,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    periodic,
    prefix_trie,
    quality,
    suffix_dedup,
)
from engage.llm.common import read


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_dedup(read(spark, folder, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embed_dedup.embed_dedup(read(spark, folder, "embeddings"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(read(spark, folder, "documents"), packing.default_tokenizer())


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, folder, "documents"))


def op6_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.licence_scan(read(spark, folder, "documents"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(read(spark, folder, "documents"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents"))


def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.suffix_dedup(read(spark, folder, "documents")))


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return automaton_dedup.digest(automaton_dedup.automaton_dedup(read(spark, folder, "documents")))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.digest(prefix_trie.prefix_trie(prefix_trie.rebuilt(read(spark, folder, "conversations"))))


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(line_dedup.line_dedup(read(spark, folder, "documents")))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.digest(periodic.periodic_runs(periodic.with_runs(read(spark, folder, "documents"))))


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_licenses": op6_licenses,
    "op7_language_id": op7_language_id,
    "op8_mixing": op8_mixing,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_line_dedup": op12_line_dedup,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE = {
    "op5_exact_dedup": exact_dedup.ORACLE,
    "op6_licenses": licenses.ORACLE,
    "op8_mixing": mixing.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_line_dedup": line_dedup.ORACLE,
}
