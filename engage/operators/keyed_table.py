"""A result table laid out by key hash, so that a merge reads and writes only the parts its source touches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from engage.operators.merge import upsert
from engage.session import materialise

PART = "_part"


def _part(keys: Sequence[str], types: Mapping[str, object], parts: int, rest: Sequence[str]) -> Column:
    """The part of a row: by its key, or by the whole row where the key has a NULL, since such a row meets no other."""
    own = F.xxhash64(*[F.col(k).cast(types[k]) for k in keys])
    whole = F.xxhash64(*keys, *rest)
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return F.pmod(F.when(missing, whole).otherwise(own), F.lit(parts)).cast("int")


def create(df: DataFrame, path: str, on: str | Sequence[str], parts: int) -> None:
    """Write ``df`` in ``parts`` folders by a hash of its key; the keys and the number of parts are kept beside them."""
    keys = [on] if isinstance(on, str) else list(on)
    types = {f.name: f.dataType for f in df.schema.fields}
    rest = [c for c in df.columns if c not in keys]
    dealt = df.withColumn(PART, _part(keys, types, parts, rest))
    dealt.repartition(parts, PART).write.mode("overwrite").partitionBy(PART).parquet(f"{path}/rows")
    df.sparkSession.createDataFrame([(keys, parts)], "keys array<string>, parts int").write.mode("overwrite").parquet(f"{path}/layout")


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop(PART)


def merge_into(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    update: Sequence[str] | Mapping[str, Column] | None = None,
    insert: bool = True,
) -> list[int]:
    """``merge.upsert`` of the source into the table at ``path``, in place; returns the parts that were replaced.

    The source is written once and the parts of its keys are listed (as many numbers as there are parts, at most).  Only
    these folders are read, joined and replaced; the merged rows stand in the shared folder before the first folder is replaced, and
    running the same merge again gives the same table.  A NULL key matches nothing; its rows are inserted by their own
    hash, so many of them do not meet in one part.
    """
    layout = spark.read.parquet(f"{path}/layout").first()
    keys, parts = list(layout["keys"]), layout["parts"]
    stored = spark.read.parquet(f"{path}/rows")
    columns = [c for c in stored.columns if c != PART]
    types = {f.name: f.dataType for f in stored.schema.fields}
    rest = [c for c in source.columns if c not in keys]
    dealt = materialise(source.withColumn(PART, _part(keys, types, parts, rest)), "source")
    touched = sorted(r[PART] for r in dealt.select(PART).distinct().collect())
    if not touched:
        return []
    target = stored.where(F.col(PART).isin(touched)).select(*columns)
    merged = upsert(target, dealt.drop(PART), keys, update, insert)
    # a target row's part follows from its key; one without a key stays in one of the parts read
    placed = materialise(merged.withColumn(PART, _placed(keys, types, parts, columns, touched)), "merged")
    writer = placed.repartition(len(touched), PART).write.mode("overwrite").partitionBy(PART)
    writer.option("partitionOverwriteMode", "dynamic").parquet(f"{path}/rows")
    left = {r[PART] for r in placed.select(PART).distinct().collect()}
    return [p for p in touched if p in left]


def _placed(keys, types, parts, columns, touched) -> Column:
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    rest = [c for c in columns if c not in keys]
    spread = F.element_at(F.array(*[F.lit(p) for p in touched]), (F.pmod(F.xxhash64(*rest), F.lit(len(touched))) + 1).cast("int"))
    return F.when(missing, spread).otherwise(_part(keys, types, parts, rest))
