"""Table sinks: parquet writes, schema alignment, routed output."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Fixed value: characters a table column name may not hold.
FORBIDDEN = " ,;{}()\n\t="


def sanitize_names(names: Sequence[str]) -> list[str]:
    """Forbidden characters become ``_``; a name already taken gets ``_dup``, then ``_dup2`` and on."""
    out: list[str] = []
    for name in names:
        clean = re.sub(f"[{re.escape(FORBIDDEN)}]", "_", name)
        candidate, n = clean, 1
        while candidate in out:
            candidate = f"{clean}_dup{n if n > 1 else ''}"
            n += 1
        out.append(candidate)
    return out


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*sanitize_names(df.columns))


def align_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast shared columns, add missing ones as typed NULLs, drop the rest, in the target's order.

    A value that does not fit the target type becomes NULL.
    """
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields
        ]
    )


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add absent columns (name -> type) as NULL."""
    missing = {n: F.lit(None).cast(t) for n, t in columns.items() if n not in df.columns}
    return df.withColumns(missing) if missing else df


def add_table_columns(spark: SparkSession, table: str, columns: dict[str, str]) -> list[str]:
    """Add absent columns to a catalog table; returns the ones added."""
    have = {c.lower() for c in spark.table(table).columns}
    missing = {n: t for n, t in columns.items() if n.lower() not in have}
    if missing:
        listed = ", ".join(f"`{n}` {t}" for n, t in missing.items())
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({listed})")
    return list(missing)


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).limit(0).collect()
        return True
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return False
        raise


def write_parquet(df: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> None:
    """Snappy parquet.  ``files=1`` is for small logs only; by default the writers stay as they are."""
    out = df.coalesce(files) if files else df
    out.write.mode(mode).option("compression", "snappy").parquet(path)


def append_aligned(df: DataFrame, path: str) -> str:
    """Append to a parquet table, aligned to its schema; the first batch creates it.  Returns what was done."""
    spark = df.sparkSession
    clean = sanitize_columns(df)
    if not path_exists(spark, path):
        write_parquet(clean, path, mode="errorifexists")
        return "created"
    write_parquet(align_to_schema(clean, spark.read.parquet(path).schema), path, mode="append")
    return "appended"


def replace_parts(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write to a parquet table laid out by ``by``, aligned to its schema; parts written before are replaced."""
    spark = df.sparkSession
    clean = sanitize_columns(df)
    if path_exists(spark, path):
        known = spark.read.parquet(path).schema
        kinds = {f.name: f.dataType for f in clean.schema.fields}
        # a table without rows yet has lost its part columns
        extra = [T.StructField(c, kinds[c]) for c in by if c not in known.names]
        clean = align_to_schema(clean, T.StructType([*known.fields, *extra]))
    writer = clean.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.parquet(path)


def write_routed(
    selected: DataFrame, path: str, by: Sequence[str] = ("lob", "run_date", "feed"), mode: str = "overwrite"
) -> None:
    """Selected documents laid out by line of business, run date and feed.

    Overwriting replaces only the partitions written, so a rerun of a day leaves one copy; ``append`` adds.
    The rebalance hint gathers small partitions and splits a hot one, so neither many tiny files nor one
    giant writer results.
    """
    writer = selected.hint("rebalance", *by).write.mode(mode).partitionBy(*by)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
