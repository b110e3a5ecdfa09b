"""Categories as numbers: running label means in a random order, in which no row sees its own label."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from engage.operators.ranking import hashed_key, null_safe
from engage.operators.skew import fits
from engage.session import materialise

PRIOR = 0.5
STRENGTH = 1.0
# Rows of one category that a task orders; a category with more is cut into buckets of the order.
BUCKET_ROWS = 200_000


def _mean(total: Column, n: Column, prior: float, strength: float) -> Column:
    return (F.coalesce(total, F.lit(0.0)) + prior * strength) / (F.coalesce(n, F.lit(0)) + strength)


def ordered_stats(
    df: DataFrame,
    column: str,
    label: str,
    key: str,
    name: str | None = None,
    prior: float = PRIOR,
    strength: float = STRENGTH,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Add the mean label of earlier rows of the same category, as ``name`` (default ``<column>_target``).

    Rows are ordered by md5 of the key, and ``strength`` rows of label ``prior`` come first.  Rows of one key see neither each
    other nor themselves.  NULL is a category; NULL labels count nowhere.  The order is cut into buckets by the hash: sums per
    (category, bucket) are a small table whose running totals lead each bucket, so that no task orders a whole
    category that holds most rows.  The rows are counted, so ``df`` should be a table.
    """
    buckets = max(1, math.ceil(df.count() / bucket_rows))
    order = hashed_key(key)
    # the leading 32 bits of the hash, cut evenly
    bucket = F.floor(F.conv(F.substring(order, 1, 8), 16, 10).cast("long") * buckets / 2**32)
    known = F.when(F.col(column).isNull(), "null").otherwise(F.concat(F.lit("="), F.col(column).cast("string")))
    rows = df.withColumns({"_category": known, "_bucket": bucket, "_order": order, "_y": F.col(label).cast("double")})
    sums = rows.groupBy("_category", "_bucket").agg(F.sum("_y").alias("_s"), F.count("_y").alias("_n"))
    before = Window.partitionBy("_category").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    lead = sums.select("_category", "_bucket", F.sum("_s").over(before).alias("_lead_s"), F.sum("_n").over(before).alias("_lead_n"))
    joined = rows.join(lead, ["_category", "_bucket"])
    inside = Window.partitionBy("_category", "_bucket").orderBy("_order").rangeBetween(Window.unboundedPreceding, 0)
    same = Window.partitionBy("_category", "_bucket", "_order")

    def earlier(lead_: str, what: Column) -> Column:
        # all up to this hash, less those of this hash
        return F.coalesce(lead_, F.lit(0)) + F.coalesce(what.over(inside), F.lit(0)) - F.coalesce(what.over(same), F.lit(0))

    value = _mean(earlier("_lead_s", F.sum("_y")), earlier("_lead_n", F.count("_y")), prior, strength)
    return joined.withColumn(name or f"{column}_target", value).drop(
        "_category", "_bucket", "_order", "_y", "_lead_s", "_lead_n"
    )


def target_table(df: DataFrame, column: str, label: str, prior: float = PRIOR, strength: float = STRENGTH) -> DataFrame:
    """Rows (column, target): the category's whole mean, for rows that were not trained on."""
    sums = df.groupBy(column).agg(F.sum(F.col(label).cast("double")).alias("_s"), F.count(label).alias("_n"))
    return sums.select(column, _mean(F.col("_s"), F.col("_n"), prior, strength).alias("target"))


def encode(df: DataFrame, table: DataFrame, column: str, name: str | None = None, prior: float = PRIOR) -> DataFrame:
    """Add a written ``target_table``'s value; a category it does not hold has the prior."""
    side = table.select(F.col(column).alias("_of"), F.col("target").alias("_target"))
    match = F.col(column).eqNullSafe(F.col("_of"))
    found = df.join(F.broadcast(side) if fits(table) else side, match, "left")
    return found.withColumn(name or f"{column}_target", F.coalesce("_target", F.lit(prior))).drop("_of", "_target")


def encode_all(
    train: DataFrame, others: Sequence[DataFrame], columns: Sequence[str], label: str, key: str, **settings: float
) -> list[DataFrame]:
    """The training rows with ordered statistics of every column, and other frames with the whole tables of the training rows."""
    tables = {c: materialise(target_table(train, c, label, **settings), f"targets-{c}") for c in columns}
    out = [train, *others]
    for c, table in tables.items():
        out = [ordered_stats(out[0], c, label, key, **settings), *[encode(o, table, c) for o in out[1:]]]
    return out
