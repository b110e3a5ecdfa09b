"""Keyed updates of a result table, and the difference of two snapshots, as joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from engage.operators.skew import common_keys


def _has_key(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for key in keys:
        out = out & F.col(key).isNotNull()
    return out


def _numbered(df: DataFrame, keys: Sequence[str], sign: int) -> DataFrame:
    """Add ``_row``: 0 where the key is complete, else a number of the row's own, so that such rows neither meet nor pile up."""
    own = F.monotonically_increasing_id() + 1
    return df.withColumn("_row", F.when(_has_key(keys), F.lit(0).cast("long")).otherwise(own * sign))


def _one_per_key(source: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Source rows by key; a repeated complete key fails the job, since the update would be ambiguous."""
    grouped = _numbered(source, keys, 1).groupBy(*keys, "_row").agg(
        F.count(F.lit(1)).alias("_n"), *[F.any_value(v).alias(f"_src_{v}") for v in values]
    )
    message = F.concat(F.lit("more than one source row for key "), F.to_json(F.struct(*keys)))
    checked = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(True)
    return grouped.withColumn("_in_source", checked).drop("_n")


def upsert(
    target: DataFrame,
    source: DataFrame,
    on: str | Sequence[str],
    update: Sequence[str] | Mapping[str, Column] | None = None,
    insert: bool = True,
) -> DataFrame:
    """The target after a merge: matched rows take the source's values, unmatched source rows are inserted.

    ``update`` names the columns to take, or maps a column to an expression over the target's own columns and
    the source's as ``_src_<name>``.  ``insert=False`` only updates.  As in a MERGE, a NULL key matches
    nothing: such target rows stay and such source rows are inserted.  One join reads either side once, so a source
    that would differ between reads cannot both update and insert a row.
    Write the result to a new path; never over the path being read.
    """
    keys = [on] if isinstance(on, str) else list(on)
    values = [c for c in source.columns if c not in keys]
    columns = target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    if update is None:
        update = [c for c in values if c in columns]
    if not isinstance(update, Mapping):
        update = {c: F.col(f"_src_{c}") for c in update}
    known, fresh = common_keys(target, source, keys)
    known = _numbered(known, keys, -1).withColumn("_in_target", F.lit(True))
    side = _one_per_key(fresh, keys, values)
    joined = known.join(side, [*keys, "_row"], "full" if insert else "left")
    # every source row's check is part of the result
    joined = joined.where(F.coalesce("_in_source", F.lit(True)))

    def merged(name: str) -> Column:
        if name in keys:
            return F.col(name)
        stays = F.when(F.col("_in_source"), update[name]).otherwise(F.col(name)) if name in update else F.col(name)
        added = F.col(f"_src_{name}") if name in values else F.lit(None)
        return F.when(F.col("_in_target"), stays).otherwise(added)

    return joined.select(*[merged(c).cast(types[c]).alias(c) for c in columns])


def change_feed(before: DataFrame, after: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows that differ between two snapshots with unique keys, with ``change_type`` insert, update or delete.

    An update shows the new values, a delete the old ones.  Equality treats NULLs as equal.
    """
    keys = [on] if isinstance(on, str) else list(on)
    values = [c for c in after.columns if c not in keys]
    old = before.select(*keys, F.struct(*values).alias("_old"))
    new = after.select(*keys, F.struct(*values).alias("_new"))
    joined = old.join(new, keys, "full")
    change = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_new").isNull(), "delete")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update")
    )
    return (
        joined.withColumn("change_type", change)
        .where("change_type is not null")
        .select(*keys, "change_type", F.coalesce("_new", "_old").alias("_row"))
        .select(*keys, "change_type", *[F.col("_row").getField(v).alias(v) for v in values])
    )
