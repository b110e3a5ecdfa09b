"""Attach member, area and provider facts to rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from engage.operators.skew import join_lookup, join_repeated, keyed_join

# Fixed value: shown where no line of business is known.
NOT_AVAILABLE = "Not Available"


def member_keys(calls: DataFrame, key: str = "member_key") -> DataFrame:
    """Distinct non-blank member keys of the calls."""
    return calls.where(F.col(key).isNotNull() & (F.col(key) != "")).select(key).distinct()


def prefix_semi_join(
    members: DataFrame,
    keys: DataFrame,
    key: str = "member_key",
    subscriber: str = "subscriber_id",
    suffix: str = "mbr_sfx",
) -> DataFrame:
    """Member rows whose 9-character subscriber prefix or 11-character id prefix is among the keys.

    An OR across a join would compare every pair, so each prefix gets its own equi join to the distinct keys;
    both only set a flag, and repeated member rows stay.
    """
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct()
    flagged = members.withColumns(
        {
            "_p9": F.left(subscriber, F.lit(9)),
            "_p11": F.left(F.concat(subscriber, suffix), F.lit(11)),
        }
    )
    for prefix in ("_p9", "_p11"):
        hits = wanted.select(F.col(key).alias(prefix), F.lit(True).alias(f"{prefix}_hit"))
        flagged = keyed_join(flagged, hits, prefix)
    return flagged.where("_p9_hit or _p11_hit").select(*members.columns)


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``.

    Spark prunes each map partition to one row per key before the shuffle, so a hot key stays small.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return (
        df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        .where("_rn = 1")
        .drop("_rn")
    )


def latest_lob(
    members: DataFrame,
    keys: DataFrame | None = None,
    subscriber: str = "subscriber_id",
    suffix: str = "mbr_sfx",
    lob: str = "finance_lob",
    period: str = "study_period",
    ties: Sequence[str] = ("mbr_sfx", "finance_lob"),
) -> DataFrame:
    """Each subscriber's line of business in the latest period: rows (member_id, finance_lob).

    With ``keys`` only members asked for are ranked.  Ties go to the smaller suffix, then the smaller LOB.
    """
    rows = members if keys is None else prefix_semi_join(members, keys, subscriber=subscriber, suffix=suffix)
    latest = latest_per_key(rows, subscriber, [F.desc(period), *[F.asc(t) for t in ties]])
    return latest.select(F.concat(subscriber, suffix).alias("member_id"), F.col(lob).alias("finance_lob"))


def with_finance_lob(
    calls: DataFrame, lobs: DataFrame, key: str = "member_key", match: str = "exact"
) -> DataFrame:
    """Add ``finance_lob`` (NULL when unknown) and ``finance_known`` by member key.

    ``match='prefix'`` also finds a member by the 9-character subscriber prefix when the full id is not there.
    """
    if match not in ("exact", "prefix"):
        raise ValueError("match is exact or prefix")
    # one row per key, so that calls never fan out
    by_id = lobs.groupBy(F.col("member_id").alias(key)).agg(F.min("finance_lob").alias("finance_lob"))
    out = keyed_join(calls, by_id, key)
    if match == "prefix":
        by_prefix = lobs.groupBy(F.left("member_id", F.lit(9)).alias(key)).agg(
            F.min("finance_lob").alias("_prefix_lob")
        )
        out = keyed_join(out, by_prefix, key)
        out = out.withColumn("finance_lob", F.coalesce("finance_lob", "_prefix_lob")).drop("_prefix_lob")
    return out.select(
        *calls.columns, "finance_lob", F.col("finance_lob").isNotNull().alias("finance_known")
    )


def join_dim(
    df: DataFrame,
    dim: DataFrame,
    left_key: str,
    right_key: str | None = None,
    unique: bool = False,
    matched: str | None = None,
    max_rows: int = 100_000,
) -> DataFrame:
    """Left join a dimension on a shared or a differently named key.

    Repeated dimension keys fan rows out, over all tasks, unless ``unique`` keeps one row per key.  The dimension is
    broadcast only after its rows were counted, up to ``max_rows``.  ``matched`` names an optional hit flag.
    """
    right_key = right_key or left_key
    side = dim.where(F.col(right_key).isNotNull())
    if unique:
        side = side.dropDuplicates([right_key])
    if right_key != left_key:
        side = side.withColumn(left_key, F.col(right_key))
    if matched:
        side = side.withColumn(matched, F.lit(1))
    joined = join_lookup if unique else join_repeated
    out = joined(df, side, left_key, "left", max_rows)
    return out.withColumn(matched, F.coalesce(matched, F.lit(0))) if matched else out


def union_tables(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack tables by column name, repeats kept."""
    out = first
    for other in others:
        out = out.unionByName(other)
    return out


def optional(
    df: DataFrame,
    source: DataFrame | None,
    on: str,
    defaults: Mapping[str, object],
) -> DataFrame:
    """Add the columns of ``defaults`` from ``source``; where a row finds none, or the source is off, the default.

    A default given as a list is picked by the key's hash, so a rerun gives the same filler.
    """

    def default(value: object) -> Column:
        if isinstance(value, (list, tuple)):
            choices = F.array(*[F.lit(v) for v in value])
            return F.element_at(choices, (F.pmod(F.xxhash64(on), F.lit(len(value))) + 1).cast("int"))
        return F.lit(value)

    kept = [c for c in df.columns if c not in defaults]
    if source is None:
        return df.select(*kept, *[default(v).alias(c) for c, v in defaults.items()])
    side = source.select(on, *defaults)
    joined = join_lookup(df.select(*kept), side, on, "left")
    return joined.select(*kept, *[F.coalesce(F.col(c), default(v)).alias(c) for c, v in defaults.items()])


def flatten(df: DataFrame, sep: str = "_", explode: Sequence[str] | None = None) -> DataFrame:
    """Turn nested structs into columns and arrays into rows, level by level, until neither is left.

    An empty or missing array keeps its row with NULLs.  Arrays side by side multiply rows; ``explode`` names the ones
    to turn into rows (by their flattened names), and the others stay arrays.
    """
    while True:
        nested = {f.name: f.dataType for f in df.schema.fields}
        structs = [n for n, t in nested.items() if isinstance(t, T.StructType)]
        arrays = [n for n, t in nested.items() if isinstance(t, T.ArrayType) and (explode is None or n in explode)]
        if structs:
            columns = []
            for name, kind in nested.items():
                if isinstance(kind, T.StructType):
                    columns += [
                        F.col(f"`{name}`.`{inner}`").alias(f"{name}{sep}{inner}") for inner in kind.fieldNames()
                    ]
                else:
                    columns.append(F.col(f"`{name}`"))
            df = df.select(*columns)
        elif arrays:
            df = df.withColumn(arrays[0], F.explode_outer(F.col(f"`{arrays[0]}`")))
        else:
            return df


def flatten_json(df: DataFrame, column: str, schema: T.StructType | str, prefix: bool = True) -> DataFrame:
    """Parse a JSON text column and flatten what it holds next to the other columns."""
    parsed = df.withColumn(column, F.from_json(column, schema))
    flat = flatten(parsed)
    if prefix:
        return flat
    return flat.toDF(*[c.removeprefix(f"{column}_") for c in flat.columns])
