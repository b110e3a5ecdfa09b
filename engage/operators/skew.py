"""Joins that hold when one key carries a large share of the rows."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Detection settings: a sketch keeps a fixed number of counters, and sketches are merged as a tree of FAN_IN groups,
# so no task's state or input grows with the number of scan tasks alone.
HOT_SHARE = 0.002
HOT_TRACKED = 8192
HOT_KEYS = 512
FAN_IN = 64

# Lookup rows of one key from which a join fans out: its tasks are then dealt by rows, not by the bytes they read, and
# a key's rows travel in runs of about RUN.
FAN_OUT = 100
RUN = 1024


def common_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with their keys in one type, so that equal values hash alike; text and other types have none."""
    casts = {}
    for key in keys:
        kinds = [side.schema[key].dataType for side in (left, right)]
        if kinds[0] == kinds[1]:
            continue
        if any(isinstance(k, T.StringType) for k in kinds):
            raise TypeError(f"join key {key} is {kinds[0].simpleString()} on one side and {kinds[1].simpleString()} on the other")
        wide = left.select(key).union(right.select(key)).schema[0].dataType
        casts[key] = F.col(key).cast(wide)
    return (left.withColumns(casts), right.withColumns(casts)) if casts else (left, right)


def hot_key_salts(df: DataFrame, keys: Sequence[str], tasks: int, share: float = HOT_SHARE) -> Column:
    """Scalar subquery: hash -> salts of the keys that hold more than ``share`` of the rows.

    One pass over the key columns into bounded frequent-items sketches.  A key gets so many salts that one of them
    holds about half of what an even task does.  A key missed or added here changes only how rows are spread.
    """
    sketches = (
        df.select(F.xxhash64(*keys).alias("_h"), F.pmod(F.spark_partition_id(), F.lit(FAN_IN)).alias("_g"))
        .groupBy("_g")
        .agg(F.expr(f"approx_top_k_accumulate(_h, {HOT_TRACKED})").alias("s"), F.count(F.lit(1)).alias("n"))
    )
    found = (
        # grouped by a constant: an empty partition has no state to combine
        sketches.groupBy(F.lit(0).alias("_all"))
        .agg(F.expr(f"approx_top_k_estimate(approx_top_k_combine(s, {HOT_TRACKED}), {HOT_KEYS})").alias("top"), F.sum("n").alias("n"))
        .select(
            F.map_from_entries(
                F.transform(
                    F.filter("top", lambda t: t["count"] > F.col("n") * share),
                    lambda t: F.struct(t["item"], F.ceil(t["count"] / F.col("n") * (2 * tasks) + 1).cast("int")),
                )
            ).alias("hot")
        )
    )
    return F.coalesce(found.scalar(), F.create_map().cast("map<bigint,int>"))


def _spread(df: DataFrame) -> Column:
    """A row hash over every hashable column, so that retried tasks place rows alike."""
    plain = [f.name for f in df.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain])


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    tasks: int | None = None,
    share: float = HOT_SHARE,
    dealt: int | None = None,
) -> DataFrame:
    """Equi join whose hot left keys are spread over salts in proportion to their share of the rows.

    Only the right rows of hot keys are repeated, for at most 1/share keys and ``2 * tasks`` salts in all.  ``tasks``
    defaults to the shuffle partitions.  NULL keys count as a key like any other; key types are made equal first.
    It reads the left keys once more; where the run time can split skewed partitions itself, ``keyed_join`` does not.
    ``dealt`` fixes the number of partitions, which else the run time may merge by their bytes.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    keys = [on] if isinstance(on, str) else list(on)
    left, right = common_keys(left, right, keys)
    tasks = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = F.coalesce(F.try_element_at(hot_key_salts(left, keys, tasks, share), F.xxhash64(*keys)), F.lit(1))
    spread_left = left.withColumn("_salt", F.pmod(_spread(left), salts).cast("int"))
    if dealt:
        spread_left = spread_left.repartition(dealt, *keys, "_salt")
    spread_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return spread_left.join(spread_right, [*keys, "_salt"], how).drop("_salt")


def keyed_join(left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Equi join to one row per key in one pass; adaptive execution splits the left side's large partitions."""
    keys = [on] if isinstance(on, str) else list(on)
    left, right = common_keys(left, right, keys)
    return left.join(right, keys, how)


def fits(df: DataFrame, max_rows: int = 100_000) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows.  A table is read no further than that; a grouped or joined
    frame is computed for it, so only tables should be asked."""
    return df.limit(max_rows + 1).count() <= max_rows


def join_lookup(
    left: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    max_rows: int = 100_000,
    small: bool | None = None,
) -> DataFrame:
    """Join to a reference table: broadcast when its counted size allows, else as the planner and run time choose.

    ``small`` passes on a count already made of a frame with at least as many rows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    left, lookup = common_keys(left, lookup, keys)
    if fits(lookup, max_rows) if small is None else small:
        return left.join(F.broadcast(lookup), keys, how)
    return keyed_join(left, lookup, keys, how)


def planned_broadcast(df: DataFrame) -> bool:
    """Whether the planner would broadcast ``df`` unasked, by the bytes it expects."""
    most = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= most


def in_runs(lookup: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """Rows (keys, _run): a key's rows in arrays of about ``RUN``, told apart by a hash, of which rows alike share one.

    ``most`` is the number of rows of the most frequent key.
    """
    places = [f"_{i}" for i in range(len(lookup.columns))]  # names may repeat
    rest = [(p, c) for p, c in zip(places, lookup.columns) if c not in keys]
    row = F.struct(*[F.col(p).alias(c) for p, c in rest] or [F.lit(0).alias("_none")])
    rows = lookup.toDF(*places)
    part = F.pmod(_spread(rows), F.lit(-(-most // RUN)))
    of = [F.col(places[lookup.columns.index(k)]).alias(k) for k in keys]
    return rows.groupBy(*of, part.alias("_part")).agg(F.collect_list(row).alias("_run")).drop("_part")


def join_repeated(
    left: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left", max_rows: int = 100_000
) -> DataFrame:
    """Join to a table that may repeat its keys: like ``join_lookup`` while no key has ``FAN_OUT`` rows.

    Beyond, in a left or inner join, few bytes of the left side become many rows.  These rows are dealt over all tasks
    before they meet a broadcast lookup, and with a larger one over the salts of their key.  The lookup's keys are counted
    to choose; one that the planner would broadcast is so too, else its rows would meet it in the few tasks that read them.
    A row meets whole runs of its key's rows and is multiplied after that, which is cheaper than to look up each of them.
    """
    keys = [on] if isinstance(on, str) else list(on)
    left, lookup = common_keys(left, lookup, keys)
    per_key = lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows, most = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if most < FAN_OUT or how not in ("left", "inner"):
        return join_lookup(left, lookup, keys, how, max_rows, small=rows <= max_rows)
    session = left.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), 4 * session.sparkContext.defaultParallelism)
    runs = in_runs(lookup, keys, most)
    if rows <= max_rows or planned_broadcast(runs):
        met = left.repartition(tasks).join(F.broadcast(runs), keys, how)
    else:
        met = salted_join(left, runs, keys, how, 4 * tasks, dealt=tasks)
    each = F.inline_outer("_run") if how == "left" else F.inline("_run")
    return met.select("*", each).drop("_run", "_none")
