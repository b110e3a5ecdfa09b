"""Global order statistics without a single-task sort.

The order is cut into buckets or narrowed to brackets, these are counted (a small table), and sorting happens
only inside one, so no task sees more than its share.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from engage.session import materialise

# Rows one task may sort; beyond, the order is cut into buckets of about this size, at most 2**MAX_BITS.
ROWS_PER_BUCKET = 1_000_000
MAX_BITS = 14
ACCURACY = 10_000
# Size and fan-in of the quantile sketches: a rank error of about 2 in 10,000, with under 1 MB each.
SKETCH_SIZE = 32_768
SKETCH_GROUPS = 64


def _split_points(value: str, bits: int) -> Column:
    cuts = [i / 2**bits for i in range(1, 2**bits)]
    return F.percentile_approx(value, cuts, 8 * 2**bits)


def _bucket(splits: Column, value: Column, bits: int) -> Column:
    """How many split points lie below ``value`` (binary search over a sorted array)."""
    steps = F.array(*[F.lit(2**i) for i in reversed(range(bits))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.element_at(splits, at + step) < value, at + step).otherwise(at),
    )


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], broadcast: bool = False) -> DataFrame:
    """Inner join on ``keys`` in which NULL equals NULL; the left side's key columns stay."""
    names = {k: f"_r_{k}" for k in keys}
    side = right.withColumnsRenamed(names)
    match = [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()]
    return left.join(F.broadcast(side) if broadcast else side, match).drop(*names.values())


def running_totals(
    df: DataFrame,
    order: str,
    totals: Mapping[str, str],
    by: Sequence[str] = (),
    descending: bool = False,
    bits: int | None = None,
) -> DataFrame:
    """Add inclusive running totals of ``totals`` (source column -> new column) along ``order``.

    ``df`` holds one row per (by, order) value, that is, ties are already aggregated.  ``order`` is numeric.
    The rows are counted to choose 2**bits buckets, so ``df`` should be a table; few rows need no buckets.
    """
    by = list(by)
    sense = F.desc if descending else F.asc
    if bits is None:
        bits = min(MAX_BITS, math.ceil(math.log2(max(df.count() / ROWS_PER_BUCKET, 1))))
    if bits == 0:
        upto = (
            Window.partitionBy(*(by or [F.lit(0)]))
            .orderBy(sense(order))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return df.select("*", *[F.sum(c).over(upto).alias(name) for c, name in totals.items()])
    splits = df.agg(_split_points(order, bits).alias("s")).scalar()
    bucketed = (
        df.withColumn("_splits", splits)
        .withColumn("_bucket", _bucket(F.col("_splits"), F.col(order), bits))
        .drop("_splits")
    )
    keys = [*by, "_bucket"]
    sums = bucketed.groupBy(*keys).agg(*[F.sum(c).alias(f"_t_{c}") for c in totals])
    # at most 2**bits rows per group reach this window
    before = (
        Window.partitionBy(*(by or [F.lit(0)]))
        .orderBy(sense("_bucket"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sums.select(
        *keys, *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in totals]
    )
    inside = (
        Window.partitionBy(*keys)
        .orderBy(sense(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = null_safe(bucketed, offsets, keys)
    return joined.select(
        *df.columns,
        *[(F.col(f"_o_{c}") + F.sum(c).over(inside)).alias(name) for c, name in totals.items()],
    )


def quantile_values(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    kind: str = "disc",
    accuracy: int = ACCURACY,
    slack: float | None = None,
) -> dict[str, dict[float, float | None]]:
    """Exact quantiles of numeric columns as numbers: column -> probability -> value, None for an empty column.

    ``disc`` returns an element, ``linear`` interpolates.  NULL and NaN are ignored.  Three passes over ``df``,
    which should therefore be a table rather than a long query, each ending in a fixed number of values:
    a sketch brackets each quantile with values of slightly lower and higher rank (``slack``, 4 / accuracy at first);
    the rows below a bracket are counted; only those inside are sorted.  Should a bracket miss its rank, all is
    done once more with wider ones, in the end with all rows.
    """
    if kind not in ("disc", "linear"):
        raise ValueError("kind is disc or linear")
    values = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in cols}
    numbers = df.select(*[v.alias(f"_v{i}") for i, v in enumerate(values.values())])
    slack = slack or 4 / accuracy
    ends = [end for p in probs for end in (max(0.0, p - slack), min(1.0, p + slack))]
    at = ", ".join(f"double('{end!r}')" for end in ends)
    sketches = (
        numbers.withColumn("_g", F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)))
        .groupBy("_g")
        .agg(
            *[F.count(v).alias(f"n{i}") for i, v in enumerate(numbers.columns)],
            *[F.expr(f"kll_sketch_agg_double({v}, {SKETCH_SIZE})").alias(f"s{i}") for i, v in enumerate(numbers.columns)],
        )
    )
    # merged in two levels, so that no task takes in every scan task's sketch
    whole = sketches.groupBy(F.lit(0).alias("_all")).agg(
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(cols))],
        *[F.expr(f"kll_merge_agg_double(if(n{i} > 0, s{i}, null))").alias(f"s{i}") for i in range(len(cols))],
    )
    sketch = whole.select(
        *[f"n{i}" for i in range(len(cols))],
        *[F.expr(f"if(n{i} > 0, kll_sketch_get_quantile_double(s{i}, array({at})), null) as e{i}") for i in range(len(cols))],
    ).first() or {f"n{i}": 0 for i in range(len(cols))}

    out: dict[str, dict[float, float | None]] = {c: dict.fromkeys(probs) for c in cols}
    brackets: list[tuple[int, float, float, float]] = []  # column number, prob, low, high
    for i in range(len(cols)):
        for j, prob in enumerate(probs):
            if (sketch[f"n{i}"] or 0) > accuracy and slack < 1:
                brackets.append((i, prob, sketch[f"e{i}"][2 * j], sketch[f"e{i}"][2 * j + 1]))
            elif (sketch[f"n{i}"] or 0) > 0:  # few rows need no bracket
                brackets.append((i, prob, float("-inf"), float("inf")))
    if not brackets:
        return out
    below = numbers.agg(
        *[F.expr(f"count_if(_v{i} < double('{low!r}'))").alias(f"b{k}") for k, (i, _, low, _) in enumerate(brackets)]
    ).first()

    wanted = []  # bracket number, rank inside the bracket
    positions = []
    for k, (i, prob, _, _) in enumerate(brackets):
        total, exact = sketch[f"n{i}"], Decimal(str(prob))
        position = exact * total if kind == "disc" else exact * (total - 1) + 1
        first = max(math.ceil(position) if kind == "disc" else math.floor(position), 1)
        last = first if kind == "disc" else math.ceil(position)
        positions.append((first, last, float(position - first)))
        wanted += [(k, rank - below[f"b{k}"]) for rank in {first, last}]
    spans = [f"i = '{i}' and value between double('{low!r}') and double('{high!r}')" for i, _, low, high in brackets]
    within = ", ".join(f"if({span}, {k}, null)" for k, span in enumerate(spans))
    counted = (
        numbers.toDF(*[str(i) for i in range(len(cols))])
        .unpivot([], [str(i) for i in range(len(cols))], "i", "value")
        .where(" or ".join(f"({span})" for span in spans))
        .groupBy("i", "value")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("k", F.expr(f"explode(array_compact(array({within})))"))
        .select("k", "value", "copies")
    )
    if max(sketch[f"n{i}"] or 0 for i in range(len(cols))) * 2 * slack > ROWS_PER_BUCKET:
        ranked = running_totals(materialise(counted, "brackets"), "value", {"copies": "upto"}, ["k"])
    else:
        ranked = running_totals(counted, "value", {"copies": "upto"}, ["k"], bits=0)
    here = " or ".join(f"(k = {k} and upto >= {rank} and upto - copies < {rank})" for k, rank in wanted)
    rows = ranked.where(here).select("k", "value", "copies", "upto").collect()  # at most two per bracket
    for k, (i, prob, _, _) in enumerate(brackets):
        first, last, fraction = positions[k]
        at = {
            rank: r["value"]
            for rank in (first, last)
            for r in rows
            if r["k"] == k and r["upto"] - r["copies"] < rank - below[f"b{k}"] <= r["upto"]
        }
        if len(at) < len({first, last}):
            return quantile_values(df, cols, probs, kind, accuracy, slack * 16)
        out[cols[i]][prob] = at[first] + (at[last] - at[first]) * fraction if last > first else at[first]
    return out


def one_row(df: DataFrame) -> Column:
    """A one-row frame as a struct-valued scalar subquery, computed once however many fields are used."""
    return df.select(F.struct(*df.columns)).scalar()


def hashed_key(key: str) -> Column:
    """The order of rows; a NULL key has a place too."""
    return F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))


def _hash_counts(df: DataFrame, by: Sequence[str], key: str, digits: int) -> DataFrame:
    """Rows per hash prefix with the number before it and the group's size; 16**digits rows per group."""
    group = Window.partitionBy(*(by or [F.lit(0)]))
    return (
        df.groupBy(*by, F.substring(hashed_key(key), 1, digits).alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_k"))
        .select(
            *by,
            "_bucket",
            "_k",
            (F.sum("_k").over(group.orderBy("_bucket")) - F.col("_k")).alias("_before"),
            F.sum("_k").over(group).alias("_total"),
        )
    )


def hash_rank(
    df: DataFrame, key: str, by: Sequence[str] = (), rank: str = "rank", total: str = "total", digits: int = 4
) -> DataFrame:
    """Rank rows from 1 by md5 of a unique ``key`` inside each ``by`` group, and add the group's size.

    Hash prefixes cut a group evenly, so even a group with most of the rows is ranked by 16**digits tasks.
    """
    by = list(by)
    keys = [*by, "_bucket"]
    counts = _hash_counts(df, by, key, digits)
    inside = Window.partitionBy(*keys).orderBy(hashed_key(key))
    return (
        null_safe(df.withColumn("_bucket", F.substring(hashed_key(key), 1, digits)), counts, keys)
        .select(
            *df.columns,
            (F.col("_before") + F.row_number().over(inside)).alias(rank),
            F.col("_total").alias(total),
        )
    )


def hash_cut(df: DataFrame, key: str, share: float, by: Sequence[str], digits: int = 4) -> DataFrame:
    """Per ``by`` group the largest md5 among the first ``ceil(share * n)`` rows: rows (by, cut).

    Counts hash prefixes, then sorts only the distinct hashes of the one prefix per group in which the cut falls.
    Copies of a key share a hash, so they stay on one side of the cut and cost one row.
    """
    by = list(by)
    target = F.ceil(F.lit(Decimal(str(share))).cast("decimal(12,10)") * F.col("_total"))
    # one row per group; groups are the classes of a label
    edge = (
        _hash_counts(df, by, key, digits)
        .withColumn("_target", target)
        .where("_target > _before and _target <= _before + _k")
        .select(*by, "_bucket", (F.col("_target") - F.col("_before")).alias("_nth"))
    )
    keys = [*by, "_bucket"]
    inside = Window.partitionBy(*keys).orderBy("_h")
    return (
        null_safe(
            df.select(*by, hashed_key(key).alias("_h")).withColumn("_bucket", F.substring("_h", 1, digits)),
            edge,
            keys,
            broadcast=True,
        )
        .groupBy(*keys, "_h", "_nth")
        .agg(F.count(F.lit(1)).alias("_copies"))
        .withColumn("_upto", F.sum("_copies").over(inside))
        .where("_upto >= _nth and _upto - _copies < _nth")
        .select(*by, F.col("_h").alias("cut"))
    )
