"""Mixing sources to target weights along a time-varying curriculum.

A source's share of the mix follows from its weight, but no source gives more than ``MAX_PASSES`` times its own
words; what a stopped source leaves is shared again by weight.  Every source has a weight schedule over training time
t in [0, 1]; its integral is the cumulative token demand, and inverting it gives the time at which the source's c-th
word is needed.  A source's documents stand in the order of a hash of id and text, repeated in passes; a running sum of
their sizes is c.  It is cut by prefixes of the hash: over coarse buckets of a source, fine buckets of a coarse one, and
the rows of a fine one, so that no sort grows with the source (16.8 million fine buckets each).  Documents are
range-sorted by that time.

Defined results: null text has size 0 and is never taken; null sources are one source, last in order; rows that share
an id, or have none, stand by their texts; rows equal in both take neighbouring places in one bucket; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

# Fixed values of the contract: weights by rank of the source, repeating, and the largest multiple of a source's size.
WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
# Weight schedule of each class: w(t) = 1 + slope * (2t - 1), integral 1.  Heavy sources fade, light ones grow.
SLOPES = (-0.5, 0.0, 0.5)
# Hex digits of the order hash that name a coarse and a fine bucket of the running sum.
COARSE = 3
FINE = 6
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights=WEIGHTS, slopes=SLOPES, max_passes: int = MAX_PASSES) -> DataFrame:
    """Per source (one row each in): its target words and schedule.

    Sources in ascending order of cap over weight are stopped while the level that the others would share exceeds
    their cap; the rest get level times weight.  This table has one row per source, so its windows are small.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    n = len(weights)
    ranked = sizes.withColumn("class", (F.row_number().over(order) - 1) % n)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("class") + 1)).withColumn(
        "slope", F.element_at(F.array(*map(F.lit, slopes)), F.col("class") + 1)
    )
    cap = F.col("source_size") * max_passes
    by_ratio = W.orderBy(cap.cast("double") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, W.unboundedFollowing)
    whole = W.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))).cast("double") / F.sum(
        "weight"
    ).over(onward)
    filled = ranked.withColumn("ratio", cap.cast("double") / F.col("weight")).withColumn("level", level)
    stopped = F.col("ratio") < F.col("level")
    rank = F.row_number().over(by_ratio)
    filled = filled.withColumn("stopped", stopped).withColumn("rank", rank)
    first = F.min(F.when(~F.col("stopped"), F.struct("rank", "level"))).over(whole)["level"]
    return filled.withColumn("shared", first).select(
        "key",
        "source",
        "source_size",
        "slope",
        F.when(F.col("stopped"), cap.cast("double")).otherwise(F.col("shared") * F.col("weight")).alias("target"),
    )


def when_needed(share: Column, slope: Column) -> Column:
    """Training time at which a share of a source's demand has been used: the inverse of t + slope (t^2 - t)."""
    linear = 1 - slope
    return 2 * share / (linear + F.sqrt(linear * linear + 4 * slope * share))


def placed(docs: DataFrame, carried: list[str], coarse: int = COARSE, fine: int = FINE, **settings) -> DataFrame:
    """Every row's ``carried`` columns as struct ``row`` with size, source_size, target, taken and its passes."""
    row = F.struct(*[F.col(f"`{c}`") for c in carried])
    base = docs.select(
        row.alias("row"),
        F.col("source").cast("string").alias("source"),
        # null is a source of its own; a key without nulls lets the join use the window's partitioning
        F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source").cast("string"))).alias("key"),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.md5(
            F.concat(
                F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                F.lit(":"),
                F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")),
            ).cast("binary")
        ).alias("place"),
    ).withColumn("bucket", F.substring("place", 1, fine))
    summed = lambda *keys: W.partitionBy(*keys).rowsBetween(W.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    part = F.substring("bucket", 1, coarse).alias("part")
    by_bucket = base.groupBy("key", "source", part, "bucket").agg(F.sum("size").alias("bucket_size"))
    by_part = by_bucket.groupBy("key", "source", "part").agg(F.sum("bucket_size").alias("part_size"))
    chosen = targets(by_part.groupBy("key", "source").agg(F.sum("part_size").alias("source_size")), **settings)
    parts = (
        by_part.select("key", "part", F.coalesce(F.sum("part_size").over(summed("key").orderBy("part")), none).alias("before"))
        .join(chosen.drop("source"), "key")
        .select("key", "part", "before", "source_size", "target", "slope")
    )
    inner = F.coalesce(F.sum("bucket_size").over(summed("key", "part").orderBy("bucket")), none)
    offsets = (
        by_bucket.select("key", "part", "bucket", inner.alias("inner"))
        .join(parts, ["key", "part"])
        .select("key", "bucket", (F.col("before") + F.col("inner")).alias("offset"), "source_size", "target", "slope")
    )
    within = W.partitionBy("key", "bucket").orderBy("place", "size").rowsBetween(W.unboundedPreceding, -1)
    at = base.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    start = F.col("offset") + F.col("inside")
    at = at.drop("source").join(offsets, ["key", "bucket"])
    passes = settings.get("max_passes", MAX_PASSES)
    wanted = F.round("target").cast("long")
    whole = F.array(*[F.lit(e) for e in range(passes)])
    at = at.withColumn("start", start).withColumn("wanted", wanted)
    at = at.withColumn(
        "passes",
        F.filter(
            F.transform(
                whole,
                lambda e: F.struct(
                    e.alias("pass"),
                    F.greatest(
                        F.lit(0),
                        F.least(F.col("size"), F.col("wanted") - F.col("start") - e * F.col("source_size")),
                    ).alias("words"),
                    when_needed(
                        F.when(
                            F.col("wanted") > 0, (F.col("start") + e * F.col("source_size")).cast("double") / F.col("wanted")
                        ).otherwise(0.0),
                        F.col("slope"),
                    ).alias("position"),
                ),
            ),
            lambda p: p["words"] > 0,
        ),
    )
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda total, p: total + p["words"])
    return at.select("row", "place", "size", "source_size", "target", taken.alias("taken"), "passes")


def mix(docs: DataFrame, **settings) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken and its first position, range-sorted by position."""
    return (
        placed(docs, ["doc_id"], **settings)
        .select(
            F.col("row.doc_id").alias("doc_id"),
            "size",
            "source_size",
            "target",
            "taken",
            F.get("passes", F.lit(0))["position"].alias("position"),
            "place",
        )
        .orderBy(F.col("position").asc_nulls_last(), "place")
        .drop("place")
    )


def curriculum(docs: DataFrame, **settings) -> DataFrame:
    """The mixed corpus itself: the input's columns, one row per pass over a document, in training order.

    A source's last pass may end inside a document; that row's text is cut after the words the mix takes.
    """
    rows = placed(docs, docs.columns, **settings).select("row", "place", "size", F.explode("passes").alias("p"))
    pieces = F.regexp_extract_all(F.col("row.text"), F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("p.words").cast("int")), "")
    text = F.when(F.col("p.words") < F.col("size"), cut).otherwise(F.col("row.text"))
    return rows.orderBy("p.position", "place", "p.pass").select(
        *[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, source, md5(concat(coalesce(CAST(doc_id AS VARCHAR), 'null'), ':', md5(coalesce(text, '')))) AS place FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
c AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS class FROM s),
w AS (SELECT *, CASE class WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, CAST(CASE class WHEN 0 THEN -0.5 WHEN 1 THEN 0 ELSE 0.5 END AS DOUBLE) AS slope FROM c),
r AS (SELECT *, CAST(source_size * 3 AS DOUBLE) / weight AS ratio FROM w),
l AS (SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
        / CAST(sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level,
        row_number() OVER (ORDER BY ratio, source NULLS LAST) AS rank FROM r),
m AS (SELECT min_by(level, rank) AS shared FROM l WHERE NOT ratio < level),
t AS (SELECT source, source_size, slope, CASE WHEN ratio < level THEN CAST(source_size * 3 AS DOUBLE) ELSE shared * weight END AS target FROM l, m),
p AS (SELECT d.*, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM d),
j AS (SELECT p.*, t.source_size, t.target, t.slope, CAST(round(t.target) AS BIGINT) AS wanted FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, greatest(0, least(size, wanted - start)) AS a, greatest(0, least(size, wanted - start - source_size)) AS b, greatest(0, least(size, wanted - start - 2 * source_size)) AS c,
        CASE WHEN wanted > 0 THEN CAST(start AS DOUBLE) / wanted ELSE 0 END AS share FROM j)
SELECT doc_id, size, source_size, target, CAST(a + b + c AS BIGINT) AS taken,
       CASE WHEN a > 0 THEN 2 * share / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * share)) END AS position FROM k
"""
