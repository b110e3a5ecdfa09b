"""Counts that describe a run: daily log, routed counts, partition and shape reports, stage log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from engage.functions import is_blank, to_int

COUNT_COLUMNS = (
    "total_transcript_count",
    "outbound_calls_count",
    "inbound_calls_count",
    "skill_id_present",
    "queue_name_present",
    "member_id_present",
    "length_more_than_60seconds",
)


def daily_log(
    audit: DataFrame,
    source_like: str | None = None,
    run_date: dt.date | str | None = None,
    by: Sequence[str] = ("selected_lob", "run_date"),
    started: str | None = None,
    ended: str | None = None,
) -> DataFrame:
    """Counts per line of business and run date; a count whose column is absent is 0."""
    rows = audit
    if source_like is not None:
        rows = rows.where(F.col("source").like(source_like))
    if run_date is not None:
        rows = rows.where(F.to_date("run_date") == F.to_date(F.lit(run_date)))
    have = set(rows.columns)

    def count_if(condition: Column, *needs: str) -> Column:
        if not have.intersection(needs):
            return F.lit(0).cast("long")
        return F.sum(F.when(condition, 1).otherwise(0)).cast("long")

    members = [c for c in ("cd48_member_id", "cd93_subscriber_id", "cd6_subscriber_id") if c in have]
    member = F.lit(False)
    for name in members:
        member = member | ~is_blank(name)
    counts = [
        F.count(F.lit(1)),
        count_if(to_int("direction") == 2, "direction"),
        count_if(to_int("direction") == 1, "direction"),
        count_if(~is_blank("cd10_skill_id"), "cd10_skill_id"),
        count_if(~is_blank("cd69_queue_name"), "cd69_queue_name"),
        count_if(member, *members) if members else F.lit(0).cast("long"),
        count_if(to_int("duration_seconds") > 60, "duration_seconds"),
    ]
    out = rows.groupBy(*by).agg(*[c.alias(n) for c, n in zip(counts, COUNT_COLUMNS)])
    if started is not None:
        out = out.withColumn("global_filter_start", F.to_timestamp(F.lit(started)))
    if ended is not None:
        out = out.withColumn("global_filter_end", F.to_timestamp(F.lit(ended)))
    return out


def as_text_counts(log: DataFrame) -> DataFrame:
    """The log with its counts as text and an empty processed count, as the log table keeps them."""
    return log.withColumns({c: F.col(c).cast("string") for c in COUNT_COLUMNS}).withColumn(
        "llm_processed_transcript_count", F.lit(None).cast("string")
    )


def processed_counts(
    scored: DataFrame, special: str, org: str = "org_id", key: str = "id", day: str = "processed_date"
) -> DataFrame:
    """Distinct ids per day for the special org and for the others; rows with no org are in neither.

    Ids are made distinct in a partially aggregated shuffle of their own, so a repeated id costs one row.
    """
    distinct = (
        scored.where(F.col(org).isNotNull())
        .select(F.to_date(day).alias(day), (F.col(org) == special).alias("special"), key)
        .distinct()
    )
    return distinct.groupBy(day).agg(
        F.count(F.when(F.col("special"), F.col(key))).alias("special_count"),
        F.count(F.when(~F.col("special"), F.col(key))).alias("other_count"),
    )


# Buckets of a distinct-count sketch, as a power of two: a relative error of about 1.04 / 2^(bits / 2), 1.6 % here, in about 4 KB.
SKETCH_BITS = 12


def count_sketches(scored: DataFrame, by: Sequence[str], key: str = "id", bits: int = SKETCH_BITS) -> DataFrame:
    """A mergeable sketch of the distinct ids per group, such as (org, day): rows (by..., sketch) to keep in the log.

    A task's sketch of a group is of fixed size whatever the ids, so that only sketches are shuffled; repeated runs over
    the same ids give the same counts.  NULL ids are not counted.
    """
    text = F.col(key).cast("string")
    return scored.where(text.isNotNull()).groupBy(*by).agg(F.hll_sketch_agg(text, F.lit(bits)).alias("sketch"))


def united_counts(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct ids over any rows of ``count_sketches``, such as all days of a range: rows (by..., n).

    An id of several days counts once, which sums of daily counts cannot give.  Groups of no row have no result; without
    ``by`` the count of nothing is 0.
    """
    united = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return sketches.groupBy(*by).agg(F.coalesce(united, F.lit(0).cast("long")).alias("n"))


def processed_log(
    counts: DataFrame, lob: str, special_feed: str, other_feed: str, day: str = "processed_date"
) -> DataFrame:
    """The two counts of ``processed_counts`` as log rows (lob, run_date, feed, count as text), for ``merge.upsert``."""
    rows = F.array(
        F.struct(F.lit(special_feed).alias("feed"), F.col("special_count").alias("n")),
        F.struct(F.lit(other_feed).alias("feed"), F.col("other_count").alias("n")),
    )
    return counts.select(F.col(day).alias("run_date"), F.inline(rows)).select(
        F.lit(lob).alias("lob"), "run_date", "feed", F.col("n").cast("string").alias("llm_processed_transcript_count")
    )


def routed_counts(routed: DataFrame, lobs: Sequence[str]) -> DataFrame:
    """Selected calls per line of business, zeros included."""
    found = routed.where("selected").groupBy("lob").agg(F.count(F.lit(1)).alias("n"))
    wanted = routed.sparkSession.createDataFrame([(lob,) for lob in lobs], "lob string")
    # both sides have one row per line of business
    return wanted.join(found, "lob", "left").select("lob", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition, empty partitions included; only the counts move."""
    sizes = df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    partitions = spark.range(df.rdd.getNumPartitions()).select(F.col("id").cast("int").alias("partition"))
    return partitions.join(sizes, "partition", "left").select(
        "partition", F.coalesce("n", F.lit(0).cast("long")).alias("n")
    )


def shape(df: DataFrame) -> DataFrame:
    """One row: rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


STAGE_SCHEMA = "stage string, start_time timestamp, end_time timestamp, status string, message string"


class StageLog:
    """Times stages of a job; a stage must run its action inside ``run`` so that the time is real."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.entries: list[tuple] = []

    def run(self, stage: str, action: Callable[[], object], message: str = "") -> object:
        start = dt.datetime.now()
        try:
            result = action()
        except Exception as error:
            self.entries.append((stage, start, dt.datetime.now(), "Failed", str(error)))
            raise
        self.entries.append((stage, start, dt.datetime.now(), "Success", message))
        return result

    def frame(self) -> DataFrame:
        return self.spark.createDataFrame(self.entries, STAGE_SCHEMA)

    def write(self, path: str) -> None:
        """A stage log has a handful of rows, so one file."""
        self.frame().coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_stage_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema(STAGE_SCHEMA).csv(path)


def stage_times(log: DataFrame, stages: dict[str, str]) -> DataFrame:
    """One row with ``<prefix>_start_time`` and ``<prefix>_end_time`` text per stage (stage -> prefix)."""
    columns = []
    for stage, prefix in stages.items():
        for side in ("start_time", "end_time"):
            first = F.min(F.when(F.col("stage") == stage, F.col(side)))
            columns.append(F.date_format(first, "yyyy-MM-dd HH:mm:ss").alias(f"{prefix}_{side}"))
    return log.agg(*columns)
