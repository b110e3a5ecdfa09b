"""Reference sheets, exported as csv."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Prefixes put before sheet ids, and the organisations that count as Medicare.
SKILL_PREFIX = "106"
ORG_PREFIX = "80500"
MEDICARE_ORGS = ("Member Medicare", "Member Medicare Care Navigation", "Member Medicare Rx Tech")


def clean_key(column: str) -> Column:
    """Sheet ids as text: trimmed, without the ``.0`` a numeric sheet column leaves."""
    return F.regexp_replace(F.trim(F.col(column).cast("string")), r"\.0$", "")


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A csv sheet with a header, every column as text."""
    return spark.read.option("header", True).csv(path)


def skill_lookup(sheets: Mapping[str, DataFrame], column: str = "Skill", prefix: str = SKILL_PREFIX) -> DataFrame:
    """Skill sheets per line of business, in order: rows (ord, lob, kind, key)."""
    out = None
    for position, (lob, sheet) in enumerate(sheets.items(), 1):
        rows = sheet.where(F.col(column).isNotNull()).select(
            F.lit(position).alias("ord"),
            F.lit(lob).alias("lob"),
            F.lit("skill").alias("kind"),
            F.concat(F.lit(prefix), clean_key(column)).alias("key"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def queue_lookup(
    sheet: DataFrame, ord: int | DataFrame, lob: str = "MediCal", column: str = "Queue_Name"
) -> DataFrame:
    """Queue names of one line of business: rows (ord, lob, kind, key).

    ``ord`` is its place among the lines of business, or the skill lookup that gives it, so that a call found by both its skill and
    its queue is one row.
    """
    place = F.lit(ord) if isinstance(ord, int) else ord.where(F.col("lob") == lob).agg(F.min("ord")).scalar()
    return sheet.where(F.col(column).isNotNull()).select(
        place.alias("ord"), F.lit(lob).alias("lob"), F.lit("queue").alias("kind"), clean_key(column).alias("key")
    )


def org_ids(sheet: DataFrame, names: Sequence[str] = MEDICARE_ORGS, prefix: str = ORG_PREFIX) -> DataFrame:
    """Prefixed ids of the named organisations."""
    return sheet.where(F.col("NAME").isin(list(names))).select(F.concat(F.lit(prefix), clean_key("ID")).alias("org_id"))


def hunt_group_lookup(sheets: Mapping[str, DataFrame], column: str = "HuntGroup") -> DataFrame:
    """Hunt-group sheets per line of business: rows (lob, key)."""
    out = None
    for lob, sheet in sheets.items():
        rows = sheet.where(F.col(column).isNotNull()).select(F.lit(lob).alias("lob"), clean_key(column).alias("key"))
        out = rows if out is None else out.unionByName(rows)
    return out


def skill_text_lookup(sheet: DataFrame, skill: str = "Skill_ID", text: str = "LOB") -> DataFrame:
    """Skill to line-of-business text in sheet order: rows (ord, skill_id, lob_text).

    A sheet is one small csv file, read as one partition, so its rows number themselves in file order.
    """
    return sheet.select(
        F.monotonically_increasing_id().alias("ord"), clean_key(skill).alias("skill_id"), F.col(text).alias("lob_text")
    )
