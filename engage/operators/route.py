"""Call routing: which line of business receives a call, and why.

The rules work on a frame with one row per call and these text columns: ``path, cd6, cd8, cd10, cd48, cd69,
cd93, org_id, direction, duration`` (see ``codes``), plus ``finance_lob`` and ``finance_known`` from
``enrich.with_finance_lob``.  Every rule is one ``when`` chain over small reference joins; no call runs Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from engage.functions import basename, first_nonblank, is_blank, nonblank, to_int
from engage.operators.enrich import NOT_AVAILABLE, latest_per_key
from engage.operators.skew import fits, join_lookup

# Metadata codes read by the rules, and the columns they become.
CODES = {
    "CD6": "cd6",
    "CD8": "cd8",
    "CD10": "cd10",
    "CD48": "cd48",
    "CD69": "cd69",
    "CD93": "cd93",
    "org_id": "org_id",
    "length": "length",
    "Direction": "direction",
    "Duration_seconds": "duration",
}

# Reasons written to the audit rows.
DIRECTION = "Not filtered due to direction condition"
DURATION = "Not filtered due to duration condition"
SKILL_MISS = "Not filtered due to skill id not matched"
ORG_MISS = "Not filtered due to org id not matched"
FINANCE_MISS = "Not filtered due to finance lob not matched"
SKILL_OR_ORG = "Filtered for skill id or org id"
SKILL_ORG_FINANCE = "Filtered for skill id, org id, and finance lob"
NOT_PROVIDER = "Not filtered due to not provider transcripts."
FILENAME = "Not filtered due to filename conditions"
LOB_CONDITIONS = "Not filtered due to LOB conditions"
SKILL = "Filtered for skill id"
SKILL_FINANCE = "Filtered for skill id and finance lob"

# Finance LOBs accepted besides blank ones, per gated line of business.
ALLOWED_FINANCE = {"MA": ("GMAPD", "Total MAPD"), "IFP": ("Individual (IFP)",)}

# Lines of business, in rule order.
MULTI_LOBS = ("MA", "IFP", "Broker", "Small Group", "MediCal", "Core Premier")
FIRST_MATCH_LOBS = ("IFP", "Provider", "Core Premier")
PREFIX_LOBS = ("Small Group", "IFP", "Broker")


def codes(documents: DataFrame, drop_empty: bool = False) -> DataFrame:
    """Pull the known metadata codes out of the map; the rest stays in ``other_metadata``, and ``has_metadata`` tells
    whether there was any.

    ``drop_empty`` leaves out documents without metadata, as the multi-route feed does.
    """
    rows = documents.withColumn(
        "has_metadata", F.size(F.coalesce("metadata", F.create_map().cast("map<string,string>"))) > 0
    )
    if drop_empty:
        rows = rows.where("has_metadata")
    rest = F.map_filter("metadata", lambda k, _: ~k.isin(list(CODES)))
    return rows.select(
        "*",
        *[F.col("metadata").getItem(code).alias(name) for code, name in CODES.items()],
        rest.alias("other_metadata"),
    ).drop("metadata")


def member_key() -> Column:
    """Member id, else either subscriber id: the first that is not empty."""
    return first_nonblank("cd48", "cd93", "cd6")


def gate(calls: DataFrame, direction: int = 1, min_seconds: int = 60) -> DataFrame:
    """Add ``member_key``, ``parse_ok`` and ``gate_reason`` (NULL = passes).

    Direction is tested before duration; a value that is missing or no number fails its test.
    """
    way, seconds = to_int("direction"), to_int("duration")
    reason = F.when(F.coalesce(way, F.lit(0)) != direction, DIRECTION).when(
        F.coalesce(seconds, F.lit(0)) <= min_seconds, DURATION
    )
    return calls.withColumns(
        {
            "member_key": member_key(),
            "parse_ok": way.isNotNull() & seconds.isNotNull(),
            "gate_reason": reason,
        }
    )


def _finish(df: DataFrame, columns: Sequence[str], selected: Column, reason: Column, lob: Column) -> DataFrame:
    passed = F.col("gate_reason").isNull()
    chosen = F.coalesce(selected, F.lit(False)) & passed
    return df.select(
        *columns,
        chosen.alias("selected"),
        F.coalesce(F.col("gate_reason"), reason).alias("reason"),
        F.when(chosen, lob).otherwise("").alias("lob"),
    )


def _lobs_by_key(lookup: DataFrame, key: str, name: str) -> DataFrame:
    """Per key the distinct (ord, lob) pairs; a key has at most as many as there are lines of business."""
    return (
        lookup.groupBy(key).agg(F.array_sort(F.collect_set(F.struct("ord", "lob"))).alias(name))
    )


def multi_route(calls: DataFrame, lookup: DataFrame, org_ids: DataFrame) -> DataFrame:
    """One row per matching line of business; calls stopped by the gate give one row, calls without a match none.

    ``lookup`` has (ord, lob, kind, key) with kind ``skill`` or ``queue``; ``org_ids`` has (org_id).
    """
    columns = calls.columns
    skills = _lobs_by_key(lookup.where("kind = 'skill'").withColumnRenamed("key", "cd10"), "cd10", "_skill")
    queues = _lobs_by_key(lookup.where("kind = 'queue'").withColumnRenamed("key", "cd69"), "cd69", "_queue")
    orgs = org_ids.select("org_id").distinct().withColumn("_org_ok", F.lit(True))
    small = fits(lookup)
    joined = join_lookup(calls, skills, "cd10", small=small)
    joined = join_lookup(join_lookup(joined, queues, "cd69", small=small), orgs, "org_id")

    none = F.array().cast("array<struct<ord:int,lob:string>>")

    def hits(name: str) -> Column:
        return F.coalesce(F.col(name).cast("array<struct<ord:int,lob:string>>"), none)

    # a blank code matches nothing, even should the lookup hold a blank key
    by_skill = F.when(F.col("cd10") != "", hits("_skill")).otherwise(none)
    by_queue = F.when(F.col("cd69") != "", hits("_queue")).otherwise(none)
    nowhere = F.array(F.struct(F.lit(0).alias("ord"), F.lit("").alias("lob")))
    targets = F.when(F.col("gate_reason").isNotNull(), nowhere).otherwise(F.array_union(by_skill, by_queue))
    rows = joined.withColumn("_target", F.explode(targets))

    target = F.col("_target.lob")
    gated = target.isin(list(ALLOWED_FINANCE)) & F.col("member_key").isNotNull()
    finance_ok = is_blank("finance_lob")
    for lob, accepted in ALLOWED_FINANCE.items():
        finance_ok = finance_ok | ((target == lob) & F.col("finance_lob").isin(list(accepted)))
    reason = (
        F.when(~gated, SKILL_OR_ORG)
        .when(finance_ok, SKILL_ORG_FINANCE)
        .when((target == "MA") & F.col("_org_ok").isNull(), ORG_MISS)
        .otherwise(FINANCE_MISS)
    )
    return _finish(rows, columns, ~gated | finance_ok, reason, target)


def first_match(calls: DataFrame, lookup: DataFrame) -> DataFrame:
    """Exactly one row per call: the path says provider or member, the skill number decides the rest.

    ``lookup`` has (lob, key); keys and codes are compared as integers.
    """
    columns = calls.columns
    groups = (
        lookup.select(F.col("key").try_cast("bigint").alias("_skill_no"), "lob")
        .where("_skill_no is not null")
        .groupBy("_skill_no")
        .agg(F.collect_set("lob").alias("_lobs"))
    )
    joined = join_lookup(calls.withColumn("_skill_no", F.col("cd10").try_cast("bigint")), groups, "_skill_no")

    def listed(lob: str) -> Column:
        return F.coalesce(F.array_contains("_lobs", lob), F.lit(False))

    path = F.lower("path")
    provider, member = F.contains(path, F.lit("provider")), F.contains(path, F.lit("member"))
    lob = F.when(provider, F.when(listed("Provider"), "Provider")).when(
        member, F.when(listed("IFP"), "IFP").when(listed("Core Premier"), "Core Premier")
    )
    reason = (
        F.when(lob.isNotNull(), F.concat(F.lit("Filtered for "), lob))
        .when(provider, NOT_PROVIDER)
        .when(member, SKILL_MISS)
        .otherwise(FILENAME)
    )
    return _finish(joined, columns, lob.isNotNull(), reason, lob)


def ordered_prefix(
    calls: DataFrame, lookup: DataFrame, lobs: Sequence[str] = PREFIX_LOBS, order: str = "ord"
) -> DataFrame:
    """Exactly one row per call: the first of ``lobs`` that the skill's LOB text starts with.

    ``lookup`` has (skill_id, lob_text) and the sheet's row order; of a repeated skill the first row by ``order`` counts.  A known finance
    LOB changes the reason only.
    """
    columns = calls.columns
    first = latest_per_key(lookup, "skill_id", [F.asc(order)])
    side = first.select(F.col("skill_id").alias("cd10"), F.col("lob_text").alias("_text"))
    joined = join_lookup(calls, side, "cd10")
    lob = F.coalesce(*[F.when(F.startswith("_text", F.lit(name)), name) for name in lobs])
    has_skill = nonblank("cd10").isNotNull()
    known = F.col("member_key").isNotNull() & F.col("finance_known")
    chosen = has_skill & lob.isNotNull()
    reason = (
        F.when(~has_skill, LOB_CONDITIONS)
        .when(lob.isNull(), SKILL_MISS)
        .when(known, SKILL_FINANCE)
        .otherwise(SKILL)
    )
    return _finish(joined, columns, chosen, reason, lob)


def audit_rows(routed: DataFrame, source: str | Column, run_date: str | Column) -> DataFrame:
    """One audit record per decision, absent fields filled with the log's defaults.

    Content columns (``language, mediaId, status, dateCreated, contentType, channels``) are optional.
    """
    have = set(routed.columns)

    def text(name: str, default: str = "") -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(default)) if name in have else F.lit(default)

    source = F.lit(source) if isinstance(source, str) else source
    run_date = F.lit(run_date) if isinstance(run_date, str) else run_date
    # a call with no member key, and one whose member is unknown, read the same
    finance = F.coalesce("finance_lob", F.lit(NOT_AVAILABLE)) if "finance_lob" in have else F.lit(NOT_AVAILABLE)
    record = {
        "filename": basename("path"),
        "file_location": F.col("path"),
        "finance_lob": finance,
        "language": text("language", "en-US"),
        "media_id": text("mediaId"),
        "status": text("status"),
        "date_created": text("dateCreated"),
        "content_type": text("contentType"),
        "channels": text("channels"),
        "length": text("length", "0"),
        "cd8_eduid": text("cd8"),
        "cd10_skill_id": text("cd10"),
        "cd6_subscriber_id": text("cd6"),
        "cd48_member_id": text("cd48"),
        "cd93_subscriber_id": text("cd93"),
        "cd69_queue_name": text("cd69"),
        "source": source,
        "is_selected": F.when(F.col("selected"), "Yes").otherwise("No"),
        "selection_condition": F.col("reason"),
        "selected_lob": F.col("lob"),
        "run_date": F.to_date(run_date),
        "direction": text("direction", "0"),
        "duration_seconds": text("duration", "0"),
    }
    extra = [F.col("other_metadata")] if "other_metadata" in have else []
    return routed.select(*[c.alias(n) for n, c in record.items()], *extra)


def widen_metadata(audit: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Passthrough metadata keys as columns of their own; the keys to widen are the caller's."""
    return audit.select(
        *[c for c in audit.columns if c != "other_metadata"],
        *[F.col("other_metadata").getItem(k).alias(k) for k in keys],
    )
