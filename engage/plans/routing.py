"""Call routing, audit rows and the daily log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from engage.operators import audit, enrich, route
from engage.plans.fixtures import (
    CALLS,
    LOOKUP_A,
    LOOKUP_B,
    LOOKUP_C,
    MEMBER_PERIODS,
    ORG_OK,
    derive,
    table,
    with_ctes,
)
from engage.plans import jobs
from engage.session import materialise, shared_dir
from engage.sources.documents import parse_documents, readable

DECISION = ["call_id", "selected", "reason", "lob"]
SOURCES = {"A": "feed-a", "B": "feed-b", "C": "feed-c"}


def _lobs(spark: SparkSession, folder: str) -> DataFrame:
    periods = derive(spark, folder, MEMBER_PERIODS)
    return enrich.latest_lob(periods, ties=("mbr_sfx", "o_orderkey"))


def _gated(spark: SparkSession, folder: str) -> DataFrame:
    return route.gate(derive(spark, folder, CALLS))


def _known(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.with_finance_lob(_gated(spark, folder), _lobs(spark, folder))


def _multi(spark: SparkSession, calls: DataFrame) -> DataFrame:
    return route.multi_route(calls, spark.sql(LOOKUP_A), spark.sql(ORG_OK))


def _first(spark: SparkSession, calls: DataFrame) -> DataFrame:
    return route.first_match(calls, spark.sql(LOOKUP_B))


def _prefix(spark: SparkSession, calls: DataFrame) -> DataFrame:
    return route.ordered_prefix(calls, spark.sql(LOOKUP_C), order="ord")


def _all_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """Every call under its own feed's rule; the joined calls are written once for the three rules."""
    known = materialise(_known(spark, folder), "known")
    parts = [rule(spark, known.where(F.col("feed") == f)) for f, rule in zip("ABC", (_multi, _first, _prefix))]
    return enrich.union_tables(*parts)


def _audit(spark: SparkSession, folder: str) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in SOURCES.items() for x in pair])
    return route.audit_rows(_all_feeds(spark, folder), names[F.col("feed")], F.col("run_date"))


def latest_lob(spark: SparkSession, folder: str) -> DataFrame:
    return _lobs(spark, folder)


def member_keys(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.member_keys(_gated(spark, folder))


def prefix_semi_join(spark: SparkSession, folder: str) -> DataFrame:
    periods = derive(spark, folder, MEMBER_PERIODS)
    return enrich.prefix_semi_join(periods, enrich.member_keys(_gated(spark, folder)))


def finance_lob(spark: SparkSession, folder: str) -> DataFrame:
    return _known(spark, folder).select(
        "call_id",
        F.coalesce("finance_lob", F.lit(enrich.NOT_AVAILABLE)).alias("finance_lob"),
        "finance_known",
    )


def gate_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return _gated(spark, folder).select("call_id", "member_key", "parse_ok", "gate_reason")


def audit_record(spark: SparkSession, folder: str) -> DataFrame:
    return _audit(spark, folder)


def route_multi(spark: SparkSession, folder: str) -> DataFrame:
    return _multi(spark, _known(spark, folder)).select(*DECISION)


def route_first_match(spark: SparkSession, folder: str) -> DataFrame:
    return _first(spark, _known(spark, folder)).select(*DECISION)


def route_ordered_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return _prefix(spark, _known(spark, folder)).select(*DECISION)


def routed_counts(spark: SparkSession, folder: str) -> DataFrame:
    return audit.routed_counts(_all_feeds(spark, folder), [*route.MULTI_LOBS, "Provider", "Never"])


def daily_log(spark: SparkSession, folder: str) -> DataFrame:
    return audit.daily_log(_audit(spark, folder), source_like="feed-%", by=("selected_lob", "run_date", "source"))


def processed_counts(spark: SparkSession, folder: str) -> DataFrame:
    scored = table(spark, folder, "events").select(
        F.col("user_id").alias("id"),
        F.nullif("event_type", F.lit("view")).alias("org_id"),
        F.to_date("ts").alias("processed_date"),
    )
    return audit.processed_counts(scored, "purchase")


def united_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct ids per org over all days, from the days' sketches, against the exact count: within 5 %."""
    scored = table(spark, folder, "events").select(
        F.col("user_id").alias("id"), F.col("event_type").alias("org_id"), F.to_date("ts").alias("day")
    )
    daily = materialise(audit.count_sketches(scored, ["org_id", "day"]), "sketches")
    exact = scored.groupBy("org_id").agg(F.count_distinct("id").alias("exact"))
    days = daily.groupBy("org_id").agg(F.count(F.lit(1)).alias("days"))
    found = audit.united_counts(daily, ["org_id"]).join(exact, "org_id").join(days, "org_id")
    return found.select("org_id", "days", "exact", (F.abs(F.col("n") - F.col("exact")) <= 0.05 * F.col("exact")).alias("close"))


def document_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Calls written as JSON documents, every eleventh one broken, parsed back to their codes."""
    calls = derive(spark, folder, CALLS)
    body = F.to_json(
        F.struct(
            F.lit("en-GB").alias("language"),
            F.array(F.struct(F.col("call_id").alias("n"))).alias("channels"),
            F.struct(
                F.col("cd10").alias("CD10"),
                F.col("cd48").alias("CD48"),
                F.col("call_id").alias("extra"),
                F.col("duration").cast("int").alias("Duration_seconds"),
            ).alias("metadata"),
        )
    )
    broken = F.when(F.col("call_id") % 11 == 0, F.substring(body, F.lit(2), F.length(body))).otherwise(body)
    documents = parse_documents(calls.select("call_id", "path", broken.alias("body")))
    return route.codes(readable(documents), drop_empty=True).select(
        "call_id",
        "path",
        "language",
        "channels",
        "cd10",
        "cd48",
        "cd93",
        "duration",
        F.col("other_metadata").getItem("extra").alias("extra"),
    )


def _routed_job(spark: SparkSession, folder: str) -> dict[str, str]:
    """Feed A's calls as JSON documents, every eleventh broken and one archive unreadable, through the whole job, twice."""
    calls = derive(spark, folder, CALLS).where("feed = 'A'")
    metadata = F.create_map(
        *[
            x
            for code, column in (("CD10", "cd10"), ("CD48", "cd48"), ("CD93", "cd93"), ("CD69", "cd69"), ("org_id", "org_id"),
                                 ("Direction", "direction"), ("Duration_seconds", "duration"))
            for x in (F.lit(code), F.col(column))
        ],
        F.lit("extra"),
        F.col("call_id").cast("string"),
    )
    body = F.to_json(F.struct(F.lit("en-US").alias("language"), F.lit("done").alias("status"), metadata.alias("metadata")))
    broken = F.when(F.col("call_id") % 11 == 0, F.substring(body, F.lit(2), F.length(body))).otherwise(body)
    bodies = calls.select("path", broken.alias("body"), F.lit(None).cast("string").alias("error")).unionByName(
        spark.createDataFrame([("/in/bad.zip", None, "not a zip file")], "path string, body string, error string")
    )
    out = {n: shared_dir(spark, n) for n in ("audit_path", "routed_path", "errors_path", "log_path")}
    periods = derive(spark, folder, MEMBER_PERIODS)
    for _ in range(2):
        jobs.route_feed(
            bodies, periods, lambda c: _multi(spark, c), "feed-a", "2024-05-06", started="2024-05-06 01:00:00",
            ended="2024-05-06 02:00:00", **out,
        )
    return out


def route_feed_audit(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(_routed_job(spark, folder)["audit_path"])
    return rows.select(
        "file_location", "is_selected", "selected_lob", "selection_condition", "status", "cd10_skill_id", "direction",
        "duration_seconds", F.col("other_metadata").getItem("extra").alias("extra"), "run_date", "source",
    )


def route_feed_documents(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(_routed_job(spark, folder)["routed_path"])
    body = F.from_json("document", "status string, metadata map<string,string>")
    return rows.select(
        "path", "lob", "feed", "status", body["metadata"]["extra"].alias("extra"), F.map_keys(body["metadata"]).alias("k")
    ).withColumn("n_codes", F.size("k")).drop("k")


def route_feed_errors(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(_routed_job(spark, folder)["errors_path"])


def route_feed_log(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(_routed_job(spark, folder)["log_path"])
    return rows.select(
        "selected_lob", "source", "total_transcript_count", "inbound_calls_count",
        F.date_format("global_filter_start", "HH:mm").alias("started"), F.date_format("global_filter_end", "HH:mm").alias("ended"),
    )


LATEST = """
SELECT subscriber_id || mbr_sfx AS member_id, finance_lob FROM (
  SELECT *, row_number() OVER (PARTITION BY subscriber_id ORDER BY study_period DESC, mbr_sfx, o_orderkey) AS rn FROM member_periods) t WHERE rn = 1
"""
GATED = """
SELECT c.*, coalesce(nullif(cd48,''), nullif(cd93,''), nullif(cd6,'')) AS member_key,
       TRY_CAST(direction AS INT) IS NOT NULL AND TRY_CAST(duration AS INT) IS NOT NULL AS parse_ok,
       CASE WHEN coalesce(TRY_CAST(direction AS INT), 0) <> 1 THEN 'Not filtered due to direction condition'
            WHEN coalesce(TRY_CAST(duration AS INT), 0) <= 60 THEN 'Not filtered due to duration condition' END AS gate_reason
FROM calls c
"""
KNOWN = "SELECT g.*, l.finance_lob FROM gated g LEFT JOIN latest_lob l ON l.member_id = g.member_key"
MULTI = """
SELECT k.*, FALSE AS selected, gate_reason AS reason, '' AS lob FROM known k WHERE gate_reason IS NOT NULL
UNION ALL
SELECT * EXCLUDE (target, ok, org_hit), ok AS selected,
       CASE WHEN target NOT IN ('MA', 'IFP') OR member_key IS NULL THEN 'Filtered for skill id or org id'
            WHEN ok THEN 'Filtered for skill id, org id, and finance lob'
            WHEN target = 'MA' AND NOT org_hit THEN 'Not filtered due to org id not matched'
            ELSE 'Not filtered due to finance lob not matched' END AS reason,
       CASE WHEN ok THEN target ELSE '' END AS lob
FROM (SELECT k.*, h.target, k.org_id IN (SELECT org_id FROM org_ok) AS org_hit,
             h.target NOT IN ('MA', 'IFP') OR k.member_key IS NULL OR coalesce(trim(k.finance_lob), '') = ''
             OR (h.target = 'MA' AND k.finance_lob IN ('GMAPD', 'Total MAPD'))
             OR (h.target = 'IFP' AND k.finance_lob = 'Individual (IFP)') AS ok
      FROM known k JOIN (
        SELECT k2.call_id AS hit_id, a.lob AS target FROM known k2 JOIN lookup_a a ON a.kind = 'skill' AND a.key = k2.cd10
        UNION SELECT k2.call_id, a.lob FROM known k2 JOIN lookup_a a ON a.kind = 'queue' AND a.key = k2.cd69) h
      ON h.hit_id = k.call_id WHERE k.gate_reason IS NULL) t
"""
FIRST = """
SELECT * EXCLUDE (target), gate_reason IS NULL AND target IS NOT NULL AS selected,
       CASE WHEN gate_reason IS NOT NULL THEN gate_reason
            WHEN target IS NOT NULL THEN 'Filtered for ' || target
            WHEN contains(lower(path), 'provider') THEN 'Not filtered due to not provider transcripts.'
            WHEN contains(lower(path), 'member') THEN 'Not filtered due to skill id not matched'
            ELSE 'Not filtered due to filename conditions' END AS reason,
       CASE WHEN gate_reason IS NULL THEN coalesce(target, '') ELSE '' END AS lob
FROM (SELECT k.*, CASE
        WHEN contains(lower(path), 'provider') THEN (SELECT max(lob) FROM lookup_b b WHERE b.lob = 'Provider' AND b.key = k.cd10)
        WHEN contains(lower(path), 'member') THEN coalesce(
          (SELECT max(lob) FROM lookup_b b WHERE b.lob = 'IFP' AND b.key = k.cd10),
          (SELECT max(lob) FROM lookup_b b WHERE b.lob = 'Core Premier' AND b.key = k.cd10)) END AS target
      FROM known k) t
"""
PREFIX = """
SELECT * EXCLUDE (target), gate_reason IS NULL AND target IS NOT NULL AS selected,
       CASE WHEN gate_reason IS NOT NULL THEN gate_reason
            WHEN cd10 = '' THEN 'Not filtered due to LOB conditions'
            WHEN target IS NULL THEN 'Not filtered due to skill id not matched'
            WHEN member_key IS NOT NULL AND finance_lob IS NOT NULL THEN 'Filtered for skill id and finance lob'
            ELSE 'Filtered for skill id' END AS reason,
       CASE WHEN gate_reason IS NULL THEN coalesce(target, '') ELSE '' END AS lob
FROM (SELECT k.*, CASE WHEN c.lob_text LIKE 'Small Group%' THEN 'Small Group' WHEN c.lob_text LIKE 'IFP%' THEN 'IFP'
                       WHEN c.lob_text LIKE 'Broker%' THEN 'Broker' END AS target
      FROM known k LEFT JOIN lookup_c c ON c.skill_id = k.cd10) t
"""
ALL_FEEDS = """
SELECT * FROM multi WHERE feed = 'A' UNION ALL SELECT * FROM first_rule WHERE feed = 'B'
UNION ALL SELECT * FROM prefix_rule WHERE feed = 'C'
"""
AUDIT = """
SELECT regexp_extract(path, '[^/]*$') AS filename, path AS file_location, coalesce(finance_lob, 'Not Available') AS finance_lob,
       'en-US' AS language, '' AS media_id, '' AS status, '' AS date_created, '' AS content_type, '' AS channels, '0' AS length,
       '' AS cd8_eduid, cd10 AS cd10_skill_id, coalesce(cd6, '') AS cd6_subscriber_id, cd48 AS cd48_member_id,
       cd93 AS cd93_subscriber_id, cd69 AS cd69_queue_name, 'feed-' || lower(feed) AS source,
       CASE WHEN selected THEN 'Yes' ELSE 'No' END AS is_selected, reason AS selection_condition, lob AS selected_lob,
       run_date, direction, duration AS duration_seconds
FROM routed
"""
BASE = {
    "calls": CALLS,
    "member_periods": MEMBER_PERIODS,
    "latest_lob": LATEST,
    "lookup_a": LOOKUP_A,
    "org_ok": ORG_OK,
    "lookup_b": LOOKUP_B,
    "lookup_c": LOOKUP_C,
    "gated": GATED,
    "known": KNOWN,
    "multi": MULTI,
    "first_rule": FIRST,
    "prefix_rule": PREFIX,
    "routed": ALL_FEEDS,
    "audited": AUDIT,
}


def _oracle(body: str) -> str:
    return with_ctes(body, **BASE)


JOB = {
    **BASE,
    "calls": CALLS + " WHERE event_id % 3 = 0",
    "latest_lob": LATEST.replace("mbr_sfx, o_orderkey", "mbr_sfx, finance_lob NULLS FIRST"),
    "job": "SELECT * FROM multi WHERE call_id % 11 <> 0",
}

QUERIES = {
    "latest_lob": latest_lob,
    "member_keys": member_keys,
    "prefix_semi_join": prefix_semi_join,
    "finance_lob": finance_lob,
    "gate_reasons": gate_reasons,
    "audit_record": audit_record,
    "route_multi": route_multi,
    "route_first_match": route_first_match,
    "route_ordered_prefix": route_ordered_prefix,
    "routed_counts": routed_counts,
    "daily_log": daily_log,
    "processed_counts": processed_counts,
    "united_counts": united_counts,
    "document_scan": document_scan,
    "route_feed_audit": route_feed_audit,
    "route_feed_documents": route_feed_documents,
    "route_feed_errors": route_feed_errors,
    "route_feed_log": route_feed_log,
}

ORACLE = {
    "latest_lob": _oracle("SELECT * FROM latest_lob"),
    "member_keys": _oracle("SELECT DISTINCT member_key FROM gated WHERE member_key IS NOT NULL"),
    "prefix_semi_join": _oracle(
        """SELECT * FROM member_periods WHERE left(subscriber_id, 9) IN (SELECT member_key FROM gated WHERE member_key IS NOT NULL)
OR left(subscriber_id || mbr_sfx, 11) IN (SELECT member_key FROM gated WHERE member_key IS NOT NULL)"""
    ),
    "finance_lob": _oracle(
        "SELECT call_id, coalesce(finance_lob, 'Not Available') AS finance_lob, finance_lob IS NOT NULL AS finance_known FROM known"
    ),
    "gate_reasons": _oracle("SELECT call_id, member_key, parse_ok, gate_reason FROM gated"),
    "audit_record": _oracle("SELECT * FROM audited"),
    "route_multi": _oracle("SELECT call_id, selected, reason, lob FROM multi"),
    "route_first_match": _oracle("SELECT call_id, selected, reason, lob FROM first_rule"),
    "route_ordered_prefix": _oracle("SELECT call_id, selected, reason, lob FROM prefix_rule"),
    "routed_counts": _oracle(
        """SELECT w.lob, count(r.lob) AS n FROM (VALUES ('MA'),('IFP'),('Broker'),('Small Group'),('MediCal'),('Core Premier'),
('Provider'),('Never')) AS w(lob) LEFT JOIN routed r ON r.lob = w.lob AND r.selected GROUP BY w.lob"""
    ),
    "daily_log": _oracle(
        """SELECT selected_lob, run_date, source, count(*) AS total_transcript_count,
       count(*) FILTER (TRY_CAST(direction AS INT) = 2) AS outbound_calls_count,
       count(*) FILTER (TRY_CAST(direction AS INT) = 1) AS inbound_calls_count,
       count(*) FILTER (trim(cd10_skill_id) <> '') AS skill_id_present,
       count(*) FILTER (trim(cd69_queue_name) <> '') AS queue_name_present,
       count(*) FILTER (trim(cd48_member_id) <> '' OR trim(cd93_subscriber_id) <> '' OR trim(cd6_subscriber_id) <> '') AS member_id_present,
       count(*) FILTER (TRY_CAST(duration_seconds AS INT) > 60) AS length_more_than_60seconds
FROM audited GROUP BY selected_lob, run_date, source"""
    ),
    "route_feed_audit": with_ctes(
        """SELECT path AS file_location, CASE WHEN selected THEN 'Yes' ELSE 'No' END AS is_selected, lob AS selected_lob, reason AS selection_condition,
       'done' AS status, cd10 AS cd10_skill_id, direction, duration AS duration_seconds, CAST(call_id AS VARCHAR) AS extra,
       DATE '2024-05-06' AS run_date, 'feed-a' AS source FROM job""",
        **JOB,
    ),
    "route_feed_documents": with_ctes(
        "SELECT path, lob, 'feed-a' AS feed, 'done' AS status, CAST(call_id AS VARCHAR) AS extra, 8 AS n_codes FROM job WHERE selected", **JOB
    ),
    "route_feed_errors": with_ctes(
        """SELECT path, 'not a JSON document' AS error, DATE '2024-05-06' AS run_date, 'feed-a' AS feed FROM calls WHERE call_id % 11 = 0
UNION ALL SELECT '/in/bad.zip', 'not a zip file', DATE '2024-05-06', 'feed-a'""",
        **JOB,
    ),
    "route_feed_log": with_ctes(
        """SELECT lob AS selected_lob, 'feed-a' AS source, CAST(count(*) AS VARCHAR) AS total_transcript_count,
       CAST(count(*) FILTER (TRY_CAST(direction AS INT) = 1) AS VARCHAR) AS inbound_calls_count, '01:00' AS started, '02:00' AS ended FROM job GROUP BY lob""",
        **JOB,
    ),
    "processed_counts": """
SELECT CAST(ts AS DATE) AS processed_date, count(DISTINCT user_id) FILTER (event_type = 'purchase') AS special_count,
       count(DISTINCT user_id) FILTER (event_type NOT IN ('purchase', 'view')) AS other_count
FROM events WHERE event_type <> 'view' GROUP BY 1""",
    "united_counts": """SELECT event_type AS org_id, count(DISTINCT CAST(ts AS DATE)) AS days, count(DISTINCT user_id) AS exact, TRUE AS close
FROM events GROUP BY 1""",
    "document_scan": with_ctes(
        """SELECT call_id, path, 'en-GB' AS language, '[{"n":' || CAST(call_id AS STRING) || '}]' AS channels, cd10, cd48,
       CAST(NULL AS STRING) AS cd93, duration, CAST(call_id AS STRING) AS extra FROM calls WHERE call_id % 11 <> 0""",
        calls=CALLS,
    ),
}
