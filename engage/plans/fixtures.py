"""The given tables, and the derived frames the queries run on.

The derivations are SQL that Spark and DuckDB read alike, so queries and checks start from the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# Call transcripts from the event stream.
CALLS = """
SELECT event_id AS call_id,
       CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS feed,
       CASE WHEN event_id % 16 = 7 THEN '' WHEN event_id % 16 = 9 THEN 'x' WHEN event_id % 5 = 4 THEN '2' ELSE '1' END AS direction,
       CAST(CAST(floor(value * 5) AS BIGINT) AS STRING) AS duration,
       CASE WHEN event_id % 17 = 0 THEN '' ELSE '106' || CAST(user_id % 10 AS STRING) END AS cd10,
       CASE WHEN event_id % 13 = 0 THEN '' ELSE lpad(CAST(user_id AS STRING), 9, '0') || lpad(CAST(user_id % 3 AS STRING), 2, '0') END AS cd48,
       CASE WHEN event_id % 2 = 0 THEN lpad(CAST(user_id AS STRING), 9, '0') ELSE '' END AS cd93,
       CAST(NULL AS STRING) AS cd6,
       'Q' || event_type AS cd69,
       '80500' || CAST(user_id % 4 AS STRING) AS org_id,
       '/in/' || CASE event_id % 4 WHEN 0 THEN 'Provider_' WHEN 3 THEN 'other_' ELSE 'Member_' END || CAST(event_id AS STRING) || '.json' AS path,
       CAST(ts AS DATE) AS run_date
FROM events
"""

# Member periods from orders.
MEMBER_PERIODS = """
SELECT lpad(CAST(o_custkey AS STRING), 9, '0') AS subscriber_id,
       lpad(CAST(o_custkey % 3 AS STRING), 2, '0') AS mbr_sfx,
       CASE o_custkey % 6 WHEN 0 THEN 'GMAPD' WHEN 1 THEN 'Total MAPD' WHEN 2 THEN 'Individual (IFP)' WHEN 3 THEN '' WHEN 4 THEN 'Large Group' ELSE NULL END AS finance_lob,
       CAST(o_orderdate AS DATE) AS study_period, o_orderkey
FROM orders
"""

# Monthly member snapshots with an eligibility span, from orders.
MEMBER_SNAPSHOTS = """
SELECT lpad(CAST(o_custkey AS STRING), 9, '0') AS member_id,
       CASE o_custkey % 4 WHEN 0 THEN 'IFP On' WHEN 1 THEN 'Off IFP' WHEN 2 THEN 'Large Group' ELSE 'MA' END AS markets_lob,
       last_day(CAST(o_orderdate AS DATE)) AS study_end_dt,
       CAST(o_orderdate AS DATE) - CAST(o_custkey % 60 AS INT) AS first_elig_month_start_dt,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INT) AS last_elig_month_end_dt
FROM orders
"""

LOOKUP_A = """
SELECT * FROM (VALUES (1,'MA','skill','1060'),(1,'MA','skill','1061'),(1,'MA','skill','1062'),(2,'IFP','skill','1062'),(2,'IFP','skill','1063'),
  (3,'Broker','skill','1064'),(4,'Small Group','skill','1065'),(5,'MediCal','skill','1066'),(5,'MediCal','queue','Qsignup'),(6,'Core Premier','skill','1067')) AS v(ord, lob, kind, key)
"""
ORG_OK = "SELECT * FROM (VALUES ('805000'),('805001')) AS v(org_id)"
LOOKUP_B = """
SELECT * FROM (VALUES (1,'Provider','1060'),(1,'Provider','1061'),(1,'Provider','1062'),(2,'IFP','1063'),(2,'IFP','1064'),(3,'Core Premier','1064'),(3,'Core Premier','1065')) AS v(ord, lob, key)
"""
LOOKUP_C = """
SELECT * FROM (VALUES (1,'1060','Small Group West'),(2,'1061','IFP On'),(3,'1062','Broker Desk'),(4,'1063','Other'),(5,'1064','IFP Off')) AS v(ord, skill_id, lob_text)
"""

# A deterministic score with ties.
SCORED = """
SELECT c_custkey AS id,
       CASE WHEN (c_custkey * 7 + 3) % 10 < 3 OR c_acctbal > 8000 THEN 1 ELSE 0 END AS y,
       CAST(round((c_acctbal + 1000) / 11000, 2) AS DOUBLE) AS p
FROM customer
"""

# A score as models give them: not rounded, with ties, and missing for some rows.
SCORED_RAW = """
SELECT c_custkey AS id,
       CASE WHEN (c_custkey * 7 + 3) % 10 < 3 OR c_acctbal > 8000 THEN 1 ELSE 0 END AS y,
       CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_custkey % 137 AS DOUBLE) / 411.0 END AS p
FROM customer
"""

# Member and provider places; fl = provider flag.
GEO = """
SELECT c_custkey AS id, CASE WHEN c_custkey % 4 <> 0 THEN 1 ELSE 0 END AS fl,
       CAST(30 + c_custkey % 200 / 10.0 AS DOUBLE) AS lat1, CAST(-120 + c_custkey % 70 / 10.0 AS DOUBLE) AS lon1,
       CAST(30 + s_suppkey % 180 / 10.0 AS DOUBLE) AS lat2, CAST(-120 + s_suppkey % 60 / 10.0 AS DOUBLE) AS lon2
FROM customer JOIN supplier ON s_suppkey = c_custkey % 10
"""

# Customers with their order totals; customers without orders give NULLs by construction.
WITH_NULLS = """
SELECT c_custkey AS id, CASE WHEN c_custkey % 9 = 0 THEN '  ' WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS balance, t.spent, t.n_orders, CAST(NULL AS DOUBLE) AS nothing
FROM customer LEFT JOIN (
  SELECT o_custkey, sum(o_totalprice) AS spent, count(*) AS n_orders FROM orders GROUP BY o_custkey) t ON o_custkey = c_custkey
"""


def derive(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """Run one of the derivations over the given tables."""
    used = [t for t in TABLES if f" {t}" in sql.replace("\n", " ")]
    text = reduce(
        lambda s, t: s.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}"), used, sql
    )
    return spark.sql(text, **{t: table(spark, folder, t) for t in used if f"{{{t}}}" in text})


def with_ctes(body: str, **ctes: str) -> str:
    """A query over named derivations."""
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes.items()) + "\n" + body
