"""Survival labels and churn rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from engage.functions import rounded
from engage.operators import labels
from engage.operators.enrich import join_dim
from engage.plans.fixtures import MEMBER_SNAPSHOTS, derive, table, with_ctes
from engage.session import materialise

YEARS = range(1995, 2001)


def survival_labels(spark: SparkSession, folder: str) -> DataFrame:
    activity = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("member_id"), F.year("o_orderdate").alias("cycle")
    )
    return labels.next_period_survival(activity, "member_id", "cycle")


def member_survival(spark: SparkSession, folder: str) -> DataFrame:
    return labels.survival(derive(spark, folder, MEMBER_SNAPSHOTS), [labels.year_cycle(y) for y in YEARS])


# A cycle per month that has snapshots: labelled at its end, decided a month later.
CYCLES = """
SELECT CAST(study_end_dt AS STRING) AS label, study_end_dt AS study_end, last_day(study_end_dt + 1) AS future_study_end, study_end_dt + 1 AS active_on
FROM (SELECT DISTINCT last_day(CAST(o_orderdate AS DATE)) AS study_end_dt FROM orders) m
"""


def survival_table(spark: SparkSession, folder: str) -> DataFrame:
    """Survival over every month of the snapshots, the months being a table."""
    cycles = materialise(derive(spark, folder, CYCLES), "cycles")
    return labels.survival_by_table(derive(spark, folder, MEMBER_SNAPSHOTS), cycles)


def cycles_covered(spark: SparkSession, folder: str) -> DataFrame:
    """How many months' first days lie in each snapshot's eligibility span."""
    spans = derive(spark, folder, MEMBER_SNAPSHOTS).select("member_id", "study_end_dt", "first_elig_month_start_dt", "last_elig_month_end_dt")
    cycles = materialise(derive(spark, folder, CYCLES), "cycles")
    found = labels.contained(spans, cycles, "first_elig_month_start_dt", "last_elig_month_end_dt", "active_on")
    return found.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.min("first_elig_month_start_dt").alias("earliest"))


def churn_counts(spark: SparkSession, folder: str) -> DataFrame:
    return labels.counts(survival_labels(spark, folder), "cycle").orderBy("cycle", "survival_flag")


def churn_rate_by_cycle(spark: SparkSession, folder: str) -> DataFrame:
    rates = labels.churn_rate(survival_labels(spark, folder), "cycle")
    return rates.withColumn("churn_rate", rounded("churn_rate", 6)).orderBy("cycle")


def avg_churn_rate(spark: SparkSession, folder: str) -> DataFrame:
    rates = labels.churn_rate(survival_labels(spark, folder), "cycle")
    return labels.avg_churn_rate(rates).select(rounded("avg_churn_rate", 6).alias("avg_churn_rate"))


def provider_flags(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey") % 150).alias("prov_id")
    )
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    joined = join_dim(customers, supplier, "prov_id", "s_suppkey", matched="found")
    return labels.provider_flags(joined, "prov_id", F.col("found")).select(
        "c_custkey", "prov_id", "s_name", "provider_flag", "matched"
    )


LABELS = """
SELECT p.member_id, p.cycle, CASE WHEN n.member_id IS NULL THEN 0 ELSE 1 END AS survival_flag,
       CASE WHEN n.member_id IS NULL THEN 1 ELSE 0 END AS churn_flag
FROM pairs p LEFT JOIN pairs n ON n.member_id = p.member_id AND n.cycle = p.cycle + 1
WHERE p.cycle < (SELECT max(cycle) FROM pairs)
"""
PAIRS = "SELECT DISTINCT o_custkey AS member_id, CAST(year(o_orderdate) AS INT) AS cycle FROM orders"
RATES = """
SELECT cycle, CAST(sum(CASE WHEN survival_flag = 0 THEN 1 ELSE 0 END) AS BIGINT) AS churned_users, count(*) AS total_users,
       sum(CASE WHEN survival_flag = 0 THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*) AS churn_rate
FROM labelled GROUP BY cycle
"""

QUERIES = {
    "survival_labels": survival_labels,
    "member_survival": member_survival,
    "survival_table": survival_table,
    "cycles_covered": cycles_covered,
    "churn_counts": churn_counts,
    "churn_rate_by_cycle": churn_rate_by_cycle,
    "avg_churn_rate": avg_churn_rate,
    "provider_flags": provider_flags,
}

_UNION = "\nUNION\n".join(
    f"""SELECT m.*, '{y}' AS open_enrollment_cycle, CAST(coalesce(c.alive, 0) AS INT) AS survival_flag,
       CAST(1 - coalesce(c.alive, 0) AS INT) AS churn_flag
FROM members m LEFT JOIN (SELECT member_id AS join_key, max(1) AS alive FROM members
  WHERE study_end_dt = DATE '{y + 1}-01-31' AND first_elig_month_start_dt <= DATE '{y + 1}-01-01'
    AND last_elig_month_end_dt >= DATE '{y + 1}-01-01' GROUP BY 1) c ON c.join_key = m.member_id
WHERE markets_lob LIKE '%IFP%' AND study_end_dt = DATE '{y}-12-31'"""
    for y in YEARS
)

ORACLE = {
    "survival_labels": with_ctes(LABELS, pairs=PAIRS),
    "member_survival": with_ctes(_UNION, members=MEMBER_SNAPSHOTS),
    "survival_table": with_ctes(
        """SELECT DISTINCT m.*, c.label AS open_enrollment_cycle, CAST(CASE WHEN x.member_id IS NULL THEN 0 ELSE 1 END AS INT) AS survival_flag,
       CAST(CASE WHEN x.member_id IS NULL THEN 1 ELSE 0 END AS INT) AS churn_flag
FROM members m JOIN cycles c ON m.study_end_dt = c.study_end
LEFT JOIN (SELECT DISTINCT l.member_id, k.label FROM members l JOIN cycles k ON l.study_end_dt = k.future_study_end
  AND l.first_elig_month_start_dt <= k.active_on AND l.last_elig_month_end_dt >= k.active_on) x ON x.member_id = m.member_id AND x.label = c.label
WHERE m.markets_lob LIKE '%IFP%'""",
        members=MEMBER_SNAPSHOTS,
        cycles=CYCLES,
    ),
    "cycles_covered": with_ctes(
        """SELECT label, count(*) AS n, min(first_elig_month_start_dt) AS earliest FROM members JOIN cycles
ON first_elig_month_start_dt <= active_on AND last_elig_month_end_dt >= active_on GROUP BY label""",
        members=MEMBER_SNAPSHOTS,
        cycles=CYCLES,
    ),
    "churn_counts": with_ctes(
        "SELECT cycle, survival_flag, count(*) AS n FROM labelled GROUP BY 1, 2", pairs=PAIRS, labelled=LABELS
    ),
    "churn_rate_by_cycle": with_ctes(
        "SELECT cycle, churned_users, total_users, round(churn_rate, 6) AS churn_rate FROM rates",
        pairs=PAIRS,
        labelled=LABELS,
        rates=RATES,
    ),
    "avg_churn_rate": with_ctes(
        "SELECT round(avg(churn_rate), 6) AS avg_churn_rate FROM rates", pairs=PAIRS, labelled=LABELS, rates=RATES
    ),
    "provider_flags": """
SELECT c.c_custkey, c.prov_id, s.s_name, CASE WHEN c.prov_id IS NOT NULL THEN 1 ELSE 0 END AS provider_flag,
       CASE WHEN s.s_suppkey IS NOT NULL THEN 1 ELSE 0 END AS matched
FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 150 END AS prov_id FROM customer) c
LEFT JOIN supplier s ON s.s_suppkey = c.prov_id""",
}
