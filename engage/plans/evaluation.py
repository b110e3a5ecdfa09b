"""Classifier evaluation on a deterministic score, and the splits that feed a model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from engage.functions import rounded
from engage.operators import evaluate, model
from engage.plans.fixtures import SCORED, SCORED_RAW, derive, with_ctes


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return derive(spark, folder, SCORED)


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: rounded(c, 6) for c in cols})


def auc(spark: SparkSession, folder: str) -> DataFrame:
    return _round(evaluate.auc(_scored(spark, folder)), "auc")


def ks(spark: SparkSession, folder: str) -> DataFrame:
    return _round(evaluate.ks(_scored(spark, folder)), "ks")


def roc_points(spark: SparkSession, folder: str) -> DataFrame:
    return _round(evaluate.roc_points(_scored(spark, folder)), "fpr", "tpr")


def pr_points(spark: SparkSession, folder: str) -> DataFrame:
    return _round(evaluate.pr_points(_scored(spark, folder)), "precision", "recall", "f1")


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    """At the holdout and at the backtest threshold."""
    scored = _scored(spark, folder)
    out = None
    for threshold in (0.5, 0.8):
        part = evaluate.confusion(scored, threshold).withColumn("threshold", F.lit(threshold))
        out = part if out is None else out.unionByName(part)
    return out


def classification_report(spark: SparkSession, folder: str) -> DataFrame:
    return _round(evaluate.report(_scored(spark, folder)), "precision", "recall", "f1")


def deciles(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.deciles(_scored(spark, folder)).select("id", "decile")


def lift_table(spark: SparkSession, folder: str) -> DataFrame:
    return _round(evaluate.lift_table(_scored(spark, folder)), "avg_prob", "event_rate", "cumulative_event_rate")


def deciles_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Deciles of an unrounded score with ties and gaps."""
    return evaluate.deciles(derive(spark, folder, SCORED_RAW)).select("id", "decile")


def lift_table_raw(spark: SparkSession, folder: str) -> DataFrame:
    lift = evaluate.lift_table(derive(spark, folder, SCORED_RAW))
    return _round(lift, "avg_prob", "event_rate", "cumulative_event_rate")


def risk_tiers(spark: SparkSession, folder: str) -> DataFrame:
    return model.risk_tier(_scored(spark, folder)).select("id", "risk_category")


def tier_counts(spark: SparkSession, folder: str) -> DataFrame:
    return model.tier_counts(model.risk_tier(_scored(spark, folder)))


def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    return model.stratified_split(_scored(spark, folder), "id", "y").select("id", "y", "is_test")


def fold_assignment(spark: SparkSession, folder: str) -> DataFrame:
    return model.folds(_scored(spark, folder), "id", "y").select("id", "y", "fold")


def fold_counts(spark: SparkSession, folder: str) -> DataFrame:
    return model.folds(_scored(spark, folder), "id", "y").groupBy("y", "fold").agg(F.count(F.lit(1)).alias("n"))


def class_weights(spark: SparkSession, folder: str) -> DataFrame:
    return _round(model.class_weights(_scored(spark, folder), "y"), "weight")


BY_SCORE = "SELECT p AS threshold, sum(y) AS pos, sum(1 - y) AS neg FROM scored GROUP BY p"
CURVE = """
SELECT threshold, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg,
       CAST(sum(pos) OVER (ORDER BY threshold DESC) AS BIGINT) AS tp, CAST(sum(neg) OVER (ORDER BY threshold DESC) AS BIGINT) AS fp,
       sum(pos) OVER () AS pt, sum(neg) OVER () AS nt FROM by_score
"""
PR = """
SELECT threshold, tp * 1.0::DOUBLE / (tp + fp) AS pr, tp * 1.0::DOUBLE / pt AS rc FROM curve
UNION ALL SELECT NULL, 1.0, 0.0
"""
# Edges lie between order statistics at positions counted in tenths, which a double would miss at ties.
BINNED = """
SELECT s.*, CASE WHEN s.p IS NOT NULL THEN len(list_filter(e.ed, lambda x: x < s.p)) END AS decile FROM scored s,
  (SELECT list_distinct(list_filter(list(edge), lambda x: x > min(lowest))) AS ed FROM (
     SELECT v[1 + (i * (n - 1)) // 10] + (v[least(n, 2 + (i * (n - 1)) // 10)] - v[1 + (i * (n - 1)) // 10]) * (((i * (n - 1)) % 10) / 10.0::DOUBLE) AS edge, v[1] AS lowest
     FROM (SELECT list(p ORDER BY p) AS v, count(*) AS n FROM scored WHERE p IS NOT NULL) o, (SELECT unnest(range(1, 10)) AS i) k) d) e
"""
LIFT = """
SELECT CAST(decile AS INT) AS decile, n AS count, events, round(ap, 6) AS avg_prob,
       round(events * 1.0::DOUBLE / n, 6) AS event_rate,
       CAST(sum(events) OVER (ORDER BY decile) AS BIGINT) AS cumulative_events,
       round(sum(events) OVER (ORDER BY decile) * 1.0::DOUBLE / sum(events) OVER (), 6) AS cumulative_event_rate
FROM (SELECT decile, count(*) AS n, CAST(sum(y) AS BIGINT) AS events, avg(p) AS ap FROM binned WHERE decile IS NOT NULL GROUP BY decile) g
"""
CELLS = """
SELECT count(*) FILTER (y = 1 AND p >= 0.5)::DOUBLE AS tp, count(*) FILTER (y = 0 AND p >= 0.5)::DOUBLE AS fp,
       count(*) FILTER (y = 1 AND p < 0.5)::DOUBLE AS fn, count(*) FILTER (y = 0 AND p < 0.5)::DOUBLE AS tn FROM scored
"""
CLASSES = """
SELECT '0' AS class, tn / (tn + fn) AS precision, tn / (tn + fp) AS recall, 2 * tn / (2 * tn + fp + fn) AS f1, tn + fp AS support FROM cells
UNION ALL
SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM cells
"""
RANKED = """
SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5(CAST(id AS VARCHAR))) AS rn, count(*) OVER (PARTITION BY y) AS n FROM scored
"""


def _oracle(body: str, **ctes: str) -> str:
    return with_ctes(body, scored=SCORED, **ctes)


QUERIES = {
    "auc": auc,
    "ks": ks,
    "roc_points": roc_points,
    "pr_points": pr_points,
    "confusion": confusion,
    "classification_report": classification_report,
    "deciles": deciles,
    "lift_table": lift_table,
    "deciles_raw": deciles_raw,
    "lift_table_raw": lift_table_raw,
    "risk_tiers": risk_tiers,
    "tier_counts": tier_counts,
    "stratified_split": stratified_split,
    "fold_assignment": fold_assignment,
    "fold_counts": fold_counts,
    "class_weights": class_weights,
}

_TIER = "CASE WHEN p > 0.8 THEN 'High Risk' WHEN p > 0.5 THEN 'Medium Risk' ELSE 'Low Risk' END"

ORACLE = {
    "auc": _oracle(
        """SELECT round((sum(r) FILTER (y = 1) - np * (np + 1) / 2) / (np * nn), 6) AS auc
FROM (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS r,
             sum(y) OVER () * 1.0::DOUBLE AS np, sum(1 - y) OVER () * 1.0::DOUBLE AS nn FROM scored) t GROUP BY np, nn"""
    ),
    "ks": _oracle(
        "SELECT round(max(abs(tp * 1.0::DOUBLE / pt - fp * 1.0::DOUBLE / nt)), 6) AS ks FROM curve", by_score=BY_SCORE, curve=CURVE
    ),
    "roc_points": _oracle(
        """SELECT threshold, tp, fp, round(fp * 1.0::DOUBLE / nt, 6) AS fpr, round(tp * 1.0::DOUBLE / pt, 6) AS tpr FROM curve
UNION ALL SELECT NULL, 0, 0, 0.0, 0.0""",
        by_score=BY_SCORE,
        curve=CURVE,
    ),
    "pr_points": _oracle(
        """SELECT threshold, round(pr, 6) AS precision, round(rc, 6) AS recall,
       round(2 * pr * rc / (pr + rc + 1e-8), 6) AS f1 FROM pr_curve""",
        by_score=BY_SCORE,
        curve=CURVE,
        pr_curve=PR,
    ),
    "confusion": _oracle(
        """SELECT t.threshold, a.v AS actual, q.v AS predicted,
  count(*) FILTER (s.y = a.v AND (CASE WHEN s.p >= t.threshold THEN 1 ELSE 0 END) = q.v) AS n
FROM scored s, (VALUES (0.5::DOUBLE), (0.8::DOUBLE)) t(threshold), (VALUES (0), (1)) a(v), (VALUES (0), (1)) q(v) GROUP BY 1, 2, 3"""
    ),
    "classification_report": _oracle(
        """SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM (
SELECT * FROM classes
UNION ALL SELECT 'accuracy', (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), (tp + tn) / (tp + tn + fp + fn), tp + tn + fp + fn FROM cells
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM classes
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), sum(support) FROM classes) u""",
        cells=CELLS,
        classes=CLASSES,
    ),
    "deciles": _oracle("SELECT id, CAST(decile AS INT) AS decile FROM binned", binned=BINNED),
    "lift_table": _oracle(
        LIFT,
        binned=BINNED,
    ),
    "deciles_raw": with_ctes("SELECT id, CAST(decile AS INT) AS decile FROM binned", scored=SCORED_RAW, binned=BINNED),
    "lift_table_raw": with_ctes(LIFT, scored=SCORED_RAW, binned=BINNED),
    "risk_tiers": _oracle(f"SELECT id, {_TIER} AS risk_category FROM scored"),
    "tier_counts": _oracle(f"SELECT {_TIER} AS risk_category, count(*) AS n FROM scored GROUP BY 1"),
    "stratified_split": _oracle(
        "SELECT id, y, CASE WHEN rn <= ceil(n * 0.2) THEN 1 ELSE 0 END AS is_test FROM ranked", ranked=RANKED
    ),
    "fold_assignment": _oracle("SELECT id, y, CAST((rn - 1) % 5 AS INT) AS fold FROM ranked", ranked=RANKED),
    "fold_counts": _oracle(
        "SELECT y, CAST((rn - 1) % 5 AS INT) AS fold, count(*) AS n FROM ranked GROUP BY 1, 2", ranked=RANKED
    ),
    "class_weights": _oracle(
        "SELECT y, count(*) AS n, round((SELECT count(*) FROM scored) / (2.0::DOUBLE * count(*)), 6) AS weight FROM scored GROUP BY y"
    ),
}
