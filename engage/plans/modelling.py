"""Churn model on customer-year features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from engage.functions import rounded
from engage.operators import boost, evaluate, labels, model, targets
from engage.plans.fixtures import table
from engage.session import materialise, shared_dir

NUMERIC = ["n_orders", "spent", "biggest", "recency", "balance"]
TEXT = ["segment", "priority", "nation"]
FEATURES = NUMERIC + TEXT
TRAIN_CYCLE = 2000
SMALL = {"maxIter": 8, "maxDepth": 4, "maxBins": 32}


def features(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer and year with that year's orders and the churn label."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").selectExpr(
        "c_custkey member_id", "c_acctbal balance", "c_mktsegment segment", "c_nationkey"
    )
    nation = table(spark, folder, "nation").selectExpr("n_nationkey c_nationkey", "n_name nation")
    per_year = orders.groupBy(F.col("o_custkey").alias("member_id"), F.year("o_orderdate").alias("cycle")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum("o_totalprice").alias("spent"),
        F.max("o_totalprice").alias("biggest"),
        F.max(F.dayofyear("o_orderdate")).alias("recency"),
        F.max("o_orderpriority").alias("priority"),
    )
    last = orders.agg(F.max(F.year("o_orderdate"))).scalar()
    survivors = per_year.select("member_id", (F.col("cycle") - 1).alias("cycle"))
    labelled = labels.label_survivors(per_year.where(F.col("cycle") < last), survivors, ["member_id", "cycle"])
    return (
        labelled.join(customer, "member_id")
        .join(nation, "c_nationkey")
        .withColumn("key", F.concat_ws("/", "member_id", "cycle"))
        .select("key", "cycle", "churn_flag", *FEATURES)
    )


def _split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training rows, test rows of the training cycle, and the other cycles."""
    written = materialise(features(spark, folder), "features")
    current, others = model.split_cycles(written, "cycle", TRAIN_CYCLE)
    split = materialise(model.stratified_split(current, "key", "churn_flag"), "split")
    return split.where("is_test = 0"), split.where("is_test = 1"), others


def _probable(name: str = "p") -> Column:
    return F.col(name).between(0, 1)


def train_score(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows, whether their score is a probability and their tier the one that it asks for."""
    train, test, _ = _split(spark, folder)
    scored = model.risk_tier(model.score(model.train(train, FEATURES, "churn_flag", **SMALL), test))
    asked = F.when(F.col("p") > 0.8, "High Risk").when(F.col("p") > 0.5, "Medium Risk").otherwise("Low Risk")
    return scored.select("key", "churn_flag", (_probable() & (F.col("risk_category") == asked)).alias("consistent"))


def saved_model_score(spark: SparkSession, folder: str) -> DataFrame:
    """Per test row, whether a model written and read back scores like the one in memory."""
    train, test, _ = _split(spark, folder)
    path = shared_dir(spark, "model")
    fitted = model.train(train, FEATURES, "churn_flag", **SMALL)
    model.save(fitted, path)
    loaded = model.score(model.load(path), test).select("key", F.col("p").alias("loaded"))
    return model.score(fitted, test).join(loaded, "key").select("key", (F.col("p") == F.col("loaded")).alias("same"))


def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Every feature, and the sum of all importances."""
    train, _, _ = _split(spark, folder)
    ranking = model.importance(model.train(train, FEATURES, "churn_flag", **SMALL), train, FEATURES)
    # one row per feature reaches this window
    total = F.sum("importance").over(Window.partitionBy(F.lit(0)))
    return ranking.select("feature", F.round(total, 6).alias("total"))


def top_features(spark: SparkSession, folder: str) -> DataFrame:
    """The thirty best features (all, here), and a model on these alone."""
    train, test, _ = _split(spark, folder)
    ranking = model.importance(model.train(train, FEATURES, "churn_flag", **SMALL), train, FEATURES)
    best = [r["feature"] for r in model.top_features(ranking).collect()]
    keep = ["key", "churn_flag"]
    fitted = model.train(model.select_features(train, best, keep), best, "churn_flag", **SMALL)
    scored = model.score(fitted, model.select_features(test, best, keep))
    return scored.select("key", F.lit(len(best)).alias("n_features"), _probable().alias("probable"))


def tuned_recall(spark: SparkSession, folder: str) -> DataFrame:
    """Ten trials of the search, each of 5 to 10 rounds: whether its parameters lie in the space and its recall in [0, 1]."""
    train, _, _ = _split(spark, folder)
    rows = model.tune(train, FEATURES, "churn_flag", rounds=(5, 10))[1]
    inside = (
        F.col("max_depth").between(4, 6)
        & F.col("step_size").between(1e-3, 1e-1)
        & F.col("max_iter").between(5, 10)
        & F.col("max_bins").isin(32.0, 64.0)
    )
    distinct = F.count_distinct("max_depth", "step_size", "max_iter", "max_bins")
    return rows.agg(
        F.count(F.lit(1)).alias("trials"),
        distinct.alias("different"),
        F.every(inside).alias("inside"),
        F.every(_probable("recall")).alias("probable"),
    )


def cross_validated_auc(spark: SparkSession, folder: str) -> DataFrame:
    """Five folds by class: their rows, and whether the mean AUC of the models (8 rounds each) lies in [0, 1]."""
    train, _, _ = _split(spark, folder)
    mean = model.cross_validate(train, FEATURES, "churn_flag", "key", **SMALL)
    sizes = model.folds(train, "key", "churn_flag").groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    return sizes.withColumn("in_range", F.lit(0 <= mean <= 1))


def backtest(spark: SparkSession, folder: str) -> DataFrame:
    """Per earlier cycle: rows, churned rows, and whether the AUC lies in [0, 1]."""
    train, _, others = _split(spark, folder)
    scored = materialise(model.score(model.train(train, FEATURES, "churn_flag", **SMALL), others), "scored")
    sizes = scored.groupBy("cycle").agg(F.count(F.lit(1)).alias("n"), F.sum("churn_flag").cast("long").alias("churned"))
    areas = evaluate.auc(scored, "churn_flag", "p", ["cycle"])
    return sizes.join(areas, "cycle").select("cycle", "n", "churned", F.col("auc").between(0, 1).alias("in_range"))


def permutation_importance(spark: SparkSession, folder: str) -> DataFrame:
    """Every feature and one that is constant, whose permutation can change nothing."""
    train, test, _ = _split(spark, folder)
    train, test = train.withColumn("constant", F.lit(1.0)), test.withColumn("constant", F.lit(1.0))
    features_ = [*FEATURES, "constant"]
    fitted = model.train(train, features_, "churn_flag", **SMALL)
    shuffled = model.permuted_scores(fitted, test, features_, "key", ["churn_flag"])
    drops = evaluate.permutation_scores(shuffled, model.score(fitted, test), "churn_flag", "p")
    known = F.when(F.col("feature") == "constant", F.col("importance") == 0).otherwise(F.col("importance").between(-1, 1))
    return drops.select("feature", known.alias("as_known"))


def dependence(spark: SparkSession, folder: str) -> DataFrame:
    """Bins of a feature, and whether the mean scores in them are probabilities."""
    train, test, _ = _split(spark, folder)
    scored = model.score(model.train(train, FEATURES, "churn_flag", **SMALL), test.withColumn("spent", rounded("spent", 2)))
    bins = evaluate.dependence(scored, "spent")
    return bins.select("bin", "low", "high", "n", _probable("avg_score").alias("probable"))


def ordered_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Two categories as running churn rates of the rows before."""
    rows = materialise(features(spark, folder).select("key", "churn_flag", "segment", "nation"), "features")
    found = targets.ordered_stats(targets.ordered_stats(rows, "segment", "churn_flag", "key"), "nation", "churn_flag", "key")
    return found.select("key", *[rounded(f"{c}_target", 9).alias(c) for c in ("segment", "nation")])


LEAF_ROUNDS, LEAF_STEP, LEAF_L2 = 3, 0.1, 3.0


def boosted_leaves(spark: SparkSession, folder: str) -> DataFrame:
    """Log odds after each of three trees over one flag, whose leaves have the L2 term."""
    rows = features(spark, folder).select("key", "churn_flag", (F.col("n_orders") > 2).cast("double").alias("busy"))
    rows = materialise(rows, "busy")
    fitted = boost.boost(rows, ["busy"], "churn_flag", LEAF_ROUNDS, LEAF_STEP, LEAF_L2, depth=1)
    each = [
        boost.score(fitted, rows.select("busy").distinct(), "p", rounds).select(
            F.lit(rounds).alias("trees"), F.col("busy").cast("int").alias("busy"), rounded(F.log(F.col("p") / (1 - F.col("p"))), 9).alias("log_odds")
        )
        for rounds in range(1, LEAF_ROUNDS + 1)
    ]
    return each[0].union(each[1]).union(each[2])


def halving_search(spark: SparkSession, folder: str) -> DataFrame:
    """Four trials of up to 8 trees: the trees they got, and the winner's recall counted again from its scores."""
    train, test, _ = _split(spark, folder)
    train, test = targets.encode_all(train, [test], TEXT, "churn_flag", "key")
    names = NUMERIC + [f"{c}_target" for c in TEXT]
    train = materialise(train.drop("is_test"), "encoded")
    best, trials = boost.halving_search(train, names, "churn_flag", "key", boost.sample_space(4, (8, 8)))
    held = model.stratified_split(train, "key", "churn_flag").where("is_test = 1")
    again = boost.recall(boost.score(best, held), "churn_flag")
    probable = boost.score(best, test).agg(F.every(_probable()).alias("ok")).scalar()
    return trials.agg(
        F.array_sort(F.collect_list("trees")).cast("string").alias("trees"),
        F.bool_or(F.col("winner") & (F.abs(F.col("recall") - again) < 1e-12)).alias("recall_agrees"),
        F.every(F.col("l2").between(3, 5)).alias("inside"),
    ).withColumn("probable", probable)


# A score that both engines can form, in which the two features act on each other.
SCORE = "1 / (1 + exp(-(0.4 * n_orders * (CASE WHEN balance > 0 THEN 1 ELSE 0 END) - balance / 5000)))"
GRID = (1, 2, 3, 5, 8)
EDGES = (0, 1, 2, 4, 20)


def _scored(df: DataFrame) -> DataFrame:
    return df.withColumn("p", F.expr(SCORE))


def partial_dependence(spark: SparkSession, folder: str) -> DataFrame:
    found = evaluate.partial_dependence(_scored, features(spark, folder), "n_orders", GRID)
    return found.select("feature", "value", rounded("avg_score", 9).alias("avg_score"), "n")


def accumulated_effects(spark: SparkSession, folder: str) -> DataFrame:
    found = evaluate.accumulated_effects(_scored, features(spark, folder), "n_orders", EDGES)
    return found.withColumn("effect", rounded("effect", 9))


def churn_features(spark: SparkSession, folder: str) -> DataFrame:
    return features(spark, folder).withColumn("spent", rounded("spent", 2))


def cycle_split(spark: SparkSession, folder: str) -> DataFrame:
    """Which rows train, and the features that a model would see of them."""
    current, others = model.split_cycles(features(spark, folder), "cycle", TRAIN_CYCLE)
    parts = current.withColumn("part", F.lit("train")).unionByName(others.withColumn("part", F.lit("backtest")))
    return model.select_features(parts, ["n_orders", "segment"], ["key", "part"])


QUERIES = {
    "cycle_split": cycle_split,
    "churn_features": churn_features,
    "ordered_stats": ordered_stats,
    "boosted_leaves": boosted_leaves,
    "halving_search": halving_search,
    "partial_dependence": partial_dependence,
    "accumulated_effects": accumulated_effects,
    "train_score": train_score,
    "saved_model_score": saved_model_score,
    "feature_importance": feature_importance,
    "top_features": top_features,
    "tuned_recall": tuned_recall,
    "cross_validated_auc": cross_validated_auc,
    "backtest": backtest,
    "permutation_importance": permutation_importance,
    "dependence": dependence,
}

CHURN_FEATURES = """
WITH per_year AS (
  SELECT o_custkey AS member_id, year(o_orderdate) AS cycle, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent,
         max(o_totalprice) AS biggest, CAST(max(dayofyear(o_orderdate)) AS INT) AS recency, max(o_orderpriority) AS priority
  FROM orders GROUP BY 1, 2)
SELECT CAST(p.member_id AS VARCHAR) || '/' || CAST(p.cycle AS VARCHAR) AS key, CAST(p.cycle AS INT) AS cycle,
       CASE WHEN n.member_id IS NULL THEN 1 ELSE 0 END AS churn_flag, p.n_orders, p.spent, p.biggest, p.recency,
       c_acctbal AS balance, c_mktsegment AS segment, p.priority, n_name AS nation
FROM per_year p LEFT JOIN per_year n ON n.member_id = p.member_id AND n.cycle = p.cycle + 1
JOIN customer ON c_custkey = p.member_id JOIN nation ON n_nationkey = c_nationkey
WHERE p.cycle < (SELECT max(cycle) FROM per_year)"""
CURRENT = f"""
WITH features AS ({CHURN_FEATURES}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY churn_flag ORDER BY md5(key)) AS rn, count(*) OVER (PARTITION BY churn_flag) AS per_class
  FROM features WHERE cycle = {TRAIN_CYCLE}),
test AS (SELECT * FROM ranked WHERE rn <= ceil(per_class * 0.2)),
train AS (SELECT * FROM ranked WHERE rn > ceil(per_class * 0.2))
"""


def _newton(rounds: int) -> str:
    """Log odds after so many Newton steps per leaf, as nested SQL over (busy, n, pos)."""
    if not rounds:
        return "SELECT 0 AS trees, busy, n, pos, 0.0::DOUBLE AS raw FROM leaf"
    return f"""SELECT {rounds} AS trees, busy, n, pos, raw + {LEAF_STEP} * (pos - n * p) / (n * p * (1 - p) + {LEAF_L2}) AS raw
FROM (SELECT *, 1 / (1 + exp(-raw)) AS p FROM ({_newton(rounds - 1)}) r{rounds}) s{rounds}"""


NAMES = ", ".join(f"('{f}')" for f in FEATURES)

ORACLE = {
    "cycle_split": f"""WITH features AS ({CHURN_FEATURES})
SELECT key, CASE WHEN cycle = {TRAIN_CYCLE} THEN 'train' ELSE 'backtest' END AS part, n_orders, segment FROM features""",
    "churn_features": CHURN_FEATURES,
    "ordered_stats": f"""WITH features AS ({CHURN_FEATURES}),
s AS (SELECT *, sum(churn_flag) OVER (PARTITION BY segment ORDER BY md5(key) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ss,
  count(*) OVER (PARTITION BY segment ORDER BY md5(key) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sn,
  sum(churn_flag) OVER (PARTITION BY nation ORDER BY md5(key) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ns,
  count(*) OVER (PARTITION BY nation ORDER BY md5(key) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nn FROM features)
SELECT key, round((coalesce(ss, 0) + 0.5::DOUBLE) / (sn + 1), 9) AS segment, round((coalesce(ns, 0) + 0.5::DOUBLE) / (nn + 1), 9) AS nation FROM s""",
    "boosted_leaves": f"""WITH features AS ({CHURN_FEATURES}),
leaf AS (SELECT CASE WHEN n_orders > 2 THEN 1 ELSE 0 END AS busy, count(*) AS n, sum(churn_flag) AS pos FROM features GROUP BY 1)
"""
    + " UNION ALL ".join(f"SELECT trees, busy, round(raw, 9) AS log_odds FROM ({_newton(r)}) t{r}" for r in range(1, LEAF_ROUNDS + 1)),
    "halving_search": "SELECT '[2, 2, 4, 8]' AS trees, TRUE AS recall_agrees, TRUE AS inside, TRUE AS probable",
    "partial_dependence": f"""WITH features AS ({CHURN_FEATURES})
SELECT 'n_orders' AS feature, CAST(value AS DOUBLE) AS value, round(avg({SCORE.replace('n_orders', 'value')}), 9) AS avg_score, count(*) AS n
FROM features, (SELECT unnest({list(GRID)}) AS value) g GROUP BY value""",
    "accumulated_effects": f"""WITH features AS ({CHURN_FEATURES}),
edges AS (SELECT unnest(range(0, {len(EDGES) - 1})) AS bin, unnest({list(EDGES[:-1])}) AS low, unnest({list(EDGES[1:])}) AS high),
steps AS (SELECT bin, low, high, count(*) AS n, avg({SCORE.replace('n_orders', 'high')} - {SCORE.replace('n_orders', 'low')}) AS step
  FROM features JOIN edges ON n_orders <= high AND (n_orders > low OR bin = 0 AND n_orders = low) GROUP BY 1, 2, 3),
sums AS (SELECT *, sum(step) OVER (ORDER BY bin) AS total FROM steps)
SELECT 'n_orders' AS feature, CAST(bin AS INT) AS bin, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high, n,
       round(total - (SELECT sum((total - step / 2) * n) / sum(n) FROM sums), 9) AS effect FROM sums""",
    "train_score": CURRENT + "SELECT key, churn_flag, TRUE AS consistent FROM test",
    "saved_model_score": CURRENT + "SELECT key, TRUE AS same FROM test",
    "feature_importance": f"SELECT *, 1.0::DOUBLE AS total FROM (VALUES {NAMES}) v(feature)",
    "top_features": CURRENT + f"SELECT key, {len(FEATURES)} AS n_features, TRUE AS probable FROM test",
    "tuned_recall": "SELECT 10 AS trials, 10 AS different, TRUE AS inside, TRUE AS probable",
    "cross_validated_auc": CURRENT
    + """SELECT CAST((r - 1) % 5 AS INT) AS fold, count(*) AS n, TRUE AS in_range
FROM (SELECT row_number() OVER (PARTITION BY churn_flag ORDER BY md5(key)) AS r FROM train) t GROUP BY 1""",
    "backtest": CURRENT
    + f"""SELECT cycle, count(*) AS n, CAST(sum(churn_flag) AS BIGINT) AS churned,
       CASE WHEN sum(churn_flag) BETWEEN 1 AND count(*) - 1 THEN TRUE END AS in_range FROM features WHERE cycle <> {TRAIN_CYCLE} GROUP BY cycle""",
    "permutation_importance": f"SELECT feature, TRUE AS as_known FROM (VALUES {NAMES}, ('constant')) v(feature)",
    "dependence": CURRENT
    + """, binned AS (
SELECT t.spent, len(list_filter(e.ed, lambda x: x < t.spent)) AS bin FROM test t,
  (SELECT list_distinct(list_filter(list(edge), lambda x: x > min(lowest))) AS ed FROM (
     SELECT v[1 + (i * (n - 1)) // 10] + (v[least(n, 2 + (i * (n - 1)) // 10)] - v[1 + (i * (n - 1)) // 10]) * (((i * (n - 1)) % 10) / 10.0::DOUBLE) AS edge, v[1] AS lowest
     FROM (SELECT list(spent ORDER BY spent) AS v, count(*) AS n FROM test) o, (SELECT unnest(range(1, 10)) AS i) k) d) e)
SELECT CAST(bin AS INT) AS bin, min(spent) AS low, max(spent) AS high, count(*) AS n, TRUE AS probable FROM binned GROUP BY bin""",
}
