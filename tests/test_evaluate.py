"""Order statistics and evaluation against plain Python."""

import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from engage.operators import evaluate, model, ranking
from engage.plans import evaluation


def scored(spark, n=3000, seed=1, digits=2, skew=1):
    rng = random.Random(seed)
    rows = [(i, int(rng.random() < 0.3), round(rng.random() ** skew, digits)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, y int, p double").repartition(5)


@pytest.mark.parametrize("digits, skew", [(1, 1), (2, 8), (9, 1)])
def test_auc_and_ks_equal_brute_force(spark, digits, skew):
    rows, df = scored(spark, digits=digits, skew=skew)
    pos = np.array([p for _, y, p in rows if y])
    neg = np.array([p for _, y, p in rows if not y])
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    ks = max(abs((pos <= t).mean() - (neg <= t).mean()) for t in {p for _, _, p in rows})
    assert evaluate.auc(df).first()[0] == pytest.approx(auc, abs=1e-12)
    assert evaluate.ks(df).first()[0] == pytest.approx(ks, abs=1e-12)


def test_auc_ignores_monotone_maps_and_splits_by_group(spark):
    _, df = scored(spark)
    whole = evaluate.auc(df).first()[0]
    assert evaluate.auc(df.withColumn("p", F.exp("p") * 5)).first()[0] == pytest.approx(whole)
    two = df.withColumn("g", F.lit("a")).unionByName(df.withColumn("g", F.lit("b")).withColumn("p", 1 - F.col("p")))
    got = {r["g"]: r["auc"] for r in evaluate.auc(two, by=["g"]).collect()}
    assert got["a"] == pytest.approx(whole) and got["b"] == pytest.approx(1 - whole)


def test_auc_of_one_class_is_null(spark):
    assert evaluate.auc(spark.createDataFrame([(1, 0.5), (1, 0.2)], "y int, p double")).first()[0] is None


@pytest.mark.parametrize("bits", [None, 0, 1, 3, 8])
def test_running_totals(spark, bits):
    rng = random.Random(4)
    values = {round(rng.gauss(0, 1), 3): rng.randint(1, 9) for _ in range(500)}
    df = spark.createDataFrame(list(values.items()), "v double, n long").repartition(7)
    got = {r["v"]: r["t"] for r in ranking.running_totals(df, "v", {"n": "t"}, bits=bits).collect()}
    total = 0
    for v in sorted(values):
        total += values[v]
        assert got[v] == total


@pytest.mark.parametrize("n", [1, 11, 30000])
@pytest.mark.parametrize("shape", ["even", "ties", "heavy"])
def test_quantiles_equal_sorting(spark, n, shape):
    rng = random.Random(n)
    draw = {"even": rng.random, "ties": lambda: float(rng.randint(0, 3)), "heavy": lambda: rng.paretovariate(0.3)}[shape]
    values = [draw() for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (math.nan,)], "x double").repartition(4)
    probs = [0.0, 0.01, 0.25, 0.3, 0.5, 0.95, 1.0]
    ordered = sorted(values)
    assert ranking.quantile_values(df, ["x"], probs)["x"] == {p: ordered[max(math.ceil(round(p * n, 9)), 1) - 1] for p in probs}
    linear = ranking.quantile_values(df, ["x"], probs, "linear")["x"]
    for p in probs:
        assert linear[p] == pytest.approx(np.quantile(values, p), rel=1e-9)


def test_many_rows_are_cut_into_buckets(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ROWS_PER_BUCKET", 5)
    rng = random.Random(3)
    values = [rng.gauss(0, 1) for _ in range(20000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    assert ranking.quantile_values(df, ["x"], [0.5], accuracy=1000)["x"][0.5] == sorted(values)[9999]
    rows, scores = scored(spark, n=400, digits=3)
    assert evaluate.auc(scores).first()[0] == pytest.approx(evaluate.auc(scores, bits=0).first()[0])


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, z double")
    assert ranking.quantile_values(df, ["x", "z"], [0.5]) == {"x": {0.5: None}, "z": {0.5: 1.0}}
    assert ranking.quantile_values(df, ["x"], [0.5]) == {"x": {0.5: None}}


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_lift_table_equals_qcut(spark, digits):
    rows, df = scored(spark, n=2000, digits=digits, skew=3)
    frame = pd.DataFrame(rows, columns=["id", "y", "p"])
    frame["decile"] = pd.qcut(frame["p"], 10, labels=False, duplicates="drop")
    want = frame.groupby("decile").agg(count=("y", "count"), events=("y", "sum"), avg_prob=("p", "mean")).reset_index()
    got = evaluate.lift_table(df).orderBy("decile").toPandas()
    assert got["decile"].tolist() == want["decile"].tolist()
    assert got["count"].tolist() == want["count"].tolist() and got["events"].tolist() == want["events"].tolist()
    assert got["avg_prob"].to_numpy() == pytest.approx(want["avg_prob"].to_numpy())
    assert got["cumulative_event_rate"].iloc[-1] == 1.0


def test_deciles_of_a_constant_score(spark):
    df = spark.range(20).selectExpr("0.5d p", "cast(id % 2 as int) y")
    assert evaluate.lift_table(df).select("decile", "count", "events").collect() == [(0, 20, 10)]


def test_roc_and_pr_points(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)], "y int, p double")
    roc = {r["threshold"]: (r["tp"], r["fp"], r["fpr"], r["tpr"]) for r in evaluate.roc_points(df).collect()}
    assert roc == {None: (0, 0, 0.0, 0.0), 0.9: (1, 0, 0.0, 0.5), 0.8: (2, 1, 0.5, 1.0), 0.1: (2, 2, 1.0, 1.0)}
    pr = {r["threshold"]: (r["precision"], r["recall"]) for r in evaluate.pr_points(df).collect()}
    assert pr == {None: (1.0, 0.0), 0.9: (1.0, 0.5), 0.8: (pytest.approx(2 / 3), 1.0), 0.1: (0.5, 1.0)}


def test_confusion_shows_empty_cells_and_report_divides_by_zero_safely(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.49)], "y int, p double")
    assert {tuple(r) for r in evaluate.confusion(df).collect()} == {(0, 0, 0), (0, 1, 0), (1, 0, 1), (1, 1, 1)}
    rows = {r["class"]: r for r in evaluate.report(df).collect()}
    assert rows["0"]["f1"] == 0.0 and rows["1"]["recall"] == 0.5 and rows["accuracy"]["f1"] == 0.5


def test_split_and_folds_are_stratified(spark):
    _, df = scored(spark, n=1003)
    sizes = {r["y"]: r["n"] for r in model.class_weights(df, "y").collect()}
    split = model.stratified_split(df, "id", "y").groupBy("y").agg(F.sum("is_test")).collect()
    assert {y: t for y, t in split} == {y: math.ceil(n / 5) for y, n in sizes.items()}
    fold = model.folds(df, "id", "y").groupBy("y", "fold").count().collect()
    for y, n in sizes.items():
        counts = [c for label, _, c in fold if label == y]
        assert sum(counts) == n and max(counts) - min(counts) <= 1


def test_hash_rank_is_a_permutation_of_the_order(spark):
    df = spark.range(5000).selectExpr("id", "id % 3 = 0 g")
    got = ranking.hash_rank(df, "id", ["g"]).select("g", "id", "rank", "total").toPandas()
    import hashlib

    for _, part in got.groupby("g"):
        order = sorted(part["id"], key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
        want = {i: r for r, i in enumerate(order, 1)}
        assert part["rank"].tolist() == [want[i] for i in part["id"]]
        assert set(part["total"]) == {len(part)}


def test_risk_tier_borders(spark):
    df = spark.createDataFrame([(0.8,), (0.81,), (0.5,), (0.51,)], "p double")
    assert [r[1] for r in model.risk_tier(df).collect()] == ["Medium Risk", "High Risk", "Low Risk", "Medium Risk"]


@pytest.mark.parametrize("divisor", [3, 7])
def test_lift_of_tied_scores_equals_qcut(spark, divisor):
    p = [None if i % 13 == 0 else ((i * 31) % 22) / divisor / 10 for i in range(1001)]
    df = spark.createDataFrame([(i, i % 2, v) for i, v in enumerate(p)], "id int, y int, p double")
    frame = pd.DataFrame({"y": [i % 2 for i in range(1001)], "p": p}).dropna()
    frame["decile"] = pd.qcut(frame["p"], 10, labels=False, duplicates="drop")
    want = frame.groupby("decile").agg(n=("y", "count"), events=("y", "sum"))
    got = evaluate.lift_table(df).orderBy("decile").toPandas()
    assert got["count"].tolist() == want["n"].tolist() and got["events"].tolist() == want["events"].tolist()
    assert evaluate.deciles(df).where("decile is null").count() == sum(v is None for v in p)


@pytest.mark.parametrize("bits", [0, 3])
def test_null_groups_stay_at_any_size(spark, bits):
    df = spark.range(900).selectExpr("case when id % 3 = 0 then null else id % 3 end g", "cast(id % 2 as int) y", "id / 900.0d p")
    assert evaluate.auc(df, by=["g"], bits=bits).count() == 3
    totals = ranking.running_totals(df.selectExpr("g", "p", "1 n"), "p", {"n": "upto"}, ["g"], bits=bits)
    assert totals.count() == 900 and {r[0] for r in totals.groupBy("g").agg(F.max("upto")).select("max(upto)").collect()} == {300}


def test_null_keys_and_labels_are_ranked_and_split(spark):
    df = spark.range(900).selectExpr("case when id % 9 <> 0 then id end k", "case when id % 3 = 0 then null else cast(id % 2 as int) end y")
    for digits in (1, 4):
        assert ranking.hash_rank(df, "k", ["y"], digits=digits).count() == 900
    assert model.folds(df, "k", "y").count() == 900
    assert model.stratified_split(df, "k", "y").where("is_test is null").count() == 0


def test_a_missed_bracket_is_widened(spark):
    df = spark.range(0, 30000, 1, 5).selectExpr("cast(id as double) x")
    found = ranking.quantile_values(df, ["x"], [0.25, 0.5], slack=1e-9, accuracy=100)
    assert found == {"x": {0.25: 7499.0, 0.5: 14999.0}}


def test_rates_that_end_in_a_five_are_rounded_as_sql_does(spark, tmp_path):
    # 804 of 12,800 rows without churn lie above the lower score: 0.0628125, whose scaled double is just below the half
    rows = spark.range(12_802).selectExpr(
        "id as c_custkey", "if(id < 804, 7890.0d, if(id < 12800, -1000.0d, 9000.0d)) as c_acctbal"
    )
    rows.withColumn("c_custkey", F.col("c_custkey") * 10).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    got = sorted(evaluation.roc_points(spark, str(tmp_path)).select("fp", "fpr").collect())
    con = duckdb.connect()
    con.execute(f"create view customer as select * from '{tmp_path}/customer.parquet/*.parquet'")
    wanted = con.execute(f"select fp, fpr from ({evaluation.ORACLE['roc_points']})").fetchall()
    assert got == sorted(wanted)
