"""Churn classifier on MLlib: splits, weights, training, tuning, validation, tiers."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, TrainValidationSplit
from pyspark.sql import DataFrame, functions as F, types as T

from engage.operators.prep import column_types
from engage.operators.ranking import hash_cut, hash_rank, hashed_key, null_safe
from engage.operators.skew import fits
from engage.session import materialise

# Fill for missing numbers at training time, and the tier borders.
TRAIN_FILL = -999
HIGH_RISK, MEDIUM_RISK = 0.8, 0.5

# Buckets of a hashed text feature.
BUCKETS = 32


def _per_class(df: DataFrame, table: DataFrame, label: str) -> DataFrame:
    """Add a table's columns by class, NULL being a class; one row per class, so the rows stay where they are."""
    return null_safe(df, table, [label], broadcast=fits(table))


def split_cycles(df: DataFrame, cycle: str, train: object) -> tuple[DataFrame, DataFrame]:
    """Rows of the training cycle, and rows of the others."""
    return df.where(F.col(cycle) == train), df.where(F.col(cycle) != train)


def select_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, *[f for f in features if f not in keep])


def stratified_split(df: DataFrame, key: str, label: str, test_share: float = 0.2) -> DataFrame:
    """Add ``is_test``: per class the first ``ceil(share * n)`` rows by md5 of the key.

    Only the border hash per class is computed; rows are then compared to it where they are.
    """
    cuts = hash_cut(df, key, test_share, [label]).withColumnRenamed("cut", "_cut")
    with_cut = _per_class(df, cuts, label)
    return with_cut.select(*df.columns, (hashed_key(key) <= F.col("_cut")).cast("int").alias("is_test"))


def folds(df: DataFrame, key: str, label: str, k: int = 5) -> DataFrame:
    """Add ``fold``: rows of each class dealt to k folds in md5 order of the key."""
    ranked = hash_rank(df, key, [label], "_rank", "_total")
    return ranked.select(*df.columns, ((F.col("_rank") - 1) % k).cast("int").alias("fold"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows (label, n, weight): all rows over twice the class's rows, so both classes weigh the same."""
    n = df.agg(F.count(F.lit(1))).scalar()
    per_class = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return per_class.withColumn("weight", n / (2 * F.col("n")))


def with_class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    weights = class_weights(df, label).select(label, F.col("weight").alias("_class_weight"))
    return _per_class(df, weights, label).withColumnRenamed("_class_weight", name)


def _stages(df: DataFrame, features: Sequence[str], hashed: Sequence[str], buckets: int) -> tuple[list, list[str]]:
    numeric, text = column_types(df.select(*features))
    flags = [f.name for f in df.schema.fields if f.name in features and isinstance(f.dataType, T.BooleanType)]
    unknown = [f for f in features if f not in (*numeric, *text, *flags)]
    if unknown:
        raise ValueError(f"features of unsupported type: {', '.join(unknown)}")
    columns = [
        f"coalesce(nanvl(cast(`{c}` as double), null), {float(TRAIN_FILL)}) as `_num_{c}`" for c in (*numeric, *flags) if c not in text
    ]
    columns += [f"cast(pmod(xxhash64(`{c}`), {buckets}) as double) as `_num_{c}`" for c in text if c in hashed]
    indexed = [c for c in text if c not in hashed]
    stages = [SQLTransformer(statement=f"select *, {', '.join(columns) or '1 as _one'} from __THIS__")]
    if indexed:
        stages.append(
            StringIndexer(inputCols=indexed, outputCols=[f"_ix_{c}" for c in indexed], handleInvalid="keep")
        )
    inputs = [f"_ix_{c}" if c in indexed else f"_num_{c}" for c in features]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="_features"))
    return stages, inputs


def pipeline(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    weight: str | None = None,
    hashed: Sequence[str] = (),
    buckets: int = BUCKETS,
    seed: int = 42,
    **params: object,
) -> Pipeline:
    """Fill, index, assemble, boost.  ``params`` go to the boosted trees (maxDepth, maxIter, stepSize, maxBins).

    Text features named in ``hashed`` go to that many buckets, the others are indexed by their values; ``maxBins`` must
    hold the most values of an indexed one.  Which is which is the caller's choice and does not follow the data.
    """
    stages, _ = _stages(df, features, hashed, buckets)
    learner = GBTClassifier(labelCol=label, featuresCol="_features", seed=seed, **params)
    if weight:
        learner = learner.setWeightCol(weight)
    return Pipeline(stages=[*stages, learner])


def train(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    weighted: bool = True,
    validate_by: str | None = None,
    validate_share: float = 0.2,
    **params: object,
) -> PipelineModel:
    """Fit the pipeline.  With ``validate_by``, a key, a share of each class is kept for validation, and boosting stops
    where it improves no more there (``validationTol``)."""
    rows = with_class_weights(df, label, "_weight") if weighted else df
    if validate_by:
        split = stratified_split(rows.drop("is_test"), validate_by, label, validate_share)
        # every round reads these rows again
        rows = materialise(split.withColumn("_validation", F.col("is_test") == 1).drop("is_test"), "fit")
        params = {"validationIndicatorCol": "_validation", **params}
    return pipeline(rows, features, label, "_weight" if weighted else None, **params).fit(rows)


def best_params(trials: DataFrame) -> dict[str, object]:
    """The learner's parameters of the trial with the best recall."""
    best = trials.orderBy(F.desc("recall"), "trial").first()
    return {
        "maxDepth": int(best["max_depth"]),
        "stepSize": best["step_size"],
        "maxIter": int(best["max_iter"]),
        "maxBins": int(best["max_bins"]),
    }


def score(model: PipelineModel, df: DataFrame, name: str = "p") -> DataFrame:
    """Add the probability of class 1."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability").getItem(1).alias(name))


def importance(model: PipelineModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows (feature, importance); as many as there are features."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    return df.sparkSession.createDataFrame(list(zip(features, values)), "feature string, importance double")


def top_features(ranking: DataFrame, n: int = 30) -> DataFrame:
    return ranking.orderBy(F.desc("importance"), F.asc("feature")).limit(n)


class RecallAt(Evaluator):
    """Recall of class 1 at a probability above the threshold."""

    def __init__(self, label: str, threshold: float = 0.5):
        super().__init__()
        self.label, self.threshold = label, threshold

    def _evaluate(self, dataset: DataFrame) -> float:
        hit = vector_to_array("probability").getItem(1) > self.threshold
        one = F.col(self.label) == 1
        found, total = dataset.agg(F.count_if(one & hit), F.count_if(one)).first()
        return found / total if total else 0.0

    def isLargerBetter(self) -> bool:
        return True


def sample_grid(learner: GBTClassifier, trials: int, rounds: tuple[int, int], seed: int = 42) -> list[dict]:
    """Random parameter sets from the search space: depth 4-6, log-uniform step 1e-3 to 1e-1, 32 or 64 bins."""
    rng = random.Random(seed)
    return [
        {
            learner.maxDepth: rng.randint(4, 6),
            learner.stepSize: math.exp(rng.uniform(math.log(1e-3), math.log(1e-1))),
            learner.maxIter: rng.randint(*rounds),
            learner.maxBins: rng.choice((32, 64)),
        }
        for _ in range(trials)
    ]


def tune(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    trials: int = 10,
    rounds: tuple[int, int] = (500, 1000),
    parallelism: int = 4,
    seed: int = 42,
) -> tuple[PipelineModel, DataFrame]:
    """Best model by recall on a validation share of the training rows, and one row per trial.

    The test rows stay out of the search.
    """
    flow = pipeline(df, features, label, seed=seed)
    learner = flow.getStages()[-1]
    grid = sample_grid(learner, trials, rounds, seed)
    search = TrainValidationSplit(
        estimator=flow,
        estimatorParamMaps=grid,
        evaluator=RecallAt(label),
        trainRatio=0.8,
        parallelism=parallelism,
        seed=seed,
    ).fit(df)
    rows = [
        (i, *[float(g[p]) for p in (learner.maxDepth, learner.stepSize, learner.maxIter, learner.maxBins)], float(m))
        for i, (g, m) in enumerate(zip(grid, search.validationMetrics))
    ]
    table = df.sparkSession.createDataFrame(
        rows, "trial int, max_depth double, step_size double, max_iter double, max_bins double, recall double"
    )
    return search.bestModel, table


def cross_validate(
    df: DataFrame, features: Sequence[str], label: str, key: str, k: int = 5, parallelism: int = 2, **params: object
) -> float:
    """Mean AUC over k stratified folds."""
    # every fold's fit reads these rows again
    rows = materialise(folds(df, key, label, k), "folds")
    validator = CrossValidator(
        estimator=pipeline(rows, features, label, **params),
        estimatorParamMaps=[{}],
        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC"),
        numFolds=k,
        foldCol="fold",
        parallelism=parallelism,
    )
    return float(validator.fit(rows).avgMetrics[0])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def backtest(model: PipelineModel, df: DataFrame, cycle: str, trained_on: object) -> DataFrame:
    """Scores for every cycle the model was not trained on."""
    return score(model, split_cycles(df, cycle, trained_on)[1])


def risk_tier(df: DataFrame, score: str = "p", name: str = "risk_category") -> DataFrame:
    return df.withColumn(
        name,
        F.when(F.col(score) > HIGH_RISK, "High Risk")
        .when(F.col(score) > MEDIUM_RISK, "Medium Risk")
        .otherwise("Low Risk"),
    )


def tier_counts(df: DataFrame, name: str = "risk_category") -> DataFrame:
    return df.groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(name))


def permuted_scores(
    model: PipelineModel, df: DataFrame, features: Sequence[str], key: str, keep: Sequence[str], seed: int = 42
) -> DataFrame:
    """Rows scored once per feature with that feature's values shuffled: (keep..., feature, p).

    Two hash orders of the rows pair every row with a donor, one join for all features.
    """
    receivers = hash_rank(df, key, rank="_r", total="_n").drop("_n")
    reseeded = df.withColumn("_k2", F.concat(F.col(key).cast("string"), F.lit(f"/{seed}")))
    donors = hash_rank(reseeded, "_k2", rank="_r", total="_n").select(
        "_r", *[F.col(f).alias(f"_d_{f}") for f in features]
    )
    each = receivers.join(donors, "_r").withColumn("feature", F.explode(F.array(*[F.lit(f) for f in features])))
    swapped = each.withColumns(
        {f: F.when(F.col("feature") == f, F.col(f"_d_{f}")).otherwise(F.col(f)) for f in features}
    )
    return score(model, swapped.select(*df.columns, "feature")).select(*keep, "feature", "p")
