"""Classifier evaluation from a label column (0/1) and a score column, as distributed aggregates.

Rows are first counted per distinct score; curves and statistics then run over distinct scores with bucketed
running totals, so ties are exact and no task sorts the whole table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from engage.operators.ranking import ACCURACY, null_safe, one_row, quantile_values, running_totals
from engage.session import materialise


def _score_counts(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), bits: int | None = None
) -> DataFrame:
    """Positives and negatives per distinct score, with inclusive running totals from the top and group totals."""
    by = list(by)
    per_score = df.groupBy(*by, F.col(score).cast("double").alias("threshold")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).alias("neg"),
    )
    # written once: the passes below read distinct scores, not the rows again
    per_score = materialise(per_score, "scores")
    return running_totals(per_score, "threshold", {"pos": "tp", "neg": "fp"}, by, descending=True, bits=bits)


def _with_sizes(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Attach each group's positives and negatives."""
    sizes = points.groupBy(*by).agg(F.sum("pos").alias("p_total"), F.sum("neg").alias("n_total"))
    if by:
        return null_safe(points, sizes, list(by))
    found = one_row(sizes)
    return points.withColumns({"p_total": found["p_total"], "n_total": found["n_total"]})


def roc_points(df: DataFrame, label: str = "y", score: str = "p", bits: int | None = None) -> DataFrame:
    """Per distinct score as threshold: true and false positives at or above it, and their rates.

    The first point of the curve, above every score, has a NULL threshold.
    """
    points = _with_sizes(_score_counts(df, label, score, bits=bits)).select(
        "threshold",
        "tp",
        "fp",
        F.try_divide("fp", "n_total").alias("fpr"),
        F.try_divide("tp", "p_total").alias("tpr"),
    )
    origin = df.sparkSession.range(1).selectExpr(
        "cast(null as double) threshold", "0L tp", "0L fp", "0d fpr", "0d tpr"
    )
    return points.unionByName(origin)


def pr_points(df: DataFrame, label: str = "y", score: str = "p", bits: int | None = None) -> DataFrame:
    """Precision, recall and F1 per distinct score as threshold; the end point has a NULL threshold."""
    # Fixed value: keeps the F1 denominator off zero.
    tiny = 1e-8
    points = _with_sizes(_score_counts(df, label, score, bits=bits)).select(
        "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "p_total").alias("recall"),
    )
    end = df.sparkSession.range(1).selectExpr("cast(null as double) threshold", "1d precision", "0d recall")
    return points.unionByName(end).withColumn(
        "f1", 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + tiny)
    )


def auc(
    df: DataFrame, label: str = "y", score: str = "p", by: Sequence[str] = (), bits: int | None = None
) -> DataFrame:
    """Area under the ROC curve; tied scores count half."""
    points = _score_counts(df, label, score, by, bits)
    wins = F.sum(F.col("neg").cast("double") * (F.col("tp") - F.col("pos") + F.col("pos") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return points.groupBy(*by).agg(F.try_divide(wins, pairs).alias("auc"))


def ks(df: DataFrame, label: str = "y", score: str = "p", bits: int | None = None) -> DataFrame:
    """Largest gap between the score distributions of the two classes."""
    points = _with_sizes(_score_counts(df, label, score, bits=bits))
    gap = F.abs(F.try_divide("tp", "p_total") - F.try_divide("fp", "n_total"))
    return points.agg(F.max(gap).alias("ks"))


def confusion(df: DataFrame, threshold: float = 0.5, label: str = "y", score: str = "p") -> DataFrame:
    """Rows per (actual, predicted), predicted 1 at or above the threshold; all four cells, zeros included."""
    cells = []
    for actual in (0, 1):
        for predicted in (0, 1):
            here = (F.col(label) == actual) & ((F.col(score) >= threshold).cast("int") == predicted)
            cells.append(
                F.struct(
                    F.lit(actual).alias("actual"), F.lit(predicted).alias("predicted"), F.count_if(here).alias("n")
                )
            )
    return df.agg(F.array(*cells).alias("c")).select(F.inline("c"))


def report(df: DataFrame, threshold: float = 0.5, label: str = "y", score: str = "p") -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, and the macro and weighted averages."""
    hit = F.col(score) >= threshold
    one = F.col(label) == 1
    counts = df.agg(
        F.count_if(one & hit).alias("tp"),
        F.count_if(~one & hit).alias("fp"),
        F.count_if(one & ~hit).alias("fn"),
        F.count_if(~one & ~hit).alias("tn"),
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.cast("double").alias("precision"),
            recall.cast("double").alias("recall"),
            f1.cast("double").alias("f1"),
            support.cast("long").alias("support"),
        )

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    scored = counts.withColumns(
        {
            "p1": ratio(tp, tp + fp),
            "r1": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
            "p0": ratio(tn, tn + fn),
            "r0": ratio(tn, tn + fp),
            "f0": ratio(2 * tn, 2 * tn + fp + fn),
            "s1": tp + fn,
            "s0": tn + fp,
            "n": tp + fp + fn + tn,
        }
    )
    c = F.col
    accuracy = ratio(c("tp") + c("tn"), c("n"))

    def macro(m: str) -> Column:
        return (c(f"{m}0") + c(f"{m}1")) / 2

    def weighted(m: str) -> Column:
        return ratio(c(f"{m}0") * c("s0") + c(f"{m}1") * c("s1"), c("n"))

    rows = F.array(
        row("0", c("p0"), c("r0"), c("f0"), c("s0")),
        row("1", c("p1"), c("r1"), c("f1"), c("s1")),
        row("accuracy", accuracy, accuracy, accuracy, c("n")),
        row("macro avg", macro("p"), macro("r"), macro("f"), c("n")),
        row("weighted avg", weighted("p"), weighted("r"), weighted("f"), c("n")),
    )
    return scored.select(F.inline(rows))


def deciles(df: DataFrame, score: str = "p", bins: int = 10, name: str = "decile", accuracy: int = ACCURACY) -> DataFrame:
    """Bin rows by quantile edges of the score, right-closed, from 0; repeated edges merge their bins.

    Edges and scores are compared as they are, so a score equal to an edge lies below it.  A NULL or NaN score has no bin.
    """
    found = quantile_values(df, [score], [i / bins for i in range(bins)], "linear", accuracy)[score]
    # the minimum, and an edge equal to it, makes no bin of its own
    lowest, *edges = [e for e in found.values() if e is not None] or [0.0]
    inner = F.array(*[F.lit(e) for e in sorted(set(edges) - {lowest})]).cast("array<double>")
    value = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    return df.withColumn(name, F.when(value.isNotNull(), F.size(F.filter(inner, lambda e: e < value))))


def lift_table(
    df: DataFrame, label: str = "y", score: str = "p", bins: int = 10, accuracy: int = ACCURACY
) -> DataFrame:
    """Per decile, lowest scores first: size, events, mean score, event rate, running events and their share.

    Rows without a score are in no decile and not counted.
    """
    binned = deciles(df, score, bins, "decile", accuracy).where("decile is not null")
    per_bin = binned.groupBy("decile").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum(F.col(label).cast("long")).alias("events"),
        F.avg(score).alias("avg_prob"),
    )
    # at most ``bins`` rows reach this window
    upto = (
        Window.partitionBy(F.lit(0)).orderBy("decile").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = Window.partitionBy(F.lit(0))
    return (
        per_bin.withColumn("event_rate", F.col("events") / F.col("count"))
        .withColumn("cumulative_events", F.sum("events").over(upto))
        .withColumn(
            "cumulative_event_rate",
            F.try_divide(F.col("cumulative_events"), F.max("cumulative_events").over(whole)),
        )
    )


def permutation_scores(
    scored_by_feature: DataFrame, baseline: DataFrame, label: str = "y", score: str = "p"
) -> DataFrame:
    """Drop in AUC per feature: rows (feature, importance) from rows scored with that feature permuted."""
    base = auc(baseline, label, score).select("auc").scalar()
    return auc(scored_by_feature, label, score, ["feature"]).select("feature", (base - F.col("auc")).alias("importance"))


def dependence(
    scored: DataFrame, feature: str, score: str = "p", bins: int = 10, accuracy: int = ACCURACY
) -> DataFrame:
    """Mean score of the rows in each quantile bin of a numeric feature.

    Features that go with this one show in it; ``partial_dependence`` and ``accumulated_effects`` ask the model instead.
    """
    binned = deciles(scored, feature, bins, "bin", accuracy).where("bin is not null")
    return binned.groupBy("bin").agg(
        F.lit(feature).alias("feature"),
        F.min(F.col(feature).cast("double")).alias("low"),
        F.max(F.col(feature).cast("double")).alias("high"),
        F.avg(score).alias("avg_score"),
        F.count(F.lit(1)).alias("n"),
    )


Scorer = Callable[[DataFrame], DataFrame]


def _mean(value: Column, weight: str | None) -> Column:
    if weight is None:
        return F.avg(value)
    return F.try_divide(F.sum(value * F.col(weight)), F.sum(F.when(value.isNotNull(), F.col(weight))))


def partial_dependence(
    scorer: Scorer, df: DataFrame, feature: str, grid: Sequence[float], score: str = "p", weight: str | None = None
) -> DataFrame:
    """The mean score if every row had each value of ``grid``: rows (feature, value, avg_score, n).

    ``scorer`` adds the score to a frame, as ``model.score`` or ``boost.score`` do.  Every row is scored once per grid value and
    means are combined before they are shuffled; a grid is a few dozen values.  ``weight`` weighs the rows.
    """
    kind = df.schema[feature].dataType
    points = F.explode(F.array(*[F.lit(float(v)) for v in grid]))
    each = df.withColumn("_value", points).withColumn(feature, F.col("_value").cast(kind))
    found = scorer(each).groupBy(F.col("_value").alias("value")).agg(
        _mean(F.col(score), weight).alias("avg_score"), F.count(F.lit(1)).alias("n")
    )
    return found.select(F.lit(feature).alias("feature"), "value", "avg_score", "n")


def accumulated_effects(
    scorer: Scorer, df: DataFrame, feature: str, edges: Sequence[float], score: str = "p", weight: str | None = None
) -> DataFrame:
    """Accumulated local effects: rows (feature, bin, low, high, n, effect).

    A row counts in the bin (low, high] that holds its own value, and is scored at both ends of it; the mean differences, summed from the
    first bin on, are the effect at ``high``, less its mean over all rows (taken at the middle of bins).  So a feature that goes with this
    one never meets values it does not go with.  Rows outside the edges or without a value count nowhere.
    """
    edges = sorted(float(e) for e in edges)
    bins = list(zip(edges, edges[1:], strict=False))
    kind = df.schema[feature].dataType
    value = F.col(feature).cast("double")
    # bins are few; the first one holds its lower edge
    at = F.coalesce(
        *[F.when((value >= a if i == 0 else value > a) & (value <= b), F.lit(i)) for i, (a, b) in enumerate(bins)]
    )
    ends = F.element_at(F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in bins]), F.col("_bin") + 1)
    rows = df.withColumn("_bin", at).where("_bin is not null").select("*", F.posexplode(ends).alias("_end", "_value"))
    scored = scorer(rows.withColumn(feature, F.col("_value").cast(kind)))
    signed = F.col(score) * (2 * F.col("_end") - 1)
    share = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    found = scored.groupBy(F.col("_bin").alias("bin")).agg(
        (2 * _mean(signed, weight)).alias("_step"), F.count_if(F.col("_end") == 1).alias("n"), (F.sum(share) / 2).alias("_w")
    )
    # one row per bin reaches these windows
    order = Window.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = found.withColumn("_sum", F.sum("_step").over(order))
    middle = (F.col("_sum") - F.col("_step") / 2) * F.col("_w")
    whole = Window.partitionBy(F.lit(0))
    effect = F.col("_sum") - F.sum(middle).over(whole) / F.sum("_w").over(whole)
    table = F.array(*[F.struct(F.lit(a).alias("low"), F.lit(b).alias("high")) for a, b in bins])
    return sums.select(
        F.lit(feature).alias("feature"), "bin", F.element_at(table, F.col("bin") + 1)["low"].alias("low"),
        F.element_at(table, F.col("bin") + 1)["high"].alias("high"), "n", effect.alias("effect"),
    )
