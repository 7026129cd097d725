"""Weighted evaluation of scores. Every function takes ``by`` columns, so the scores of many models,
folds or permutations are evaluated together in one pass."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from forerate.functions.ordering import SLICE, exact_quantiles, running_sums


def _weight(weight: str | None) -> Column:
    return F.lit(1.0) if weight is None else F.col(weight)


def score_steps(
    df: DataFrame, by: list[str] | None = None, label: str = "label", score: str = "score", weight: str | None = "weight"
) -> DataFrame:
    """Weight of both labels per distinct score and above it: the steps of every ranking metric.

    Ties are merged before anything is ordered, so the ordered table has one row per distinct score.
    """
    by = by or []
    w = _weight(weight)
    steps = df.groupBy(*by, score).agg(
        F.sum(F.when(F.col(label) == 1, w).otherwise(0.0)).alias("pos"),
        F.sum(F.when(F.col(label) == 0, w).otherwise(0.0)).alias("neg"),
    )
    return running_sums(steps, by, [(score, False)], ["pos", "neg"])


def ranking_metrics(
    df: DataFrame, by: list[str] | None = None, label: str = "label", score: str = "score", weight: str | None = "weight"
) -> DataFrame:
    """Area under the ROC curve (a tie counts half) and average precision (step sum)."""
    pos, neg, above, wrong = (F.col(c) for c in ("pos", "neg", "pos_before", "neg_before"))
    reached = above + pos
    precision = F.try_divide(reached, reached + wrong + neg)
    return (
        score_steps(df, by, label, score, weight)
        .groupBy(*(by or []))
        .agg(
            F.try_divide(F.sum(neg * (above + pos / 2)), F.max("pos_total") * F.max("neg_total")).alias("roc_auc"),
            F.try_divide(F.sum(pos * precision), F.max("pos_total")).alias("average_precision"),
        )
    )


def roc_areas(
    df: DataFrame, by: list[str], cuts: list[float], label: str = "label", score: str = "score", weight: str | None = "weight"
) -> DataFrame:
    """Area under the ROC curve alone, of many groups that are large, too.

    Scores are cut into slices at ``cuts``. A slice is ordered on its own, and what lies above it is added
    to its area, so nothing is staged or put in order as a whole.
    """
    w = _weight(weight)
    if cuts:
        ends = [-float("inf"), *sorted(set(cuts)), float("inf")]
        df = Bucketizer(splits=ends, inputCol=score, outputCol=SLICE, handleInvalid="keep").transform(df)
    else:
        df = df.withColumn(SLICE, F.lit(0.0))
    steps = df.groupBy(*by, SLICE, score).agg(
        F.sum(F.when(F.col(label) == 1, w).otherwise(0.0)).alias("pos"),
        F.sum(F.when(F.col(label) == 0, w).otherwise(0.0)).alias("neg"),
    )
    above = W.partitionBy(*by, SLICE).orderBy(F.desc(score)).rowsBetween(W.unboundedPreceding, -1)
    area = F.col("neg") * (F.coalesce(F.sum("pos").over(above), F.lit(0.0)) + F.col("pos") / 2)
    slices = steps.withColumn("area", area).groupBy(*by, SLICE).agg(*[F.sum(c).alias(c) for c in ("area", "pos", "neg")])
    higher = W.partitionBy(*by).orderBy(F.desc(SLICE)).rowsBetween(W.unboundedPreceding, -1)
    added = F.col("area") + F.col("neg") * F.coalesce(F.sum("pos").over(higher), F.lit(0.0))
    whole = slices.withColumn("area", added).groupBy(*by)
    return whole.agg(F.try_divide(F.sum("area"), F.sum("pos") * F.sum("neg")).alias("roc_auc"))


def curve_points(
    df: DataFrame, by: list[str] | None = None, label: str = "label", score: str = "score", weight: str | None = "weight"
) -> DataFrame:
    """Points of the ROC and precision-recall curves, one per distinct score, with the prevalence."""
    reached = F.col("pos_before") + F.col("pos")
    wrong = F.col("neg_before") + F.col("neg")
    return score_steps(df, by, label, score, weight).select(
        *(by or []),
        F.col(score).alias("threshold"),
        F.try_divide(wrong, F.col("neg_total")).alias("false_positive_rate"),
        F.try_divide(reached, F.col("pos_total")).alias("recall"),
        F.try_divide(reached, reached + wrong).alias("precision"),
        F.try_divide(F.col("pos_total"), F.col("pos_total") + F.col("neg_total")).alias("prevalence"),
    )


def _ratio(part: Column, whole: Column) -> Column:
    """Share that is 0 when there is nothing to share."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _class_measures(w: Column, y: Column, guess: Column, value: int) -> dict[str, Column]:
    hit = F.sum(F.when((y == value) & (guess == value), w).otherwise(0.0))
    named = F.sum(F.when(guess == value, w).otherwise(0.0))
    there = F.sum(F.when(y == value, w).otherwise(0.0))
    return {"precision": _ratio(hit, named), "recall": _ratio(hit, there), "f1": _ratio(2 * hit, named + there)}


def class_metrics(
    df: DataFrame, guess: Column, by: list[str] | None = None, label: str = "label", weight: str | None = "weight"
) -> DataFrame:
    """Accuracy and, for each of the two labels, precision, recall and F1 of a 0/1 ``guess``."""
    w, y = _weight(weight), F.col(label)
    measures = [_ratio(F.sum(F.when(y == guess, w).otherwise(0.0)), F.sum(w)).alias("accuracy")]
    for value in (1, 0):
        for name, m in _class_measures(w, y, guess, value).items():
            measures.append(m.alias(f"{name}_{value}"))
    return df.groupBy(*(by or [])).agg(*measures)


def brier_score(
    df: DataFrame, by: list[str] | None = None, label: str = "label", score: str = "score", weight: str | None = "weight"
) -> DataFrame:
    w, miss = _weight(weight), F.col(score) - F.col(label)
    return df.groupBy(*(by or [])).agg(_ratio(F.sum(w * miss * miss), F.sum(w)).alias("brier"))


def guess_at(threshold: float | Column, score: str = "score") -> Column:
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return (F.col(score) >= limit).cast("int")


def recall_by_threshold(
    df: DataFrame,
    target_recall: float = 0.7,
    grid: range = range(30, 86),
    label: str = "label",
    score: str = "score",
    weight: str | None = "weight",
) -> DataFrame:
    """Weighted recall of label 0 for each threshold (in hundredths), and which one is chosen.

    The chosen one is the smallest that reaches the target. All thresholds are evaluated in a single
    pass, as one conditional sum each.
    """
    w = _weight(weight)
    zero = F.col(label) == 0
    sums = df.agg(
        F.sum(F.when(zero, w).otherwise(0.0)).alias("all"),
        *[
            F.sum(F.when(zero & (F.col(score) < F.lit(t / 100)), w).otherwise(0.0)).alias(f"t{t}")
            for t in grid
        ],
    )
    cells = [
        F.struct(F.lit(t / 100).alias("threshold"), _ratio(F.col(f"t{t}"), F.col("all")).alias("recall_0"))
        for t in grid
    ]
    curve = sums.select(F.array(*cells).alias("curve"))
    enough = F.filter("curve", lambda c: c["recall_0"] >= target_recall)
    first = F.array_min(F.transform(enough, lambda c: c["threshold"]))
    table = curve.select(first.alias("first"), F.inline("curve"))
    return table.select(
        "threshold", "recall_0", F.coalesce(F.col("threshold") == F.col("first"), F.lit(False)).alias("chosen")
    )


def choose_threshold(df: DataFrame, target_recall: float = 0.7, fallback: float = 0.5, **columns: str) -> float:
    """The chosen threshold of ``recall_by_threshold``, or the fallback when none reaches the target."""
    row = recall_by_threshold(df, target_recall, **columns).where("chosen").first()
    return row["threshold"] if row else fallback


def confusion_matrix(
    df: DataFrame, guess: Column, label: str = "label", weight: str | None = None
) -> DataFrame:
    """Rows (or weight) per pair of true and predicted label, with the share of the total.

    Unweighted by default: it counts individuals. All four cells are listed, empty ones with 0.
    """
    w = F.lit(1) if weight is None else F.col(weight)
    pairs = [(y, p) for y in (0, 1) for p in (0, 1)]
    sums = df.agg(
        F.sum(w).alias("all"),
        *[
            F.sum(F.when((F.col(label) == y) & (guess == p), w).otherwise(0)).alias(f"c{y}{p}")
            for y, p in pairs
        ],
    )
    cells = [
        F.struct(
            F.lit(y).alias("label"),
            F.lit(p).alias("predicted"),
            F.col(f"c{y}{p}").alias("rows"),
            F.try_divide(F.col(f"c{y}{p}"), F.col("all")).alias("share"),
        )
        for y, p in pairs
    ]
    return sums.select(F.inline(F.array(*cells)))


def calibration(
    df: DataFrame, bins: int = 10, label: str = "label", score: str = "score", weight: str | None = None
) -> DataFrame:
    """Mean score against observed rate in quantile bins; unweighted by default.

    A score equal to an inner edge belongs to the lower bin, and empty bins are left out.
    """
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    edges = exact_quantiles(df, [], score, probs).first()
    place = sum(((F.col(score) > F.lit(edges[q])).cast("int") for q in probs), F.lit(0))
    w = _weight(weight)
    return (
        df.groupBy(place.alias("bin"))
        .agg(
            F.try_divide(F.sum(w * F.col(score)), F.sum(w)).alias("mean_score"),
            F.try_divide(F.sum(w * F.col(label)), F.sum(w)).alias("observed_rate"),
            F.count("*").alias("rows"),
        )
    )
