"""Weighted metrics against brute force over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from forerate.functions import ordering
from forerate.operators import metrics


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(5)
    rows = [
        (i, "a" if i % 3 else "b", int(rng.integers(2)), float(rng.integers(1, 12)) / 12, float(rng.integers(0, 4)))
        for i in range(240)
    ]
    return spark.createDataFrame(rows, "unit_id int, part string, label int, score double, weight double").cache()


def auc(y, s, w):
    pairs = [(w[i] * w[j], s[i], s[j]) for i in range(len(y)) for j in range(len(y)) if y[i] == 1 and y[j] == 0]
    return sum(v * (a > b) + v / 2 * (a == b) for v, a, b in pairs) / sum(v for v, _, _ in pairs)


def average_precision(y, s, w):
    total, last, area = (w * y).sum(), 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        above = s >= t
        recall = (w * y)[above].sum() / total
        area += (recall - last) * (w * y)[above].sum() / w[above].sum() if w[above].sum() else 0
        last = recall
    return area


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_ranking_metrics(scores, monkeypatch, limit):
    monkeypatch.setattr(ordering, "MAX_IN_TASK", limit)
    pdf = scores.toPandas()
    got = {r["part"]: r for r in metrics.ranking_metrics(scores, ["part"]).collect()}
    for part, g in pdf.groupby("part"):
        y, s, w = (g[c].to_numpy() for c in ("label", "score", "weight"))
        assert got[part]["roc_auc"] == pytest.approx(auc(y, s, w))
        assert got[part]["average_precision"] == pytest.approx(average_precision(y, s, w))
    plain = metrics.ranking_metrics(scores, weight=None).first()["roc_auc"]
    assert plain == pytest.approx(auc(pdf["label"], pdf["score"], np.ones(len(pdf))))


def test_all_scores_tied_is_chance_and_one_class_is_undefined(scores):
    tied = metrics.ranking_metrics(scores.withColumn("score", F.lit(0.3))).first()
    assert tied["roc_auc"] == pytest.approx(0.5)
    assert metrics.ranking_metrics(scores.where("label = 1")).first()["roc_auc"] is None


def test_curves_end_at_one(scores):
    points = metrics.curve_points(scores).orderBy("threshold").collect()
    assert points[0]["recall"] == pytest.approx(1) and points[0]["false_positive_rate"] == pytest.approx(1)
    assert len(points) == scores.select("score").distinct().count()
    assert points[0]["precision"] == pytest.approx(points[0]["prevalence"])


def test_class_metrics_and_brier(scores):
    pdf = scores.toPandas()
    y, w, p = pdf["label"], pdf["weight"], (pdf["score"] >= 0.5).astype(int)
    got = metrics.class_metrics(scores, metrics.guess_at(0.5)).first()
    assert got["accuracy"] == pytest.approx((w * (y == p)).sum() / w.sum())
    for c in (0, 1):
        precision = w[(y == c) & (p == c)].sum() / w[p == c].sum()
        recall = w[(y == c) & (p == c)].sum() / w[y == c].sum()
        assert got[f"precision_{c}"] == pytest.approx(precision)
        assert got[f"recall_{c}"] == pytest.approx(recall)
        assert got[f"f1_{c}"] == pytest.approx(2 * precision * recall / (precision + recall))
    brier = metrics.brier_score(scores).first()["brier"]
    assert brier == pytest.approx((w * (pdf["score"] - y) ** 2).sum() / w.sum())


def test_nothing_predicted_gives_zero_not_an_error(scores):
    got = metrics.class_metrics(scores, metrics.guess_at(2.0)).first()
    assert got["precision_1"] == 0 and got["f1_1"] == 0 and got["recall_0"] == 1
    weightless = metrics.class_metrics(scores.withColumn("weight", F.lit(0.0)), metrics.guess_at(0.5)).first()
    assert weightless["accuracy"] == 0


def test_threshold_is_the_smallest_that_reaches_the_recall(scores):
    pdf = scores.toPandas()
    zero = pdf[pdf["label"] == 0]
    for target in (0.3, 0.7):
        want = next(t / 100 for t in range(30, 86) if zero.loc[zero["score"] < t / 100, "weight"].sum() / zero["weight"].sum() >= target)
        assert metrics.choose_threshold(scores, target) == want
    assert metrics.choose_threshold(scores, 1.1) == 0.5


def test_confusion_counts_individuals_unless_told_otherwise(scores):
    pdf = scores.toPandas()
    got = {(r["label"], r["predicted"]): r for r in metrics.confusion_matrix(scores, metrics.guess_at(0.5)).collect()}
    assert len(got) == 4
    for (y, p), r in got.items():
        cell = pdf[(pdf["label"] == y) & ((pdf["score"] >= 0.5) == bool(p))]
        assert r["rows"] == len(cell) and r["share"] == pytest.approx(len(cell) / len(pdf))
    weighted = metrics.confusion_matrix(scores, metrics.guess_at(0.5), weight="weight")
    assert weighted.agg(F.sum("rows")).first()[0] == pdf["weight"].sum()


def test_calibration_bins(scores):
    pdf = scores.toPandas()
    edges = np.quantile(pdf["score"], np.arange(1, 10) / 10)
    pdf["bin"] = np.searchsorted(edges, pdf["score"])
    want = pdf.groupby("bin").agg(mean_score=("score", "mean"), observed_rate=("label", "mean"), rows=("label", "size"))
    got = metrics.calibration(scores).toPandas().set_index("bin").sort_index()
    assert list(got.index) == list(want.index)
    np.testing.assert_allclose(got[want.columns], want)


def test_areas_by_slices_are_those_of_the_whole_order(spark):
    """Ties, slices that stay empty, a group without a positive label and cuts that are scores."""
    draw = random.Random(3)
    rows = [(g, draw.randrange(40) / 40, float(g < 2 and draw.random() < 0.4), float(draw.randrange(1, 4))) for g in range(3) for _ in range(300)]
    df = spark.createDataFrame(rows, "g int, score double, label double, weight double")
    want = {r["g"]: r["roc_auc"] for r in metrics.ranking_metrics(df, ["g"]).collect()}
    for cuts in ([], [0.5], [0.1, 0.25, 0.25, 0.6, 0.99, 3.0]):
        got = {r["g"]: r["roc_auc"] for r in metrics.roc_areas(df, ["g"], cuts).collect()}
        assert got.keys() == want.keys() and got[2] is None and want[2] is None
        assert all(abs(got[g] - want[g]) < 1e-12 for g in (0, 1))
