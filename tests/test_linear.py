"""Newton solvers, naive Bayes and fold sums against other solvers and plain sums."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from forerate.contracts import feature_columns
from forerate.functions import sums
from forerate.operators import bayes, explain, linear, models, prep


@pytest.fixture(scope="module")
def ready(odd_base, signal_base):
    """Prepared rows of the signal base."""
    columns = feature_columns(signal_base)
    spec = prep.fit_specs(signal_base, columns.numeric, columns.categorical)[prep.ALL]
    rows = prep.with_features(signal_base, spec).select("unit_id", F.col("label").cast("double").alias("label"), F.col("weight").cast("double").alias("weight"), "features")
    return rows.repartition(3).cache()


def arrays(ready):
    rows = ready.select(vector_to_array("features").alias("x"), "label", "weight").collect()
    return np.array([r["x"] for r in rows]), np.array([r["label"] for r in rows]), np.array([r["weight"] for r in rows])


def test_logistic_coefficients_are_the_solver_s(ready):
    weight = ready.agg(F.sum("weight")).first()[0]
    want = LogisticRegression(weightCol="weight", regParam=1 / weight, standardization=False, maxIter=1000, tol=1e-14).fit(ready)
    got = linear.NewtonLinear().fit(ready)
    assert got.weights() == pytest.approx(list(want.coefficients), abs=1e-6)
    assert got.getOrDefault("intercept") == pytest.approx(want.intercept, abs=1e-6)
    assert got.getOrDefault("passes") <= 12
    both = [m.transform(ready).select("unit_id", vector_to_array("probability")[1]) for m in (want, got)]
    assert [dict(b.collect()) for b in both][1] == pytest.approx(dict(both[0].collect()), abs=1e-6)


def test_squared_hinge_is_at_its_minimum(ready):
    x, label, weight = arrays(ready)
    wide, sign = np.concatenate([x, np.ones((len(x), 1))], axis=1), 2 * label - 1
    model = linear.NewtonLinear(loss="squared_hinge", cost=0.1).fit(ready)
    point = np.array([*model.weights(), model.getOrDefault("intercept")])

    def loss(at):
        return at @ at / 2 + 0.1 * (weight * np.maximum(0, 1 - sign * (wide @ at)) ** 2).sum()

    slope = point - 0.2 * wide.T @ (weight * sign * np.maximum(0, 1 - sign * (wide @ point)))
    assert np.abs(slope).max() < 1e-7
    rng = np.random.default_rng(3)
    assert all(loss(point) <= loss(point + 1e-3 * rng.normal(size=len(point))) for _ in range(20))
    assert linear.slope_left(model, ready) < 1e-9
    assert linear.slope_left(linear.NewtonLinear().fit(ready), ready) < 1e-9
    scored = models.score_of(model.transform(ready))
    assert model.transform(ready).agg(F.min(scored) < F.max(scored)).first()[0] and "probability" not in model.transform(ready).columns


def test_weights_count_as_repeated_rows(ready):
    twice = ready.withColumn("weight", F.lit(2.0))
    repeated = ready.withColumn("weight", F.lit(1.0)).union(ready.withColumn("weight", F.lit(1.0)))
    for loss in linear.LOSSES:
        a, b = (linear.NewtonLinear(loss=loss).fit(d) for d in (twice, repeated))
        assert a.weights() == pytest.approx(b.weights(), abs=1e-9)


def test_labels_of_one_kind_and_no_rows(ready):
    for estimator in (linear.NewtonLinear(), linear.NewtonLinear(loss="squared_hinge"), bayes.GaussianBayes()):
        same = estimator.fit(ready.withColumn("label", F.lit(1.0)))
        assert same.transform(ready).agg(F.min("prediction")).first()[0] == 1.0
        none = estimator.fit(ready.limit(0))
        assert none.transform(ready.limit(0)).count() == 0


def test_linear_contributions_add_up(signal_base, tmp_path):
    for name in ("logistic_regression", "linear_svm"):
        model = models.fit_pipeline(signal_base, models.candidates()[name])
        model.write().overwrite().save(f"{tmp_path}/{name}")
        again = PipelineModel.load(f"{tmp_path}/{name}")
        few = signal_base.where("network = 'town'")
        for background in (None, signal_base):
            table, expected = explain.contributions(again, few, background=background)
            total = F.aggregate("contributions", F.lit(expected), lambda a, v: a + v)
            want = model.transform(few).select("unit_id", vector_to_array("rawPrediction")[1].alias("want"))
            gap = table.select("unit_id", total.alias("t")).join(want, "unit_id").agg(F.max(F.abs(F.col("t") - F.col("want")))).first()[0]
            assert gap < 1e-9
        mean = explain.mean_abs_contribution(model, few).collect()
        assert mean[0]["column_name"] == "group_rate_prior_year"
    with pytest.raises(TypeError):
        explain.contributions(models.fit_pipeline(signal_base, models.candidates()["naive_bayes"]), signal_base)


def test_naive_bayes_is_that_of_plain_sums(ready):
    x, label, weight = arrays(ready)
    model = bayes.GaussianBayes().fit(ready)
    pooled = np.average(x**2, axis=0, weights=weight) - np.average(x, axis=0, weights=weight) ** 2
    logs = []
    for y in (0, 1):
        w = weight * (label == y)
        mean = np.average(x, axis=0, weights=w)
        variance = np.average((x - mean) ** 2, axis=0, weights=w) + 1e-9 * pooled.max()
        logs.append(np.log(w.sum()) - (np.log(variance) + (x - mean) ** 2 / variance).sum(axis=1) / 2)
    want = logs[1] - logs[0]
    got = [r[0] for r in model.transform(ready).select(vector_to_array("rawPrediction")[1]).collect()]
    assert got == pytest.approx(want.tolist(), rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("scaler", ["standard", "robust"])
def test_totals_less_a_fold_are_what_a_fit_learns(odd_base, scaler):
    """Naive Bayes and prior by subtraction, against fits on the prepared rows of the other folds."""
    folded = models.fold_members(odd_base, 3)
    columns = feature_columns(odd_base)
    specs = prep.fit_specs(folded, columns.numeric, columns.categorical, scaler, fits="fits")
    known = bayes.FoldSums(folded, specs, columns.numeric, columns.categorical)
    for fold in range(3):
        rows = prep.with_features(folded.where(F.col("fold") != fold), specs[fold])
        want, got = bayes.GaussianBayes().fit(rows.select("features", "label", "weight")), known.bayes(fold, specs[fold])
        for name in ("mean0", "mean1", "variance0", "variance1"):
            assert got.getOrDefault(name) == pytest.approx(want.getOrDefault(name), rel=1e-7, abs=1e-7), name
        assert got.getOrDefault("odds") == pytest.approx(want.getOrDefault("odds"))
        assert known.prior(fold).getOrDefault("share") == pytest.approx(bayes.ClassPrior().fit(rows).getOrDefault("share"))


def test_sums_are_added_up_on_the_way(spark, monkeypatch):
    monkeypatch.setattr(sums, "FAN_IN", 2)
    df = spark.range(1000).selectExpr("array(double(id), 1d) x", "double(id % 3) y").repartition(7)
    from pyspark.ml.functions import array_to_vector

    blocks = sums.packed(df.withColumn("features", array_to_vector("x")), ["y"]).cache()
    got = sums.summed_arrays(blocks, lambda found: ((int(k), x[y[:, 0] == k].sum(axis=0)) for x, y in found for k in range(3)), 7)
    assert {k: v.tolist() for k, v in got.items()} == {k: [float(sum(range(k, 1000, 3))), float(len(range(k, 1000, 3)))] for k in range(3)}
    blocks.unpersist()
