"""Grouped validation, curves, search, out-of-fold scores and explanations."""

import itertools
import math

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forerate.contracts import feature_columns
from forerate.operators import explain, models


@pytest.fixture(scope="module")
def boosted(signal_base):
    return models.fit_pipeline(signal_base, models.boosting(rounds=4, leaves=8, min_leaf=10))


def test_comparison_ranks_a_learner_above_the_prior(signal_base):
    every = models.candidates(rounds=3, trees=5)
    chosen = {m: every[m] for m in ("baseline", "decision_tree", "naive_bayes", "linear_svm")}
    table = models.compare(signal_base, k=3, models=chosen).collect()
    by_name = {r["model"]: r for r in table}
    assert set(by_name) == set(chosen)
    assert by_name["baseline"]["roc_auc"] == 0.5 and by_name["baseline"]["train_gap"] == 0
    assert by_name["decision_tree"]["roc_auc"] > 0.7 and by_name["linear_svm"]["roc_auc"] > 0.7
    assert [r["roc_auc"] for r in table] == sorted((r["roc_auc"] for r in table), reverse=True)
    share = signal_base.agg(F.avg("label")).first()[0]
    if share > 0.5:
        assert by_name["baseline"]["f1"] == pytest.approx(2 * share / (1 + share), abs=0.02)


def test_every_family_can_be_built():
    data = models.Training(20_000, 19_000.0)
    built = {name: build(data) for name, build in models.candidates().items()}
    assert len(built) == 7
    gbt = built["gradient_boosting"]
    assert gbt.getOrDefault("leaves") == 31 and gbt.getOrDefault("rounds") == 100 and gbt.getOrDefault("l2") == 0.0
    for rows in (9, 20_000):  # early stopping is asked for, not switched on by size
        watching, whole = (models.boosting(early_stopping=e)(models.Training(rows, 1.0)) for e in (True, False))
        assert watching.getOrDefault("watch") == models.EARLY_STOP_MARK and whole.getOrDefault("watch") == ""
    assert built["linear_svm"].getOrDefault("loss") == "squared_hinge" and built["linear_svm"].getOrDefault("cost") == 0.1


def test_the_search_space_has_every_combination():
    sizes = [len(v) for v in models.SEARCH_SPACE.values()]
    assert np.prod(sizes) == 540 and models.SEARCH_SPACE["l2"] == [0.0, 0.1, 1.0]


def test_out_of_fold_scores_cover_all_rows_and_never_see_the_group(signal_base):
    scored = models.out_of_fold(signal_base, models.boosting(rounds=2, leaves=4), k=3)
    assert scored.count() == signal_base.count() == scored.select("unit_id").distinct().count()
    assert scored.groupBy("group_id").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    # a label that is a pure function of the group cannot be learned from other groups' ids
    assert "group_id" not in feature_columns(signal_base).categorical


def test_learning_curve_grows_in_nested_parts(signal_base):
    curve = models.learning_curve(signal_base, 300, steps=3, build=models.boosting(rounds=2, leaves=4)).collect()
    rows = [r["train_rows"] for r in curve]
    assert len(rows) == 3 and rows == sorted(rows) and rows[0] == pytest.approx(rows[2] / 10, abs=1)
    assert all(0 <= r["validation_auc"] <= 1 and r["gap"] == pytest.approx(r["train_auc"] - r["validation_auc"], abs=1e-4) for r in curve)


def test_search_and_validation_curve(signal_base):
    space = {"rate": [0.1, 0.2], "rounds": [2, 3], "leaves": [4], "min_leaf": [20]}
    table = models.random_search(signal_base, n_iter=3, k=2, space=space).collect()
    assert len(table) == 3 and len({(r["rate"], r["rounds"]) for r in table}) == 3
    assert table[0]["roc_auc"] == max(r["roc_auc"] for r in table)
    curve = models.validation_curve(signal_base, 100, k=2, leaves=(4, 8), rounds=2).collect()
    assert [r["max_leaves"] for r in curve] == [4, 8]


def test_ablation_needs_the_columns(signal_base):
    assert models.ablation(signal_base, None) is None
    left = signal_base.sparkSession.createDataFrame([("m", 0.7), ("n", 0.6)], "model string, roc_auc double")
    right = signal_base.sparkSession.createDataFrame([("m", 0.65), ("x", 0.6)], "model string, roc_auc double")
    assert [tuple(r) for r in models.ablation_table(left, right).collect()] == [("m", 0.7, 0.65, 0.05)]


def test_last_step_and_best_row(spark):
    curve = spark.createDataFrame([(300, 0.7), (100, 0.5), (200, 0.7)], "train_rows int, validation_auc double")
    step = models.last_step(curve).first()
    assert (step["rows_before"], step["rows_after"]) == (200, 300)
    assert step["growth_pct"] == pytest.approx(50) and step["gain"] == 0
    assert models.best_row(curve, "validation_auc", "train_rows").first()["train_rows"] == 200


def test_saved_model_scores_the_same(signal_base, boosted, tmp_path):
    boosted.write().overwrite().save(f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m")
    rows = [{r["unit_id"]: r["score"] for r in models.score_rows(m, signal_base).collect()} for m in (boosted, again)]
    assert rows[0] == rows[1] and len(rows[0]) == signal_base.count()


def margin(scored):
    return {r["unit_id"]: math.log(r["p"][1] / r["p"][0]) for r in scored.select("unit_id", vector_to_array("probability").alias("p")).collect()}


def test_contributions_add_up_to_the_log_odds(signal_base, boosted):
    table, expected = explain.contributions(boosted, signal_base)
    want = margin(boosted.transform(signal_base))
    rows = table.collect()
    assert len(rows) == signal_base.count()
    for r in rows:
        assert expected + sum(r["contributions"]) == pytest.approx(want[r["unit_id"]], abs=1e-6)


def test_one_path_against_the_definition():
    """Shapley values from all orders in which the features of a path can become known."""
    leaf = {"value": 3.0, "path": {4: (-np.inf, 1.0, 0.25), 2: (0.0, 5.0, 0.5), 7: (2.0, np.inf, 0.8)}}
    game = explain.leaf_game(leaf)
    share = [0.25, 0.5, 0.8]

    def worth(known, holds):
        return 3.0 * math.prod(holds[i] if i in known else share[i] for i in range(3))

    for code in range(8):
        holds = [(code >> i) & 1 for i in range(3)]
        want = np.zeros(3)
        for order in itertools.permutations(range(3)):
            for at, j in enumerate(order):
                want[j] += (worth(order[: at + 1], holds) - worth(order[:at], holds)) / 6
        np.testing.assert_allclose(explain.shapley(game, np.array([holds], dtype=float))[0], want, atol=1e-12)
    assert game["base"] == pytest.approx(3.0 * 0.25 * 0.5 * 0.8) and game["features"] == [4, 2, 7]


def test_both_explanations_find_the_driving_column(signal_base, boosted):
    perm = explain.permutation_importance(boosted, signal_base, n=None, repeats=2)
    shap = explain.mean_abs_contribution(boosted, signal_base, n=None)
    got = {r["column_name"]: r["importance"] for r in perm.collect()}
    found = feature_columns(signal_base)
    assert set(got) == {*found.numeric, *found.categorical}
    agree = explain.top_agreement(perm, shap, "importance", "mean_abs_contribution").first()
    assert agree["agree"] and agree["first_leader"] == "group_rate_prior_year"
    used = set(shap.where("mean_abs_contribution > 0").toPandas()["column_name"])
    for c in found.numeric:
        if c not in used and f"missingindicator_{c}" not in used:
            assert got[c] == 0


def test_contribution_rows_have_names_and_values(signal_base, boosted):
    rows = explain.contribution_rows(boosted, signal_base, ["group_rate_prior_year"])
    assert rows.columns == ["unit_id", "column_name", "value", "contribution"]
    assert rows.count() == signal_base.count() and rows.select("column_name").distinct().count() == 1


def test_gaussian_parameters_match_the_library_model(signal_base):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import VectorAssembler

    columns = ["group_mean_prior_year", "region_target"]
    ready = VectorAssembler(inputCols=columns, outputCol="features").transform(signal_base)
    model = NaiveBayes(modelType="gaussian", weightCol="weight").fit(ready)
    rows = models.gaussian_parameters(signal_base, columns).collect()
    got = {(r["label"], r["column_name"]): r for r in rows}
    for label in (0, 1):
        for j, c in enumerate(columns):
            assert got[label, c]["mean"] == pytest.approx(model.theta.toArray()[label, j])
            assert got[label, c]["variance"] == pytest.approx(model.sigma.toArray()[label, j], rel=1e-3)


def test_no_row_is_lost_without_a_group(odd_base):
    scored = models.out_of_fold(odd_base, models.candidates()["baseline"], k=3)
    assert scored.count() == odd_base.count() and scored.where("score IS NULL").count() == 0


def test_bounded_training_keeps_validation_whole(signal_base):
    folded = models.fold_members(signal_base, 3)
    cut = models.bounded_training(folded, 100)
    assert cut.count() == signal_base.count()
    sizes = {r["fit"]: r["n"] for r in cut.select(F.explode("fits").alias("fit")).groupBy("fit").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 100, 1: 100, 2: 100}
    assert models.bounded_training(folded, 10**6).selectExpr("sum(size(fits))").first()[0] == 2 * signal_base.count()


def test_forest_keeps_the_nodes_of_rows_and_grows_the_same_trees(spark, signal_base):
    forest = models.candidates(trees=3)["random_forest"](models.Training(520, 1.0))
    assert forest.getCacheNodeIds()
    rows = models.TabularPrep(numericCols=["group_rate_prior_year", "region_rate_prior_year"], categoricalCols=["form"]).fit(signal_base)
    rows = rows.transform(signal_base).select("features", F.col("label").cast("double").alias("label"), "weight").cache()
    kept, walked = (f.fit(rows).toDebugString.split("\n", 1)[1] for f in (forest, forest.copy({forest.cacheNodeIds: False})))
    assert kept == walked
    rows.unpersist()


def test_rows_that_are_read_again_take_no_heap_and_tasks_stay_small(spark, signal_base, monkeypatch):
    """Fits side by side must not fill the executors' heaps with stored rows, however many rows there are."""
    assert models.spread(spark.range(10), 3_000_000).rdd.getNumPartitions() >= 30
    levels, plain = [], {kind: kind.persist for kind in (RDD, DataFrame)}
    for kind, keep in plain.items():
        monkeypatch.setattr(kind, "persist", lambda self, level=None, keep=keep: levels.append(level) or keep(self, level))
    models.out_of_fold(signal_base, models.boosting(rounds=2, leaves=4), k=2)
    models.validation_curve(signal_base, k=2, leaves=(4, 8), rounds=2)
    models.fit_pipeline(signal_base, models.boosting(rounds=2, leaves=4))
    assert len(levels) > 8 and not any(level.useMemory for level in levels)
