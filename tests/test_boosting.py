"""Leaf-wise boosting against plain trees grown row by row, its bins, stopping and explanation."""

import heapq
from types import SimpleNamespace

import numpy as np
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from forerate.functions import ordering
from forerate.operators import boosting, explain, metrics, models, prep
from forerate.sources import staging


def plain_boosting(x, label, weight, rounds, rate, leaves, min_leaf, l2):
    """Every split looked for on the rows themselves, best leaf first."""
    p = (weight * label).sum() / weight.sum()
    score = np.full(len(x), np.log(p / (1 - p)))
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-score))
        g, h = weight * (q - label), weight * q * (1 - q)
        worth = lambda r: g[r].sum() ** 2 / (h[r].sum() + l2 + 1e-15)

        def best(rows):
            found = (0.0, None)
            for j in range(x.shape[1]):
                for cut in np.unique(x[rows, j])[:-1]:
                    a, b = rows[x[rows, j] <= cut], rows[x[rows, j] > cut]
                    if min(len(a), len(b)) >= min_leaf and min(h[a].sum(), h[b].sum()) >= boosting.LEAST_CURVE:
                        gain = worth(a) + worth(b) - worth(rows)
                        if gain > found[0] + 1e-9:
                            found = (gain, (a, b))
            return found

        heap, done, number = [], [], 0
        first = np.arange(len(x))
        gain, parts = best(first)
        if parts is None:
            break
        heapq.heappush(heap, (-gain, number, first, parts))
        while heap and len(heap) + len(done) < leaves:
            _, _, rows, parts = heapq.heappop(heap)
            for part in parts:
                number += 1
                gain, more = best(part)
                if more is None:
                    done.append(part)
                else:
                    heapq.heappush(heap, (-gain, number, part, more))
        for rows in [*done, *(r for _, _, r, _ in heap)]:
            score[rows] -= rate * g[rows].sum() / (h[rows].sum() + l2 + 1e-15)
    return score


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    n = 500
    x = np.stack([rng.integers(0, 40, n), rng.integers(0, 9, n), rng.normal(size=n).round(1), np.zeros(n), rng.integers(0, 2, n)], axis=1).astype(float)
    chance = 1 / (1 + np.exp(-(x[:, 0] / 10 - 2 + x[:, 2] * x[:, 4])))
    label, weight = (rng.random(n) < chance).astype(float), rng.integers(1, 5, n) / 2
    data = [(i, x[i].tolist(), float(label[i]), float(weight[i]), bool(i % 10 == 0)) for i in range(n)]
    df = spark.createDataFrame(data, "unit_id int, x array<double>, label double, weight double, watched boolean")
    from pyspark.ml.functions import array_to_vector

    return x, label, weight, df.withColumn("features", array_to_vector("x")).drop("x").repartition(3).cache()


def margins(model, df):
    return dict(model.transform(df).select("unit_id", vector_to_array("rawPrediction")[1]).collect())


@pytest.mark.parametrize(("leaves", "min_leaf", "l2"), [(2, 20, 0.0), (6, 10, 1.0), (31, 5, 0.1)])
def test_trees_are_those_of_plain_growth(rows, leaves, min_leaf, l2):
    x, label, weight, df = rows
    model = boosting.LeafwiseBoosting(rounds=4, rate=0.3, leaves=leaves, minLeaf=min_leaf, l2=l2).fit(df)
    want = plain_boosting(x, label, weight, 4, 0.3, leaves, min_leaf, l2)
    got = margins(model, df)
    assert [got[i] for i in range(len(want))] == pytest.approx(want.tolist(), abs=1e-9)
    assert all((t.left < 0).sum() <= leaves and t.count[t.left < 0].min() >= min_leaf for t in model.trees())


def test_models_learned_together_are_what_they_are_alone(rows):
    df = rows[-1]
    some = [
        boosting.LeafwiseBoosting(rounds=14, rate=0.2, leaves=3, minLeaf=5, watch="watched"),
        boosting.LeafwiseBoosting(rounds=3, rate=0.1, leaves=12, l2=1.0, watch="watched"),
        boosting.LeafwiseBoosting(rounds=25, rate=0.4, leaves=6, minLeaf=15, watch="watched"),
    ]
    together = boosting.fit_together(some, df)
    for alone, model in zip((e.fit(df) for e in some), together):
        assert len(alone.trees()) == len(model.trees())
        assert margins(alone, df) == pytest.approx(margins(model, df), abs=1e-9)
    with pytest.raises(ValueError):
        boosting.fit_together([some[0], boosting.LeafwiseBoosting()], df)


def test_a_penalty_shrinks_leaves(rows):
    df = rows[-1]
    free, held = (boosting.LeafwiseBoosting(rounds=1, leaves=4, l2=p).fit(df).trees()[0] for p in (0.0, 50.0))
    assert np.abs(held.value).max() < np.abs(free.value).max()


def test_watched_rows_stop_learning_and_are_not_learned_from(rows):
    df = rows[-1]
    model = boosting.LeafwiseBoosting(rounds=60, rate=0.5, leaves=20, minLeaf=2, watch="watched").fit(df)
    assert 0 < len(model.trees()) < 60
    assert model.trees()[0].count[0] == df.where("NOT watched").count()
    every = boosting.LeafwiseBoosting(rounds=13, rate=0.1, leaves=3).fit(df)
    assert len(every.trees()) == 13  # more than are kept apart


def test_a_tree_takes_about_as_many_passes_as_it_is_deep(rows, monkeypatch):
    """And one array per model and kind reaches the driver, however many tasks there are."""
    asked, plain = [], boosting.summed_arrays

    def counted(*args):
        asked.append(args)
        return plain(*args)

    monkeypatch.setattr(boosting, "summed_arrays", counted)
    tree = boosting.LeafwiseBoosting(rounds=1, rate=0.3, leaves=40, minLeaf=2).fit(rows[-1]).trees()[0]
    depth = {0: 0}
    for node in range(len(tree.left)):
        if tree.left[node] >= 0:
            depth[tree.left[node]] = depth[tree.right[node]] = depth[node] + 1
    assert max(depth.values()) >= 5
    assert len(asked) <= 1 + 1 + max(depth.values()) + 1  # weights, the root, its levels, and splits that weren't taken


def test_lost_scores_come_from_all_trees_again(rows, monkeypatch):
    learner = boosting.LeafwiseBoosting(rounds=3, rate=0.3, leaves=5, minLeaf=10)
    want = [t.plain() for t in learner.fit(rows[-1]).trees()]
    asked, plain = [], boosting.summed_arrays

    def lost(*args):
        asked.append(args)
        if len(asked) == 8:
            raise Py4JJavaError("a checkpointed block is gone", SimpleNamespace(_target_id="o0", _gateway_client=None))
        return plain(*args)

    monkeypatch.setattr(boosting, "summed_arrays", lost)
    assert [t.plain() for t in learner.fit(rows[-1]).trees()] == want and len(asked) > 8


def test_bins_of_many_values_are_quantiles(spark):
    df = spark.range(20_000).selectExpr("array(double(id), double(id % 7), 1d) x", "double(id % 2) label", "1d weight")
    from pyspark.ml.functions import array_to_vector

    blocks = boosting.packed(df.withColumn("features", array_to_vector("x")).repartition(4), ["label", "weight"])
    first, second, third = boosting.bin_cuts(blocks)
    assert len(first) == 254 and np.abs(np.diff(first) - 20_000 / 255).max() < 60
    assert second.tolist() == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5] and len(third) == 0


def test_labels_of_one_kind_and_no_rows(spark, rows):
    df = rows[-1]
    same = boosting.LeafwiseBoosting(rounds=3).fit(df.withColumn("label", F.lit(1.0)))
    assert min(margins(same, df).values()) > 10
    empty = boosting.LeafwiseBoosting(rounds=3).fit(df.limit(0))
    assert set(margins(empty, df).values()) == {0.0}


def test_every_tree_model_is_explained(signal_base):
    """Contributions add up to the margin of boosted trees and to the probability of a tree and a forest."""
    every = models.candidates(rounds=5, trees=4)
    for name in ("gradient_boosting", "decision_tree", "random_forest"):
        model = models.fit_pipeline(signal_base, every[name])
        table, expected = explain.contributions(model, signal_base)
        total = F.aggregate("contributions", F.lit(expected), lambda a, v: a + v)
        column = "rawPrediction" if name == "gradient_boosting" else "probability"
        want = model.transform(signal_base).select("unit_id", vector_to_array(column)[1].alias("want"))
        gap = table.select("unit_id", total.alias("total")).join(want, "unit_id").agg(F.max(F.abs(F.col("total") - F.col("want")))).first()[0]
        assert gap < 1e-9, name


def test_boosting_learns_and_is_saved(signal_base, tmp_path):
    model = models.fit_pipeline(signal_base, models.boosting(rounds=8, leaves=8, min_leaf=10))
    model.write().overwrite().save(f"{tmp_path}/m")
    again = PipelineModel.load(f"{tmp_path}/m")
    scores = [models.score_rows(m, signal_base).select("unit_id", "label", "weight", "score") for m in (model, again)]
    assert sorted(scores[0].collect()) == sorted(scores[1].collect())
    assert metrics.ranking_metrics(scores[0]).first()["roc_auc"] > 0.8


def test_importance_from_affected_trees_is_that_of_whole_copies(signal_base, monkeypatch):
    model = models.fit_pipeline(signal_base, models.boosting(rounds=6, leaves=8, min_leaf=10))
    names = prep.feature_owners(model.stages[0].learned())
    assert len(names) == len(model.stages[0].feature_names())
    assert all(f.removeprefix(prep.FLAG_PREFIX).startswith(c) for f, c in zip(model.stages[0].feature_names(), names))
    fast = explain.permutation_importance(model, signal_base, repeats=2).collect()
    monkeypatch.setattr(explain, "BoostedTrees", int)  # no model is a boosted one now
    slow = explain.permutation_importance(model, signal_base, repeats=2).collect()
    assert [tuple(r) for r in fast] == [tuple(r) for r in slow]
    assert fast[0]["importance"] > 0.05 and fast[-1]["importance"] <= 0


def test_importance_writes_no_table_of_shuffled_scores(signal_base, monkeypatch):
    """Areas come from slices that are ordered on their own; the only large tables written are the rows themselves."""
    model = models.fit_pipeline(signal_base, models.boosting(rounds=6, leaves=8, min_leaf=10))
    whole = explain.permutation_importance(model, signal_base, repeats=2).collect()
    sizes = {}

    def counted(df, name):
        out = staging.staged(df, name)
        sizes[name] = max(sizes.get(name, 0), out.count())
        return out

    monkeypatch.setattr(explain, "staged", counted)
    monkeypatch.setattr(ordering, "staged", counted)
    monkeypatch.setattr(explain, "SLICE_ROWS", 60, raising=False)
    sliced = explain.permutation_importance(model, signal_base, repeats=2).collect()
    assert sliced == whole
    assert set(sizes) == {"rows", "placed", "shuffled_auc"}
    assert max(sizes.values()) <= signal_base.count()
