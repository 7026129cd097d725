"""Samples keep shares, groups stay whole, folds are balanced even when one group is huge."""

import math

import pytest
from pyspark.sql import functions as F

from forerate.functions import ordering
from forerate.operators import sampling


def ids(df):
    return {r["unit_id"] for r in df.select("unit_id").collect()}


def test_sample_keeps_the_label_share(base):
    got = sampling.stratified_sample(base, 200, seed=0)
    share = [df.agg(F.avg("label")).first()[0] for df in (base, got)]
    assert abs(share[0] - share[1]) < 0.05
    assert abs(got.count() - 200) <= 1


def test_sample_larger_than_the_data_is_the_data(base):
    assert sampling.stratified_sample(base, 10_000).count() == base.count()
    assert sampling.simple_sample(base, 10_000).count() == base.count()


def test_sample_does_not_depend_on_layout_and_changes_with_the_seed(base, monkeypatch):
    first = ids(sampling.stratified_sample(base, 100, seed=1))
    assert first == ids(sampling.stratified_sample(base.repartition(13), 100, seed=1))
    assert first != ids(sampling.stratified_sample(base, 100, seed=2))
    monkeypatch.setattr(ordering, "MAX_IN_TASK", 0)
    assert first == ids(sampling.stratified_sample(base, 100, seed=1))
    assert len(ids(sampling.simple_sample(base, 57, seed=1))) == 57


def test_rows_without_a_label_leave_the_sample(base):
    df = base.withColumn("label", F.when(F.col("form") != "x", F.col("label")))
    assert sampling.stratified_sample(df, 100).where("label IS NULL").count() == 0


def test_no_group_on_both_sides(base):
    df = sampling.group_split(base)
    train, test = df.where("NOT is_test"), df.where("is_test")
    assert sampling.shared_groups(train, test).count() == 0
    assert sampling.shared_groups(train, df).count() > 0


def test_split_covers_everything_by_groups(base):
    df = sampling.group_split(base, 0.25)
    counts = {r["is_test"]: r["count"] for r in df.groupBy("is_test").count().collect()}
    assert sum(counts.values()) == base.count() and min(counts.values()) > 0
    groups = base.select("group_id").distinct().count()
    assert df.where("is_test").select("group_id").distinct().count() == math.ceil(0.25 * groups)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_folds_are_whole_and_balanced(base, monkeypatch, limit):
    monkeypatch.setattr(ordering, "MAX_IN_TASK", limit)
    folds = sampling.group_folds(base, 5).collect()
    assert len(folds) == len({r["group_id"] for r in folds}) == base.select("group_id").distinct().count()
    load = [sum(r["rows"] for r in folds if r["fold"] == f) for f in range(5)]
    assert sum(load) == base.count()
    assert max(load) - min(load) <= 2 * max(r["rows"] for r in folds)


def test_a_group_with_half_of_the_rows_gets_its_own_fold(base):
    hot = base.withColumn("group_id", F.when(F.rand(1) < 0.5, "hot").otherwise(F.col("group_id"))).cache()
    folds = sampling.group_folds(hot, 4).collect()
    mine = next(r["fold"] for r in folds if r["group_id"] == "hot")
    assert [r["group_id"] for r in folds if r["fold"] == mine] == ["hot"]
    rest = [sum(r["rows"] for r in folds if r["fold"] == f) for f in range(4) if f != mine]
    assert len(rest) == 3 and max(rest) - min(rest) <= 2 * max(r["rows"] for r in folds if r["group_id"] != "hot")
    hot.unpersist()


def test_as_many_groups_as_folds(spark):
    df = spark.createDataFrame([("a", "u1"), ("b", "u2"), ("b", "u3")], "group_id string, unit_id string")
    assert sorted(r["fold"] for r in sampling.group_folds(df, 2).collect()) == [0, 1]
    assert sampling.with_folds(df, 2).count() == 3


def test_rows_without_a_group_are_one_group(odd_base):
    """No row is lost, and the rows without a group stay together, in folds as in the split."""
    folded = sampling.with_folds(odd_base, 4)
    assert ids(folded) == ids(odd_base) and folded.count() == odd_base.count()
    assert folded.where("group_id IS NULL").select("fold").distinct().count() == 1
    assert folded.where("fold IS NULL").count() == 0
    split = sampling.group_split(odd_base, 0.3)
    assert split.where("is_test IS NULL").count() == 0
    assert split.where("group_id IS NULL").select("is_test").distinct().count() == 1
    sides = [split.where("is_test"), split.where("NOT is_test")]
    assert sampling.shared_groups(*sides).count() == 0
    groups = odd_base.select("group_id").distinct().count()
    assert sides[0].select("group_id").distinct().count() == math.ceil(0.3 * groups)
