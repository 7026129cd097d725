"""Preparation is learned from training rows only and copes with gaps, constants and new levels."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from forerate.contracts import feature_columns
from forerate.functions import ordering
from forerate.operators import prep


def estimator(df, **options):
    found = feature_columns(df)
    return prep.TabularPrep(numericCols=found.numeric, categoricalCols=found.categorical, **options)


def matrix(model, df):
    rows = model.transform(df).select("unit_id", vector_to_array("features").alias("f")).collect()
    return {r["unit_id"]: np.array(r["f"]) for r in rows}


def quantile_scale(x):
    return np.quantile(x, 0.75) - np.quantile(x, 0.25) or 1.0


@pytest.mark.parametrize("scaler", ["standard", "robust"])
@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_numbers_match_brute_force(base, monkeypatch, scaler, limit):
    monkeypatch.setattr(ordering, "MAX_IN_TASK", limit)
    found = feature_columns(base)
    model = prep.TabularPrep(numericCols=found.numeric, categoricalCols=[], scaler=scaler).fit(base)
    got = matrix(model, base)
    pdf = base.toPandas().set_index("unit_id")
    raw = pdf[found.numeric]
    flags = raw.loc[:, raw.isna().any()].isna().astype(float).add_prefix("missingindicator_")
    x = pd.concat([raw.fillna(raw.median()), flags], axis=1)
    if scaler == "standard":
        want = (x - x.mean()) / x.std(ddof=0)
    else:
        want = (x - x.median()) / x.apply(quantile_scale)
    assert model.feature_names() == list(x.columns)
    for unit, row in want.iterrows():
        np.testing.assert_allclose(got[unit], row.to_numpy(dtype=float), rtol=1e-9, atol=1e-9)


def test_no_gap_is_left_and_every_gap_is_flagged(base):
    model = estimator(base).fit(base)
    assert not any(np.isnan(v).any() for v in matrix(model, base).values())
    assert "missingindicator_group_rate_prior_year" in model.feature_names()
    assert "missingindicator_region_target" not in model.feature_names()


def test_unseen_level_is_all_zero(base):
    seen = base.where("region1 <> 'isles'")
    model = estimator(seen).fit(seen)
    new = base.where("region1 = 'isles'")
    at = [i for i, n in enumerate(model.feature_names()) if n.startswith("region1_")]
    got = matrix(model, new)
    assert len(got) == new.count() and all((v[at] == 0).all() for v in got.values())


def test_rare_levels_share_a_column_and_gaps_take_the_most_frequent(spark):
    rows = [(f"u{i}", "a" if i < 150 else "b") for i in range(299)] + [("u299", "x"), ("u300", None)]
    df = spark.createDataFrame(rows, "unit_id string, form string")
    model = prep.TabularPrep(categoricalCols=["form"]).fit(df)
    assert model.feature_names() == ["form_a", "form_b", "form_infrequent_sklearn"]
    got = matrix(model, df)
    assert list(got["u299"]) == [0, 0, 1] and list(got["u300"]) == [1, 0, 0]
    other = spark.createDataFrame([("n", "never")], "unit_id string, form string")
    assert list(matrix(model, other)["n"]) == [0, 0, 0]


def test_equally_frequent_levels_fill_with_the_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "form string")
    counts = prep.value_counts(df, [], ["form"])
    got = {r["level"]: r for r in prep.category_levels(counts).collect()}
    assert got["a"]["is_filler"] and got["a"]["rows"] == 2 and not got["b"]["is_filler"]


def test_constant_empty_and_nan_columns(spark):
    df = spark.createDataFrame(
        [("u1", 5.0, None, 1.0), ("u2", 5.0, None, float("nan")), ("u3", 5.0, None, 3.0)],
        "unit_id string, target double, gdp double, population double",
    )
    model = prep.TabularPrep(numericCols=["target", "gdp", "population"]).fit(df)
    assert model.feature_names() == ["target", "population", "missingindicator_gdp", "missingindicator_population"]
    got = matrix(model, df)
    assert all(v[0] == 0 and v[2] == 0 for v in got.values()) and got["u2"][1] == 0


def test_all_folds_learn_in_one_pass_what_each_learns_alone(base):
    found = feature_columns(base)
    folded = base.withColumn("fold", F.crc32("group_id") % 3)
    folded = folded.withColumn("fits", F.array_remove(F.sequence(F.lit(0), F.lit(2)), F.col("fold").cast("int")))
    together = prep.fit_specs(folded, found.numeric, found.categorical, fits="fits")
    for i in range(3):
        alone = prep.fit_specs(folded.where(F.col("fold") != i), found.numeric, found.categorical)[prep.ALL]
        assert prep.feature_expressions(alone).keys() == prep.feature_expressions(together[i]).keys()
        for kind in ("numeric", "flags"):
            for a, b in zip(alone[kind], together[i][kind]):
                assert a["column"] == b["column"]
                assert [a[k] for k in a if k != "column"] == pytest.approx([b[k] for k in b if k != "column"])
        assert alone["categorical"] == together[i]["categorical"]


def test_preparation_and_model_are_one_saved_object(base, tmp_path):
    stages = [estimator(base), LogisticRegression(labelCol="label", maxIter=5)]
    model = Pipeline(stages=stages).fit(base)
    model.write().overwrite().save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model")
    assert again.stages[0].feature_names() == model.stages[0].feature_names()
    scores = [m.transform(base).select("unit_id", vector_to_array("probability").alias("p")) for m in (model, again)]
    rows = [{r["unit_id"]: r["p"] for r in s.collect()} for s in scores]
    assert rows[0] == rows[1] and len(rows[0]) == base.count()
    assert all(len(p) == 2 and sum(p) == pytest.approx(1) for p in rows[0].values())


def test_many_rare_levels_in_many_fits(spark, tmp_path):
    """A column with hundreds of rare levels: each marks its rows, in every fit and after saving."""
    rows = [(i, f"L{i % 700}" if i % 3 else "often", [j for j in range(18) if (i + j) % 6]) for i in range(4200)]
    df = spark.createDataFrame(rows, "id int, c string, fits array<int>")
    specs = prep.fit_specs(df, [], ["c"], fits="fits")
    assert len(specs) == 18
    for fit in (0, 17):
        known = {c for _, c, fits in rows if fit in fits}
        got = prep.with_features(df, specs[fit]).select("c", vector_to_array("features").alias("x")).distinct().collect()
        for r in got:
            want = [1.0, 0.0] if r["c"] == "often" else [0.0, float(r["c"] in known)]
            assert list(r["x"]) == want
    model = prep.TabularPrep(numericCols=[], categoricalCols=["c"]).fit(df)
    model.write().overwrite().save(f"{tmp_path}/prep")
    again = prep.TabularPrepModel.load(f"{tmp_path}/prep")
    new = spark.createDataFrame([("often",), ("L1",), ("never seen",), (None,)], "c string")
    both = [[list(r[0]) for r in m.transform(new).select(vector_to_array("features")).collect()] for m in (model, again)]
    assert both[0] == both[1] and [1.0, 0.0] in both[0] and [0.0, 1.0] in both[0] and [0.0, 0.0] in both[0]
