"""Units, their risk and their profiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from forerate.operators import risk, segments

SCORED = "group_id string, region1 string, region2 string, network string, weight double, score double, label int, target double, group_rate_prior_year double"


@pytest.fixture(scope="module")
def scored(spark):
    rows = []
    for i in range(25):
        rows.append(("g1", "SP", "S", "M", 1.0 + i % 2, 0.5, i % 2, 60.0, 55.0))
        rows.append(("g2", "SP", "S", "M", 1.0, 0.9, 1, None, 70.0))
        rows.append(("g3", "BA", "N", "M", 2.0, 0.8, 1, 75.0, None))
    rows += [("g4", "BA", "N", "M", 1.0, 0.1, 0, 50.0, 50.0)] * 19
    rows += [("g5", None, None, "M", 1.0, 0.1, 0, 50.0, 50.0)] * 30
    return spark.createDataFrame(rows, SCORED)


def test_unit_risk(scored):
    got = {r["group_id"]: r for r in risk.unit_risk(scored).collect()}
    # too few rows, and rows without a region, are no units
    assert set(got) == {"g1", "g2", "g3"}
    assert got["g1"]["predicted_rate"] == 50 and got["g1"]["risk"] == 0.5 and got["g1"]["gap_predicted_target"] == -10
    w = [1.0 + i % 2 for i in range(25)]
    assert got["g1"]["real_rate"] == np.round(100 * np.average([i % 2 for i in range(25)], weights=w), 2)
    assert [got[g]["at_risk"] for g in ("g1", "g2", "g3")] == [True, False, False]
    assert got["g2"]["no_target"] and got["g2"]["gap_predicted_target"] is None


def test_summaries(scored):
    units = risk.unit_risk(scored)
    s = risk.risk_summary(units).first()
    assert (s["units"], s["groups"], s["without_target"], s["assessable"], s["at_risk"], s["pct_at_risk"]) == (3, 3, 1, 2, 1, 50.0)
    assert risk.risk_summary(units.where("group_id = 'x'")).first()["pct_at_risk"] == 0
    errors = risk.rate_errors(units).first()
    real = risk.unit_risk(scored).where("group_id = 'g1'").first()["real_rate"]
    assert errors["units"] == 2
    assert errors["mae_model"] == pytest.approx((abs(50 - real) + 10) / 2, abs=0.006)
    assert errors["mae_repeat_last_year"] == pytest.approx((abs(55 - real) + 30) / 2, abs=0.006)
    assert [r["region2"] for r in risk.risk_by_region(units).collect()] == ["S", "N"]
    assert [r["group_id"] for r in risk.top_risk(units, 2).collect()] == ["g1", "g3"]


def test_zero_weights_give_no_rate(scored):
    units = risk.unit_risk(scored.withColumn("weight", F.lit(0.0)))
    assert units.where("predicted_rate IS NOT NULL").count() == 0 and units.where("at_risk").count() == 0


def test_contradictions_are_found(scored):
    assert risk.contradictory_units(scored).count() == 0
    odd = scored.withColumn("target", F.when(F.col("label") == 1, 61.0).otherwise(F.col("target")))
    assert {r["group_id"] for r in risk.contradictory_units(odd).collect()} == {"g1"}


def test_clashing_name_columns_get_a_suffix(spark, scored):
    names = spark.createDataFrame([("g1", "One", "XX")], "group_id string, group_name string, region1 string")
    got = risk.with_names(risk.unit_risk(scored), names)
    row = got.where("group_id = 'g1'").first()
    assert row["group_name"] == "One" and row["region1"] == "SP" and row["region1_dim"] == "XX"
    assert got.count() == 3


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(11)
    rows = [(i, i % 3, *map(float, rng.normal(3 * (i % 3), 1, 2))) for i in range(60)] + [(60, 3, 40.0, 40.0)]
    return spark.createDataFrame(rows, "id int, profile int, x double, y double")


def test_cluster_quality_against_brute_force(points):
    pdf = points.toPandas()
    xy, c = pdf[["x", "y"]].to_numpy(), pdf["profile"].to_numpy()
    centres = {k: xy[c == k].mean(axis=0) for k in set(c)}
    inertia = sum(((xy[c == k] - m) ** 2).sum() for k, m in centres.items())
    square = ((xy[:, None] - xy[None]) ** 2).sum(axis=2)
    widths = []
    for i in range(len(xy)):
        mine = (c == c[i]) & (np.arange(len(xy)) != i)
        if not mine.any():
            widths.append(0)
            continue
        a = square[i, mine].mean()
        b = min(square[i, c == k].mean() for k in centres if k != c[i])
        widths.append((b - a) / max(a, b))
    spread = {k: np.linalg.norm(xy[c == k] - m, axis=1).mean() for k, m in centres.items()}
    db = np.mean([max((spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j]) for j in centres if j != i) for i in centres])
    dims = ["x", "y"]
    assert segments.inertia(points, dims=dims).first()[0] == pytest.approx(inertia)
    assert segments.silhouette(points, dims=dims).first()[0] == pytest.approx(np.mean(widths))
    assert segments.davies_bouldin(points, dims=dims).first()[0] == pytest.approx(db)
    twice = points.withColumn("k", F.lit(1)).unionByName(points.withColumn("k", F.lit(2)))
    assert [r["silhouette"] for r in segments.silhouette(twice, ["k"], dims=dims).collect()] == pytest.approx([np.mean(widths)] * 2)


@pytest.fixture(scope="module")
def units(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(60):
        level = 30.0 + 15 * (i % 4) + float(rng.normal())
        rows.append((f"g{i}", "M", level, level + 1, 60.0, level - 60, 20 + i))
    return spark.createDataFrame(rows, "group_id string, network string, predicted_rate double, rate_prior_year double, target double, gap_predicted_target double, rows int")


def test_profile_matrix_is_standardised(units):
    z = segments.profile_matrix(units.withColumn("rate_prior_year", F.when(F.col("rows") > 25, F.col("rate_prior_year"))))
    for d in ("z_predicted_rate", "z_rate_prior_year", "z_gap_predicted_target"):
        m, s = z.agg(F.avg(d), F.stddev_pop(d)).first()
        assert m == pytest.approx(0, abs=1e-9) and s == pytest.approx(1)
    assert z.agg(F.max(F.abs("z_target"))).first()[0] == 0


def test_profiles_are_named_by_level(units):
    assigned = segments.assign_profiles(units, restarts=3)
    summary = segments.profile_summary(assigned)
    rows = summary.orderBy("predicted_rate").collect()
    assert [r["profile_name"] for r in rows] == segments.PROFILE_NAMES
    assert [r["units"] for r in rows] == [15, 15, 15, 15]
    assert segments.with_profile_names(assigned, summary).count() == 60
    placed, shares = segments.projection(assigned)
    assert placed.count() == 60 and 0.9 < sum(shares) <= 1.0001


def test_more_profiles_than_names_share_the_last(spark):
    df = spark.createDataFrame([(i, float(10 * i), 1.0, 1.0, 20) for i in range(6)], "profile int, predicted_rate double, rate_prior_year double, target double, rows int")
    names = [r["profile_name"] for r in segments.profile_summary(df).orderBy("predicted_rate").collect()]
    assert names == [*segments.PROFILE_NAMES, "Consolidated", "Consolidated"]


def test_k_scan_prefers_the_true_number(units):
    table = segments.k_scan(units, range(2, 6), restarts=2).collect()
    assert [r["k"] for r in table] == [2, 3, 4, 5]
    assert [r["inertia"] for r in table] == sorted((r["inertia"] for r in table), reverse=True)
    assert max(table, key=lambda r: r["silhouette_kmeans"])["k"] == 4
    # standardised points are centred at the origin; every family must still split them
    assert all(r["silhouette_hierarchical"] is not None for r in table)
    assert min(table, key=lambda r: r["davies_bouldin_kmeans"])["k"] == 4


def test_a_name_table_with_a_key_twice_is_refused(spark):
    units = spark.createDataFrame([("g", 1)], "group_id string, rows int")
    names = spark.createDataFrame([("g", "one"), ("g", "two")], "group_id string, group_name string")
    with pytest.raises(ValueError, match="group g is in the name table 2 times"):
        risk.with_names(units, names)
    assert risk.with_names(units, names.limit(1)).count() == 1


def test_nearest_centres(spark):
    rows = [(0, 0.0, 0.0), (0, 1.0, 0.0), (1, 10.0, 0.0), (1, 9.0, 0.0), (1, 1.5, 0.0)]
    got = segments.nearest(spark.createDataFrame(rows, "profile int, a double, b double"), dims=["a", "b"]).collect()
    assert [r["nearest"] for r in got] == [True, True, True, True, False]
