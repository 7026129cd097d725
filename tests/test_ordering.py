"""Ranks, running sums, quantiles and cuts: the plain and the sliced way must agree with brute force."""

import hashlib

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forerate.functions import ordering


@pytest.fixture(params=["window", "slices"])
def way(request, monkeypatch):
    if request.param == "slices":
        monkeypatch.setattr(ordering, "MAX_IN_TASK", 0)
    return request.param


def skewed(spark, n=600):
    """One group holds two thirds of the rows; half of its values are the same."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        g = "hot" if i % 3 else f"g{i % 7}"
        v = 5.0 if g == "hot" and i % 2 else float(rng.integers(0, 50))
        rows.append((g, v, i))
    rows += [("single", 4.25, n), (None, 1.0, n + 1), ("g1", None, n + 2)]
    return spark.createDataFrame(rows, "g string, v double, id int")


def test_running_sums(spark, way):
    df = skewed(spark).dropna().withColumn("one", F.lit(1))
    got = ordering.running_sums(df, ["g"], [("v", False), ("id", True)], ["one", "v"]).collect()
    rows = df.collect()
    assert len(got) == len(rows)
    for r in got:
        mine = [x for x in rows if x["g"] == r["g"]]
        ahead = [x for x in mine if (-x["v"], x["id"]) < (-r["v"], r["id"])]
        assert r["one_before"] == len(ahead) and r["one_total"] == len(mine)
        assert r["v_before"] == pytest.approx(sum(x["v"] for x in ahead))


def test_running_sums_without_groups(spark, way):
    df = spark.range(1000).withColumn("one", F.lit(1))
    got = ordering.running_sums(df, [], [("id", False)], ["one"])
    assert got.where(F.col("one_before") != 999 - F.col("id")).count() == 0


def test_exact_quantiles_match_the_array_library(spark, way):
    df = skewed(spark)
    probs = {"q25": 0.25, "q50": 0.5, "q90": 0.9}
    got = {r["g"]: r for r in ordering.exact_quantiles(df, ["g"], "v", probs).collect()}
    values: dict = {}
    for r in df.dropna().collect():
        values.setdefault(r["g"], []).append(r["v"])
    assert set(got) == set(values)
    for g, v in values.items():
        for name, p in probs.items():
            assert got[g][name] == np.quantile(v, p), (g, name)


def test_exact_quantiles_of_nothing(spark, way):
    df = spark.createDataFrame([(None,)], "v double")
    assert ordering.exact_quantiles(df, [], "v", {"q": 0.5}).first()["q"] is None


def test_hash_cuts_pick_the_exact_row(spark, way):
    df = spark.range(500).select((F.col("id") % 2).alias("s"), F.md5(F.col("id").cast("string")).alias("h"))
    wanted = spark.createDataFrame([(0, 1), (0, 77), (1, 250), (1, 0), (1, 999)], "s long, want long")
    got = {(r["s"], r["want"]): r["cut"] for r in ordering.hash_cuts(df, ["s"], "h", wanted, 250).collect()}
    for s, want in ((0, 1), (0, 77), (1, 250)):
        hashes = sorted(hashlib.md5(str(i).encode()).hexdigest() for i in range(500) if i % 2 == s)
        assert got[s, want] == hashes[want - 1]
    assert len(got) == 3


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40), p=st.sampled_from([0.1, 0.25, 0.5, 0.75, 1.0]))
def test_quantile_property(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = ordering.exact_quantiles(df, [], "v", {"q": p}).first()["q"]
    assert got == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-9)
