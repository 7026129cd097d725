"""The outcome must not be reachable from the features."""

import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forerate import contracts
from forerate.sources import staging, star

@pytest.fixture(scope="module")
def outcome_columns(spark):
    """What the engine's own tables say about the target year, besides keys and the agreed target."""
    tables = star.inputs(spark, "/root/testdata/sf0.001")
    keys = {"year", "group_id", "region1", "network", "aggregated", "target"}
    told = [tables.group_indicator, tables.region_indicator, tables.national_indicator, tables.published]
    return sorted({*(c for df in told for c in df.columns), "score_raw", "fixed_score"} - keys)


def test_outcome_columns_of_the_target_year_are_turned_away(spark, outcome_columns):
    df = star.base(spark, "/root/testdata/sf0.001")
    assert len(outcome_columns) >= 4
    for prefix in ("", "target_year_", "group_"):
        told = df.withColumns({prefix + c: F.lit(0.5) for c in outcome_columns})
        found = contracts.feature_columns(told)
        new = {prefix + c for c in outcome_columns}
        assert not new & {*found.numeric, *found.categorical}
        assert new <= set(found.dropped)


def test_features_of_the_base_are_the_agreed_ones(spark):
    found = contracts.feature_columns(star.base(spark, "/root/testdata/sf0.001"))
    assert set(found.numeric) <= set(contracts.NUMERIC_FEATURES) and found.dropped == ["fixed_score"]


def test_ids_label_and_weight_are_no_features(base):
    found = contracts.feature_columns(base)
    assert not set(contracts.NEVER_FEATURES) & {*found.numeric, *found.categorical, *found.dropped}


def test_numeric_features_are_prior_year_or_agreed(base):
    assert contracts.unproven_features(contracts.feature_columns(base).numeric) == []
    assert contracts.unproven_features(contracts.NUMERIC_FEATURES) == []
    assert contracts.unproven_features(["rate_today"]) == ["rate_today"]


def test_an_allowed_name_of_another_type_is_not_numeric(base):
    df = base.withColumn("target", F.lit("high"))
    found = contracts.feature_columns(df)
    assert "target" not in found.numeric and found.dropped == ["target"]


def test_contract_names_what_is_missing(spark):
    df = spark.createDataFrame([(1,)], "unit_id int")
    with pytest.raises(contracts.ContractError, match="group_id.*unit_id: int instead of string"):
        contracts.require_columns(df, {"unit_id": T.StringType(), "group_id": T.StringType()}, "units")


def test_code_is_shipped_once_by_jobs_side_by_side():
    sent = []

    def add(path):
        time.sleep(0.2)
        sent.append(path)

    session = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="ship-test", addPyFile=add))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(staging.ship_package, [session] * 4))
    assert len(sent) == 1
