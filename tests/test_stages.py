"""The whole course on the smallest tables: train, evaluate, apply, report."""

import dataclasses
import json

import pytest
from pyspark.sql import functions as F

from forerate.operators import models
from forerate.plans import reports, stages
from forerate.sources import star
from forerate.sources.staging import write_tables

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Base, both sides, model and training tables on disk."""
    where = str(tmp_path_factory.mktemp("run"))
    stages.save_base(star.base(spark, SF_DIR).drop("fixed_score"), where)
    every = models.candidates(rounds=2, trees=3)
    stages.save_training(
        spark,
        where,
        families={m: every[m] for m in ("baseline", "naive_bayes")},
        space={"rate": [0.1], "rounds": [2], "leaves": [4, 8], "min_leaf": [20]},
        n_iter=2,
        k=2,
        rounds=2,
        parallelism=6,
    )
    return where


@pytest.fixture(scope="module")
def run(spark, root):
    """Evaluation and application from the saved files alone."""
    evaluated = stages.save_evaluation(spark, root)
    applied = stages.save_application(spark, root, star.names(spark, SF_DIR), restarts=2)
    names = "design comparison scaler_comparison learning_curve validation_curve search ablation".split()
    trained = stages.load_trained(spark, root)
    tables = {n: spark.read.parquet(f"{root}/training/{n}") for n in names}
    return dataclasses.replace(trained, tables=tables), evaluated, applied


def test_documents_are_whole(spark, root, run):
    documents = {n: json.loads(spark.read.json(f"{root}/documents/{n}").first()["document"]) for n in ("training", "metrics", "strategy")}
    assert {"design", "comparison", "search", "params", "ablation"} <= set(documents["training"])
    assert {"precision_0", "recall_1", "roc_auc", "threshold"} <= set(documents["metrics"]["metrics"][0])
    told = documents["strategy"]["strategy"][0]
    assert told["adopted_k"] == 4 and -1 <= told["silhouette"] <= 1 and told["region_risk"] and told["profiles"]
    assert documents["strategy"]["risk_by_region"]


def test_tables_of_all_stages(run):
    trained, evaluated, applied = run
    assert trained.tables["comparison"].count() == trained.tables["ablation"].count() == 2
    assert trained.tables["learning_curve"].count() == trained.tables["validation_curve"].count() == 6
    metrics = evaluated["metrics"].first()
    assert 0 <= metrics["roc_auc"] <= 1 and (metrics["threshold"] == 0.5 or 0.3 <= metrics["threshold"] <= 0.85)
    assert evaluated["confusion"].agg(F.sum("rows")).first()[0] == trained.test.count()
    assert applied["profiles"].agg(F.sum("units")).first()[0] == applied["units"].count()
    assert applied["k_scan"].count() == 7


def test_report_tables_and_documents(run, tmp_path):
    tables = reports.modelling_tables(run[0].tables, run[1], run[2])
    assert tables["adopted_k"].first()["k"] == 4
    assert tables["top_permutation"].count() == 10 and tables["top_risk"].count() <= 15
    document = json.loads(reports.as_json({n: tables[n] for n in ("design", "risk_summary", "ablation_range")}).first()[0])
    assert {r["side"] for r in document["design"]} == {"train", "test"}
    assert tables["importance_chart"].count() == tables["effect_chart"].count() == 15
    paths = write_tables({n: tables[n] for n in ("design", "errors")}, str(tmp_path))
    assert set(paths) == {"design", "errors"}


def test_a_split_that_leaks_is_refused(run, monkeypatch):
    def leaky(base, share, seed):
        return base.withColumn("is_test", F.col("form") == "1")

    monkeypatch.setattr(stages.sampling, "group_split", leaky)
    with pytest.raises(ValueError, match="both sides"):
        stages.split(run[0].train)
