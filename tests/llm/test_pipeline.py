"""The pipeline's stages, each judged on its own input by brute force; registration."""

from __future__ import annotations

import os
import random
from collections import Counter

import brute
import corpus_pipeline
import pytest
from texts import edited, prose
from harness import differences, sql_rows

import __spark_entry__
from forerate.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sf_dir(spark, rows, tmp_path_factory):
    rng = random.Random(20)
    root = str(tmp_path_factory.mktemp("tables"))
    items = [(j, prose(rng, n)) for j, n in enumerate([12, 30, 45])]
    more = [(5000 + 3 * j + e, prose(rng, 150) + " " + edited(rng, t, e) + " " + prose(rng, 100)) for j, t in items for e in range(2)]
    full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in [*rows, *more]]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(full, schema).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    want = [(r.doc_id, r.text) for r in docs.collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, sf_dir), name)
        if name == "quality":  # no line is in enough documents here, so the base rules decide
            want = [(i, t) for i, t in want if not brute.base_failed(t)]
        elif name == "near_duplicates":
            least = brute.components(want, 5, 80)
            want = list({(i, t): 0 for i, t in want if i is not None and least[i] == i}) + [x for x in want if x[0] is None]
        elif name == "repeated_passages":
            want = [(i, brute.cut_text(t, g)) for (i, t), g in zip(want, brute.covered(want, 50), strict=True)]
        elif name == "decontamination":
            dirty = {i for i, _ in brute.leaks(want, items)}
            assert dirty
            want = [(i, t) for i, t in want if i not in dirty]
        if name != names[-1]:
            assert out.columns == docs.columns
        assert Counter((r.doc_id, r.text) for r in out.select("doc_id", "text").collect()) == Counter(want), name
        docs = out
    assert "pieces" in docs.columns
    assert corpus_pipeline.run(spark, sf_dir).count() == len(want)


def test_pipeline_of_no_documents(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_queries(spark, name):
    got = [r.asDict(recursive=True) for r in __spark_entry__.queries()[name](spark, SF).collect()]
    assert got
    if name in queries.ORACLES:
        assert not differences(got, sql_rows(SF, queries.ORACLES[name]))
    if name == "op5_sentence_pieces":
        assert all(r["round_trip"] for r in got)
