"""The corpus pipeline: stages that each apply one operator to what the one before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forerate.llm import decontaminate, ngram_join, pieces, quality, substrings
from forerate.llm.queries import table, vocabulary
from forerate.llm.token_files import small_batches
from forerate.sources.staging import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and aren't depleted, without their boilerplate lines."""
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word Jaccard similarity of 0.8 or more."""
    return ngram_join.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-word passages that an earlier document has."""
    return substrings.without_repeats(docs)


def test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the piece ids of their text; written here, so that few whole texts are in a task at a time."""
    with small_batches(spark):
        return staged(pieces.encode(docs, vocabulary("piece_bpe_32k.model")), "pieces")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", test_items),
    ("sentence_pieces", sentence_pieces),
]

#: SQL can't express the piece encoding; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
