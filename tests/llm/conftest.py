from __future__ import annotations

import pytest
from texts import DOCS, corpus, frame


@pytest.fixture(scope="session")
def rows():
    return corpus(11)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def make(spark):
    return lambda some: frame(spark, some)
