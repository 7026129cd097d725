"""Every registered query against its SQL on an independent engine, and the driver contract."""

import os

import pytest
from harness import differences, sql_rows

import __spark_entry__ as driver
from forerate.sources.staging import drop_staged

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
FITTED = sorted(set(driver.queries()) - set(driver.oracle_sql()))


def test_every_check_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert {n for n in FITTED if not n.startswith("op")} <= {"pipeline"}


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() > 0 and len(df.columns) == 26


@pytest.mark.parametrize("name", sorted(n for n in driver.oracle_sql() if not n.startswith("op")))
def test_query_matches_sql(spark, name):
    df = driver.queries()[name](spark, SF_DIR)
    rows = [r.asDict() for r in df.collect()]
    want = sql_rows(SF_DIR, driver.oracle_sql()[name])
    assert not want or sorted(df.columns) == sorted(want[0])
    assert differences(rows, want) == []


def test_a_query_runs_again_after_its_tables_are_dropped(spark):
    rows = [driver.queries()["label_share"](spark, SF_DIR).collect()]
    assert drop_staged(spark)
    rows.append(driver.queries()["label_share"](spark, SF_DIR).collect())
    assert rows[0] == rows[1]
