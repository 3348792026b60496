"""Every registered query against its SQL twin."""

import os
import sys

import pytest
from oracle import connect, spark_rows, sql_rows

import __spark_entry__ as driver
from tidemark.workload import all_queries, all_sql

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no supplied tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_agrees_with_sql(spark, con, name):
    df = all_queries()[name](spark, SF_DIR)
    got = spark_rows(df)
    expected, names = sql_rows(con, all_sql()[name])
    assert sorted(df.columns) == names
    assert got == expected


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_queries_without_the_text_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert set(driver.queries()) == set(all_queries())
    assert set(driver.oracle_sql()) == set(all_sql())
