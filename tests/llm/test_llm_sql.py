"""Every query of this subpackage that has an SQL twin, against it."""

import pytest
from oracle import connect, spark_rows, sql_rows

from tidemark.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_agrees_with_sql(spark, con, supplied, name):
    df = queries.queries()[name](spark, SF_DIR)
    expected, names = sql_rows(con, queries.oracle_sql()[name])
    assert sorted(df.columns) == names
    assert spark_rows(df) == expected
