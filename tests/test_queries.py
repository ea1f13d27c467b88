"""Every checked query against its SQL, and the driver's contract."""

import pytest

import __spark_entry__
from compare import spark_rows, sql_rows, views
from corpusloom.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return views(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_contract(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    df = __spark_entry__.entry(spark)
    assert df.count() >= 0 and df.columns
