"""Every registered query against its SQL on the given tables."""

import __spark_entry__ as registered
import pytest
from oracle import connect, differences

SF_DIR = "/root/testdata/sf0.01"
SQL = registered.table_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(registered.table_queries()))
def test_query(spark, tables, name):
    assert differences(registered.queries()[name](spark, SF_DIR), tables, SQL[name]) == ""


def test_every_sql_has_a_query():
    assert set(SQL) == set(registered.table_queries())


def test_entry(spark):
    assert registered.entry(spark).columns == ["segment", "revenue", "revenue_rank", "revenue_share"]
