"""Every registered query against its SQL on another engine, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tests.oracle import compare

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    ok, message, _ = compare(spark, duck, SMALL, name, QUERIES[name], SQL.get(name))
    assert ok, message


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "mlr_last_12_months" in df.columns
