"""Every registered query against its SQL, on whole tables."""

import oracle
import pytest

import __spark_entry__ as entry
from catalog import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = {k: v for k, v in entry.queries().items() if k in registry.QUERIES}, entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert name in SQL
    difference = oracle.compare(QUERIES[name](spark, SF), duck, SQL[name])
    assert difference is None, difference


def test_entry(spark):
    out = entry.entry(spark)
    assert {"stock_code", "trade_date", "close", "adj"} <= set(out.columns)
    assert out.count() > 0
