"""Every registered query equals its DuckDB oracle on the smallest tables."""

import pytest

from eventlens.plans.catalog import QUERIES
from eventlens.plans.oracle import oracle_queries
from tests.conftest import SF_SMALL
from tests.helpers import assert_same

SQL = oracle_queries()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    assert_same(QUERIES[name](spark, SF_SMALL), duck.sql(SQL[name]))


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert "trailing_users_28d" in df.columns
