"""Every registered query against its SQL on the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SMALL
from tests.oracle import connect, differences


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_sql(spark, duck, name):
    result = queries()[name](spark, SMALL)
    if name in oracle_sql():
        assert differences(result, duck, oracle_sql()[name]) == []
    else:
        assert result.count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
