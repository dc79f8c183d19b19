"""Every query against its SQL oracle on the smallest driver tables."""

import pytest

from __spark_entry__ import LIBRARY, entry, oracle_sql, queries
from checks.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(name for family in LIBRARY for name in family.QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    assert differences(queries()[name](spark, SF_DIR), duck, oracle_sql()[name]) == []


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(queries()) and set(NAMES) <= set(oracle_sql())


def test_entry_returns_one_row_per_account(spark):
    result = entry(spark)
    assert result.count() == result.select("IN_ACCOUNT_NUMBER").distinct().count() > 0
