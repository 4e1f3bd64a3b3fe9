"""Every registered query equals its SQL oracle (DuckDB) on the smallest fixture."""

import pytest

from tillroll.oracle import build
from tillroll.queries import QUERIES
from oracle_check import check, duck

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    msg = check(spark, con, SF_SMALL, name, QUERIES[name], build()[name])
    assert " OK " in msg, msg
