"""Every query with checking SQL, compared row by row at the smallest scale."""

import pytest

from bidlens.catalog import ORACLES, QUERIES
from compare import check, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    rows, _, problem = check(spark, FOLDER, name, QUERIES[name], ORACLES[name], con)
    assert problem is None, problem
    assert rows > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
