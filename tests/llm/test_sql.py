import pytest
from compare import check

from bidlens.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    rows, _, problem = check(spark, "/root/testdata/sf0.001", name, QUERIES[name], ORACLES[name])
    assert problem is None and rows
