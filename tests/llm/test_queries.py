import pytest

from ledgermill.llm.queries import ORACLE_SQL, QUERIES
from compare import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, small, name):
    assert compare(QUERIES[name](spark, small), connect(small), ORACLE_SQL[name]) is None
