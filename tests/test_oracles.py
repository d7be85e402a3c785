"""Every query against its SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from tests.conftest import SF

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, SQL[name]) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_gives_the_same_rows_again(spark, name):
    """Queries without SQL draw or iterate; what they must keep is tested by queries of their own (``..._rules`` and others)."""
    one, two = (sorted(str(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in QUERIES[name](spark, SF).collect()) for _ in range(2))
    assert one and one == two


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)
