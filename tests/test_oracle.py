"""Every registered query against its DuckDB oracle (and the driver contract)."""

import pytest

from civiq.registry import REGISTRY
from tests.compare import compare, duck

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    fn, sql = REGISTRY[name]
    if sql is None:
        assert fn(spark, SF_SMALL).count() >= 0
        return
    r = compare(spark, name, fn, sql, SF_SMALL, con)
    assert r["ok"], r


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() >= 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) >= 60
