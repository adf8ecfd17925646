"""Every named query against its SQL twin on DuckDB."""

import __spark_entry__ as entry_file
import pytest
from compare import connect, differences

from loomwell.plans.catalogue import REGISTRY

QUERIES = {name: item.run for name, item in REGISTRY.items()}
ORACLES = {name: item.oracle for name, item in REGISTRY.items() if item.oracle}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, con):
    df = QUERIES[name](spark, sf)
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0


def test_every_query_has_an_oracle_and_is_exported():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_file.queries()) and ORACLES.items() <= entry_file.oracle_sql().items()
