"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

from earshot.plans import registry
from tests.conftest import SF
from tests.oracle import assert_same


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_oracle(spark, name):
    assert_same(spark, registry.QUERIES[name], registry.ORACLES[name], SF)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_without_oracle_has_rows(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
