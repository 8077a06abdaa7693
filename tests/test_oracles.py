"""Every registered query against its DuckDB oracle on sf0.001 (the
driver runs the same comparison at sf0.01)."""

import pytest

from firn.plans import registry
from firn.plans.compare import compare

from conftest import SF_SMALL

registry.load_all()


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, duck, name):
    res = compare(registry.QUERIES[name](spark, SF_SMALL), duck, registry.ORACLES[name])
    assert res["ok"], res


def test_every_oracle_has_a_query():
    assert set(registry.ORACLES) <= set(registry.QUERIES)


def test_rows_only_queries_run(spark):
    for name in sorted(set(registry.QUERIES) - set(registry.ORACLES)):
        assert registry.QUERIES[name](spark, SF_SMALL).count() >= 0
