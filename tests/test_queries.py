"""Every query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import pytest
from compare import connection, difference

import metriclab.event_queries  # noqa: F401
from metriclab.contract_queries import FIXED
from metriclab.queries import ORACLES, QUERIES

#: Trained in test_forest_queries.
SLOW = {"discovery_rounds", "rf_importance", "indicator_ranking_forest", "redundancy_prune", "weight_grid_search_forest"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, sf_dir, name):
    if name in ORACLES:
        assert difference(spark, connection(sf_dir), QUERIES[name], ORACLES[name], sf_dir) == ""
    else:
        assert QUERIES[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", sorted(FIXED))
def test_given_values(spark, sf_dir, name):
    query, sql = FIXED[name]
    assert name not in QUERIES and difference(spark, connection(sf_dir), query, sql, sf_dir) == ""


def test_entry_lists_what_has_sql():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
