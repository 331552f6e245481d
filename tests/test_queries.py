"""Every registered query against DuckDB on the shared tables."""

import os

import pytest

import __spark_entry__ as entry
import oracle
from eventlayers.plans.oracles import ORACLES
from eventlayers.plans.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["page_url", "page_views", "bounces", "bounce_rate"]
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    n, extra, missing = oracle.compare(QUERIES[name](spark, SF), con, ORACLES[name])
    assert (extra, missing) == ([], []) and n > 0
