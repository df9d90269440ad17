"""Every query of the engine against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from compare import assert_same
TINY = "/root/testdata/sf0.001"

import __spark_entry__ as entry
from cohortspark.plans import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    assert_same(QUERIES[name](spark, TINY), duck, ORACLES[name])


def test_entry_is_the_burden(spark):
    df = entry.entry(spark)
    assert df.columns == ["transcript", "gene", "n_cases", "n_controls"]
    assert df.count() == 20


def test_every_engine_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
