"""Every registered query equals its oracle SQL (DuckDB) on the driver tables."""

from __future__ import annotations

import pytest
from conftest import SF001, SF01
from oracle_compare import compare

import __spark_entry__ as E
from gatewatch.catalog import QUERIES

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_sf0001(spark, name):
    res = compare(spark, SF001, [name], verbose=False)[name]
    assert res["match"], res


@pytest.mark.slow
@pytest.mark.parametrize("name", ["hits_lookback", "report_day_1", "report_night", "report_width_profile"])
def test_query_matches_oracle_sf001(spark, name):
    res = compare(spark, SF01, [name], verbose=False)[name]
    assert res["match"], res


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert df.count() == 18  # FIXTURES.md section 2, sf 0.001, D-2 00:00 .. D 08:00
