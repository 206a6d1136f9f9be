"""Physical plans of the report job: what must not appear in them."""

from __future__ import annotations

import pytest
from conftest import SF001

from gatewatch.catalog import QUERIES


def plan(spark, name: str) -> str:
    return QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["source_union_distinct", "watchlist_like_join", "invoice_status_left_join"])
def test_singletons_are_counted_by_hash(spark, name):
    assert "SortAggregate" not in plan(spark, name)


def test_published_ids_read_no_pictures(spark):
    assert "path_pic" not in plan(spark, "published_ids")


@pytest.mark.parametrize("name", ["report_day_1", "report_night"])
def test_a_report_is_enriched_once(spark, name):
    assert plan(spark, name).count("Window [row_number()") == 1
