"""Loaders: Parquet tables partitioned by day prune by the window."""

from __future__ import annotations

import os

from conftest import SF001
from pyspark.sql import functions as F

from gatewatch import Window, fixture_tables, watchlist_hits
from gatewatch.operators.transactions import scan_gate_txn
from gatewatch.sources.fixtures import fixture_frames
from gatewatch.sources.tables import GATE_TABLES, tables_from_parquet

W = Window.parse("2024-01-10 00:00:00", "2024-01-12 08:00:00")


def test_day_partitioned_parquet_tables(spark, scratch):
    frames = fixture_frames(spark, SF001)
    for name, df in frames.items():
        if name.startswith("_"):
            continue
        path = os.path.join(scratch, name)
        if name in GATE_TABLES.values():
            df.withColumn("transaction_day", F.to_date("transaction_date")).write.partitionBy(
                "transaction_day"
            ).parquet(path)
        else:
            df.write.parquet(path)

    t = tables_from_parquet(spark, scratch, day_column="transaction_day")
    plan = scan_gate_txn(t, W)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(transaction_day" in plan
    assert "transaction_day#" in plan and "2024-01-10" in plan and "2024-01-12" in plan
    assert "PushedFilters: [IsNotNull(transaction_date), GreaterThanOrEqual(transaction_date" in plan

    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(watchlist_hits(t, W, "ASIA")) == key(watchlist_hits(fixture_tables(spark, SF001), W, "ASIA"))
