"""Reducing large tables: interval covers of key sets, singleton groups of text."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F
from test_store import scanned_rows

from gatewatch.operators.broadcast import KeySet, interval_cover, measure_keys
from gatewatch.operators.transactions import singleton_groups


@pytest.mark.parametrize("seed", range(4))
def test_cover_holds_every_key_and_leaves_wide_gaps_open(spark, seed):
    r = random.Random(seed)
    keys = [r.randrange(10**6) + 10**9 * r.randrange(5) for _ in range(300)] + [-(2**62), 2**62]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k long")
    cover = interval_cover(df, "k", min(keys), max(keys), bins=64, intervals=8)
    assert 1 <= len(cover) <= 8 and all(a <= b for a, b in cover) and all(b < c for (_, b), (c, _) in zip(cover, cover[1:]))
    assert all(any(a <= k <= b for a, b in cover) for k in keys)
    assert sum(b - a for a, b in cover) < 10**11  # of 2**63


def test_cover_of_text_and_of_nothing(spark):
    keys = ["A%03d" % i for i in range(500)] + ["B900", "Z", "ü1"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    cover = interval_cover(df, "k", min(keys), max(keys))
    assert 1 < len(cover) <= 32 and all(any(a <= k <= b for a, b in cover) for k in keys)
    assert not any(a <= "F" <= b for a, b in cover)
    assert interval_cover(df.where("false"), "k", None, None) == ()


def camera_files(spark, path, convert=lambda c: c):
    """20 files of 500 rows each, ids in file order."""
    df = spark.range(10_000).select(convert(F.col("id")).alias("transaction_id"), F.concat(F.lit("body/"), "id").alias("body_path_pic"))
    df.repartitionByRange(20, "transaction_id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("text", [False, True])
def test_one_outlier_leaves_most_row_groups_out(spark, scratch, text):
    convert = (lambda c: F.lpad(c.cast("string"), 8, "0")) if text else (lambda c: c)
    cameras = camera_files(spark, os.path.join(scratch, "cameras"), convert)
    ids = [3, *range(9000, 9400, 4), 2**40]
    rows = [(("%08d" % i)[:8] if text else i,) for i in ids]
    keys = measure_keys(spark.createDataFrame(rows, "transaction_id " + ("string" if text else "long")).coalesce(1), ["transaction_id"], 1000)["transaction_id"]
    assert len(keys.cover) >= 2
    found = keys.restrict(cameras, "transaction_id")
    got = sorted(int(r.transaction_id) for r in found.collect())
    assert got == [3, *range(9000, 9400, 4)]
    assert scanned_rows(found) <= 2000
    one = KeySet(keys.rows, keys.column, keys.count, keys.lo, keys.hi, keys.small)
    wide = one.restrict(cameras, "transaction_id")
    assert sorted(int(r.transaction_id) for r in wide.collect()) == got
    assert scanned_rows(wide) > 5000  # one range reads nearly all files


def test_dense_keys_keep_one_range(spark):
    keys = measure_keys(spark.range(100, 200).toDF("k"), ["k"], 1000)["k"]
    assert keys.cover == () and (keys.lo, keys.hi) == (100, 199)


SINGLE = "mem_type string, transaction_date timestamp_ntz, vehicle_license_1 string, vehicle_license_2 string, vehicle_province int, transaction_id string, note string"


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_singleton_groups_of_text_columns(spark, bound):
    row = lambda i, plate="A", t="2024-01-01 00:00:00", kind="M", p=1, note="n": (kind, t, plate, "1", p, i, note)
    data = [row("a"), row("b"), row("c", "B"), row("d", "B", kind="X"), row("e", "C", note=None), row("f", None), row("g", "D", p=None), row("h", "E", kind=None), row("i", "F", kind=None), row("j", "F", kind=None)]
    df = spark.createDataFrame(data, SINGLE.replace("timestamp_ntz", "string")).withColumn("transaction_date", F.col("transaction_date").cast("timestamp_ntz"))
    found = singleton_groups(df, broadcast_bytes=bound)
    assert found.columns == df.columns
    assert sorted(r.transaction_id for r in found.collect()) == ["c", "d", "e", "h"]
    assert singleton_groups(df.where("false"), broadcast_bytes=bound).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert not bound or "BroadcastHashJoin" in plan
