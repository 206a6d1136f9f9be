"""LIKE with a column pattern, joined by the pattern's class."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from gatewatch.operators.broadcast import bounded_broadcast
from gatewatch.operators.watchlist import WATCHLIST_COLUMNS, pattern_key, value_keys, watchlist_like_join


def like(value, pattern):
    if value is None or pattern is None:
        return False
    return re.fullmatch("".join({"%": ".*", "_": "."}.get(c) or re.escape(c) for c in pattern), value, re.S) is not None


VALUES = [None, "", "N", "NATION_1", "NATION_12", "NATIO", "nation_1", "กรุงเทพมหานคร", "a%b", "a\\b", "NATI", "x\ny", "=NATI", "^", "*"]
PATTERNS = [None, "", "%", "_", "NATION_1", "NATION_1%", "NATI%", "NAT%", "%1", "กรุงเทพ%", "กรุงเทพมหานคร", "a%b", "a\\b", "NATION!_1", "NATI", "____", "N", "x_y", "=NATI", "^", "*", "NATION%2"]


def frames(spark, values, patterns, plates=("A",)):
    rows = [(i, p, "1", v) for i, (p, v) in enumerate((p, v) for p in plates for v in values)]
    df = spark.createDataFrame(rows, "transaction_id long, vehicle_license_1 string, vehicle_license_2 string, description string")
    wl = spark.createDataFrame([(p, "1", x, str(k)) for k, (p, x) in enumerate((p, x) for p in plates for x in patterns)], "plate1 string, plate2 string, province string, model string")
    return df, wl.select(*[F.col(c) if c in wl.columns else F.lit(None).cast("string").alias(c) for c in WATCHLIST_COLUMNS])


@pytest.mark.parametrize("small", [True, False])
def test_join_equals_like_on_all_pairs(spark, small):
    df, wl = frames(spark, VALUES, PATTERNS, ("A", "B"))
    want = sorted((d.transaction_id, w.model) for d in df.collect() for w in wl.collect() if d.vehicle_license_1 == w.plate1 and like(d.description, w.province))
    found = watchlist_like_join(df, wl, small)
    assert found.columns == [*df.columns, *[c for c in WATCHLIST_COLUMNS if c not in ("plate1", "plate2", "province")]]
    assert sorted((r.transaction_id, r.model) for r in found.collect()) == want


@pytest.mark.parametrize("seed", range(3))
def test_random_patterns(spark, seed):
    r = random.Random(seed)
    text = lambda a, n: "".join(r.choice(a) for _ in range(r.randrange(n)))
    df, wl = frames(spark, [text("ab", 9) for _ in range(150)], [text("aab%_", 8) for _ in range(150)])
    want = sorted((d.transaction_id, w.model) for d in df.collect() for w in wl.collect() if like(d.description, w.province))
    assert sorted((x.transaction_id, x.model) for x in watchlist_like_join(df, wl, True).collect()) == want


def test_patterns_of_one_plate_meet_few_values(spark):
    """3,000 patterns and 400 transactions of one plate: by plate alone, 1.2
    million pairs; by key, one for each value but for the few general patterns."""
    patterns = [f"PROVINCE {i}" for i in range(2990)] + [f"P{i}%" for i in range(10)]
    df, wl = frames(spark, [f"PROVINCE {i}" for i in range(400)], patterns)
    keys = df.select("*", F.explode(value_keys(F.col("description"))).alias("k"))
    met = keys.join(wl.select(pattern_key(F.col("province")).alias("k")), "k").count()
    assert met == 400 + 400 * 10
    found = watchlist_like_join(df, wl, True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"BroadcastHashJoin \[vehicle_license_1#\d+, vehicle_license_2#\d+, _value_key#\d+\]", plan)
    assert found.count() == 400


def test_broadcast_is_bounded_in_bytes(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 10_000).alias("t"))
    assert bounded_broadcast(wide, 1000)[1] and not bounded_broadcast(wide, 1000, max_bytes=1_000_000)[1]
    assert bounded_broadcast(wide, 1000, max_bytes=2_000_000)[1] and not bounded_broadcast(wide, 99)[1]
    assert bounded_broadcast(wide.where("false"), 0, max_bytes=0)[1]
