"""Window arithmetic used by the report exclusions."""

from __future__ import annotations

from datetime import datetime, timedelta

from gatewatch.operators.transactions import filter_windows
from gatewatch.sources.tables import Window, merge_windows


def w(lo: str, hi: str) -> Window:
    return Window.parse(f"2024-01-12 {lo}", f"2024-01-12 {hi}")


def test_merge_windows():
    assert merge_windows([]) == []
    # nested and overlapping merge; order of input does not matter
    assert merge_windows([w("00:00:00", "14:00:00"), w("00:00:00", "11:00:00"), w("10:00:00", "16:00:00")]) == [
        w("00:00:00", "16:00:00")
    ]
    # touching at the next second merges (inclusive second-precision bounds)
    assert merge_windows([w("08:00:01", "09:00:00"), w("00:00:00", "08:00:00")]) == [w("00:00:00", "09:00:00")]
    # a gap of two seconds stays apart
    assert merge_windows([w("00:00:00", "08:00:00"), w("08:00:02", "09:00:00")]) == [
        w("00:00:00", "08:00:00"),
        w("08:00:02", "09:00:00"),
    ]


def test_filter_windows_keeps_the_union(spark):
    base = datetime(2024, 1, 12)
    times = [base + timedelta(minutes=30 * i) for i in range(40)]
    df = spark.createDataFrame([(t,) for t in times], "transaction_date timestamp_ntz")
    windows = [w("01:00:00", "03:00:00"), w("02:00:00", "04:00:00"), w("10:00:00", "10:30:00")]
    got = sorted(r.transaction_date for r in filter_windows(df, windows).collect())
    want = sorted(t for t in times if any(x.lo <= t <= x.hi for x in windows))
    assert got == want
    assert filter_windows(df, []).count() == 0
