"""Report store, slot jobs and the report chain (FIXTURES.md sections 2 and 4)."""

from __future__ import annotations

import os
from datetime import date

import pytest
from conftest import SF001, SF01, make_tables, txn, wl_row

from gatewatch import build_report, fixture_tables, report_columns, report_width_profile, watchlist_hits
from gatewatch.operators.published import exclude_ids
from gatewatch.plans.completeness import expected_reports, missing_reports
from gatewatch.plans.reports import HEADER_LABELS
from gatewatch.plans.slots import SLOT_NAMES, excluded_reports, object_name, slot_window, slot_windows
from gatewatch.schemas import REPORT_COLUMNS
from gatewatch.sources.report_store import ReportStore

PREFIX = "https://pictures.invalid/download/"


def test_missing_store_reads_empty(spark, scratch):
    store = ReportStore(spark, os.path.join(scratch, "nothing-here"))
    assert store.published_ids("ASIA", [(date(2024, 1, 1), "DAY"), (date(2024, 1, 2), "DAY")]).count() == 0
    assert store.runs().count() == 0


def test_null_published_id_does_not_hide_others(spark):
    hits = spark.createDataFrame([(1,), (2,), (None,)], "transaction_id long")
    published = spark.createDataFrame([(1,), (None,)], "transaction_id long")
    got = sorted((r.transaction_id for r in exclude_ids(hits, published).collect()), key=str)
    assert got == [2]
    assert sorted(r.transaction_id for r in exclude_ids(hits, published.where("transaction_id = 9")).collect() if r.transaction_id) == [1, 2]


def test_report_columns_urls_and_empty_text(spark):
    t = make_tables(
        spark,
        member_txn=[txn(1, "2024-01-11 10:00:00")],
        member_camera=[(1, "body/x.png", None)],
        watchlist_master=[wl_row(body=None)],
    )
    from gatewatch import Window, watchlist_hits

    hits = watchlist_hits(t, Window.parse("2024-01-11 00:00:00", "2024-01-11 11:00:00"), "LIST")
    r = report_columns(hits, date(2024, 1, 11), "DAY", PREFIX).collect()[0]
    assert r.body_url == PREFIX + "body/x.png?key="
    assert r.plate_url == "" and r.back_url == ""
    assert r.body_key == "" and r.plate_key == "plate/w.png"
    assert r.plate == "K1 100" and r.correct_plate == "K1 100 ORIGIN"
    assert r.transaction_time == "2024-01-11 10:00:00"
    assert (r.report_date, r.slot) == (date(2024, 1, 11), "DAY")


def test_width_profile_of_empty_report_is_header_lengths(spark):
    t = make_tables(spark)
    from gatewatch import Window, watchlist_hits

    hits = watchlist_hits(t, Window.parse("2024-01-11 00:00:00", "2024-01-11 11:00:00"), "LIST")
    row = report_width_profile(hits).collect()[0].asDict()
    assert row == {f"width_{k}": len(v) for k, v in HEADER_LABELS.items()}


def test_month_edge_windows_and_exclusions():
    d = date(2024, 3, 1)
    w = slot_window("C", d)
    assert str(w.lo) == "2024-02-28 00:00:00" and str(w.hi) == "2024-03-01 08:00:00"
    days = sorted({x for x, _ in excluded_reports("DAY-1", d)})
    assert days == [date(2024, 2, 28), date(2024, 2, 29)]
    assert object_name("C", d, "ASIA") == "WatchList/ASIA_1_Day_Ago/2024-03-01/ASIA_List_2024-03-01-Day-1.xlsx"
    assert object_name("b", d, "ASIA") == "WatchList/ASIA/2024-03-01/ASIA_List_2024-03-01_Night.xlsx"


def test_slot_windows_dataframe_matches_python(spark):
    days = spark.createDataFrame([(date(2024, 3, 1),), (date(2024, 1, 12),)], "run_date date")
    got = {(r.run_date, r.slot): (r.lo, r.hi) for r in slot_windows(days).collect()}
    for (d, s), (lo, hi) in got.items():
        w = slot_window(s, d)
        assert (lo, hi) == (w.lo, w.hi)
    assert len(got) == 8


def test_missing_report_check(spark, scratch):
    store = ReportStore(spark, scratch)
    d = date(2024, 1, 12)
    empty = spark.createDataFrame([], store.reports().schema).select(*REPORT_COLUMNS)
    for s in ("DAY-1", "DAY", "AFTERNOON"):
        assert store.write(empty, "ASIA", d, s) == 0  # an empty report still records its run
    days = spark.createDataFrame([(d,)], "run_date date")
    missing = missing_reports(expected_reports(days, "ASIA"), store.runs(), "ASIA").collect()
    assert [(r.report_date, r.slot) for r in missing] == [(d, "NIGHT")]
    assert missing[0].object_name.endswith("_Night.xlsx")


# Report sizes at sf 0.01 when the slots run DAY-1, DAY, AFTERNOON, NIGHT on
# the 10th, 11th and 12th into an empty store (FIXTURES.md section 2).
EXPECTED_SF001 = {
    date(2024, 1, 10): (83, 7, 9, 2),
    date(2024, 1, 11): (33, 7, 6, 3),
    date(2024, 1, 12): (29, 7, 6, 3),
}


@pytest.mark.slow
def test_report_chain_sizes_and_disjointness(spark, scratch):
    t = fixture_tables(spark, SF01)
    store = ReportStore(spark, scratch)
    for d, expected in EXPECTED_SF001.items():
        got = tuple(build_report(t, store, s, d, "ASIA", PREFIX) for s in SLOT_NAMES)
        assert got == expected, (d, got)
    reports = store.reports()
    assert reports.count() == sum(sum(v) for v in EXPECTED_SF001.values())
    # every id is published once
    assert reports.select("transaction_id").distinct().count() == reports.count()
    runs = {(r.report_date, r.slot): r.row_count for r in store.runs().collect()}
    assert len(runs) == 12
    # the four reports of D together list the hits of the two wide windows
    # (D-2 00:00 .. D 08:00 and D 00:00 .. D 16:00) less the ids published on D-2 and D-1
    d = date(2024, 1, 12)
    wide = set()
    for w in (slot_window("DAY-1", d), slot_window("NIGHT", d)):
        wide |= {r.transaction_id for r in watchlist_hits(t, w, "ASIA").select("transaction_id").collect()}
    earlier = {r.transaction_id for r in reports.where("report_date < DATE'2024-01-12'").select("transaction_id").collect()}
    on_d = {r.transaction_id for r in reports.where("report_date = DATE'2024-01-12'").select("transaction_id").collect()}
    assert on_d == wide - earlier
    # re-running a slot replaces only its own partition and gives the same rows
    before = sorted(r.transaction_id for r in reports.where("slot = 'NIGHT' AND report_date = DATE'2024-01-12'").collect())
    assert build_report(t, store, "NIGHT", date(2024, 1, 12), "ASIA", PREFIX) == 3
    after = sorted(r.transaction_id for r in store.reports().where("slot = 'NIGHT' AND report_date = DATE'2024-01-12'").collect())
    assert before == after
    assert store.reports().count() == sum(sum(v) for v in EXPECTED_SF001.values())


def test_cli_run_and_check(spark, scratch, capsys):
    from gatewatch.__main__ import main

    common = ["--date", "2024-01-12", "--store", scratch, "--list", "ASIA"]
    assert main(["check", "B", *common], spark=spark) == 1
    assert "missing: 2024-01-12 NIGHT" in capsys.readouterr().out
    assert main(["run", "C", *common, "--tables", f"fixture:{SF001}"], spark=spark) == 0
    assert "DAY-1 2024-01-12: 18 rows" in capsys.readouterr().out  # empty store: nothing excluded
    assert main(["check", "C", *common], spark=spark) == 0
    assert main(["check", "night", *common, "--rerun", "--tables", f"fixture:{SF001}"], spark=spark) == 0


def test_csv_export_is_globally_ordered(spark, scratch):
    import csv
    import glob

    store = ReportStore(spark, scratch)
    t = fixture_tables(spark, SF01)
    d = date(2024, 1, 12)
    assert build_report(t, store, "DAY-1", d, "ASIA", PREFIX) == 104  # empty store: the whole window
    out = os.path.join(scratch, "csv")
    store.export_csv("ASIA", d, "DAY-1", out)
    rows = []
    for f in sorted(glob.glob(os.path.join(out, "part-*.csv"))):
        with open(f, newline="") as fh:
            rows += list(csv.DictReader(fh))
    assert len(rows) == 104
    keys = [(r["transaction_time"], int(r["transaction_id"])) for r in rows]
    assert keys == sorted(keys)


def test_representative_drift_reports_again_under_the_new_id(spark, scratch):
    """A late row of another kind with a smaller id becomes the vehicle's
    first hit; it was never published, so a later slot reports it again,
    as the source job does (exclusion is by id)."""
    store = ReportStore(spark, scratch)
    d = date(2024, 1, 12)
    early = make_tables(spark, member_txn=[txn(10, "2024-01-12 09:00:00")], watchlist_master=[wl_row()])
    assert build_report(early, store, "DAY", d, "LIST", PREFIX) == 1
    late = make_tables(
        spark,
        member_txn=[txn(10, "2024-01-12 09:00:00")],
        illegal_txn=[txn(5, "2024-01-12 09:00:00")],
        watchlist_master=[wl_row()],
    )
    assert build_report(late, store, "NIGHT", d, "LIST", PREFIX) == 1
    got = {(r.slot, r.transaction_id) for r in store.reports().collect()}
    assert got == {("DAY", 10), ("NIGHT", 5)}


def test_empty_rerun_empties_the_slot(spark, scratch):
    store = ReportStore(spark, scratch)
    d = date(2024, 1, 12)
    t = make_tables(spark, member_txn=[txn(10, "2024-01-12 09:00:00")], watchlist_master=[wl_row()])
    assert build_report(t, store, "DAY", d, "LIST", PREFIX) == 1
    assert build_report(make_tables(spark), store, "DAY", d, "LIST", PREFIX) == 0
    assert store.reports().count() == 0
    assert [(r.slot, r.row_count) for r in store.runs().collect()] == [("DAY", 0)]


def test_report_chain_same_on_shuffle_paths(spark, scratch):
    """All broadcast bounds at 0: every join, including the exclusion anti
    join, takes its shuffle path; the published reports do not change."""
    from gatewatch import HitLimits

    t = fixture_tables(spark, SF001)
    out = {}
    for name, limits in (("default", HitLimits()), ("tight", HitLimits(watchlist_rows=0, candidate_rows=0))):
        store = ReportStore(spark, os.path.join(scratch, name))
        for d in (date(2024, 1, 11), date(2024, 1, 12)):
            for s in SLOT_NAMES:
                build_report(t, store, s, d, "ASIA", PREFIX, limits)
        out[name] = sorted(tuple(r) for r in store.reports().collect())
    assert out["tight"] == out["default"] and out["default"]


def test_lists_keep_their_own_reports(spark, scratch):
    store, d = ReportStore(spark, scratch), date(2024, 1, 12)
    t = make_tables(spark, member_txn=[txn(10, "2024-01-12 07:00:00")], watchlist_master=[wl_row(list_type=1), wl_row(list_type=2)])
    assert build_report(t, store, "DAY-1", d, "LIST", PREFIX) == 1
    days = spark.createDataFrame([(d,)], "run_date date")
    assert missing_reports(expected_reports(days, "OTHER"), store.runs(), "OTHER").count() == 4
    # The other list has not published the id: its later slot still reports it.
    assert build_report(t, store, "DAY", d, "OTHER", PREFIX) == 1
    assert build_report(t, store, "DAY", d, "LIST", PREFIX) == 0
    assert sorted((r.list_name, r.slot) for r in store.reports().collect()) == [("LIST", "DAY-1"), ("OTHER", "DAY")]


def test_failed_rerun_leaves_the_report(spark, scratch):
    store, d = ReportStore(spark, scratch), date(2024, 1, 12)
    t = make_tables(spark, member_txn=[txn(10, "2024-01-12 09:00:00")], watchlist_master=[wl_row()])
    assert build_report(t, store, "DAY", d, "LIST", PREFIX) == 1
    good = store.reports().select(*REPORT_COLUMNS)
    with pytest.raises(Exception, match="is not of"):
        store.write(good.selectExpr("report_date", "'NIGHT' AS slot", *REPORT_COLUMNS[2:]), "LIST", d, "DAY")
    assert [(r.slot, r.transaction_id) for r in store.reports().collect()] == [("DAY", 10)]
    assert store.published("LIST", [(d, "DAY")])[1] == 1


def test_timestamp_text_has_no_zone(spark):
    from pyspark.sql import functions as F

    from gatewatch.functions.columns import timestamp_text

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00' AS a, TIMESTAMP_NTZ'2024-03-10 02:30:00.0205' AS b")
        assert tuple(df.select(timestamp_text(F.col("a")), timestamp_text(F.col("b"))).first()) == ("2024-03-10 02:30:00", "2024-03-10 02:30:00.020500")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
