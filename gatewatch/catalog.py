"""Registered queries over the fixture views: one per operator or job of the
inventory (SURVEY section 2). Each takes (spark, sf_dir) and returns a
DataFrame over the whole driver tables. The hit and report queries count and
checkpoint their candidates while the DataFrame is built; the others are lazy.

Standard parameters (FIXTURES.md): list ``ASIA``, run date 2024-01-12.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.functions.columns import vehicle_class_code, vehicle_class_name
from gatewatch.operators.broadcast import interval_cover
from gatewatch.operators.enrich import (
    back_camera_left_join,
    camera_left_join,
    province_lookup,
    rollback_left_join,
    source_union_distinct,
    with_vehicle_class,
)
from gatewatch.operators.invoices import invoice_status_left_join, invoice_union_distinct
from gatewatch.operators.published import exclude_ids
from gatewatch.operators.transactions import (
    filter_window_inclusive,
    filter_windows,
    paid_active,
    scan_gate_txn,
    singleton_groups,
)
from gatewatch.operators.watchlist import WATCHLIST_COLUMNS, watchlist_like_join, watchlist_type_filter
from gatewatch.plans.backfill import run_reports, stale_reports
from gatewatch.plans.completeness import expected_reports, missing_reports
from gatewatch.plans.hits import (
    Candidates,
    HitLimits,
    enrich_candidates,
    hit_ids,
    materialize_and_measure,
    measured_candidates,
    watchlist_hits,
)
from gatewatch.plans.pictures import picture_names, picture_table
from gatewatch.plans.reports import report_columns, report_width_profile
from gatewatch.plans.slots import SLOT_NAMES, excluded_reports, slot_window, slot_windows, calendar_days
from gatewatch.schemas import GATE_TXN, SOURCE_ROW_COLUMNS
from gatewatch.session import stage_path
from gatewatch.sources.fixtures import fixture_tables, stored_ids, stored_pictures, stored_run_records, stored_runs
from gatewatch.sources.report_store import ReportStore
from gatewatch.sources.tables import MEMBER, TollTables, Window

LIST_NAME = "ASIA"
RUN_DATE = date(2024, 1, 12)
URL_PREFIX = "https://pictures.invalid/download/"
LOOKBACK = slot_window("DAY-1", RUN_DATE)  # D-2 00:00:00 .. D 08:00:00
FULL_DAY = slot_window("NIGHT", RUN_DATE)  # D 00:00:00 .. D 16:00:00
OVERNIGHT = Window.parse("2024-01-11 17:00:00", "2024-01-12 11:00:00")

Query = Callable[[SparkSession, str], DataFrame]
GATE_COLUMNS = ["mem_type"] + [f.name for f in GATE_TXN.fields]


def _tables(spark: SparkSession, sf_dir: str) -> TollTables:
    return fixture_tables(spark, sf_dir)


def _gate(t: TollTables, window: Window | None = None) -> DataFrame:
    return scan_gate_txn(t, window).select(*GATE_COLUMNS)


def _source_rows(t: TollTables) -> DataFrame:
    """The 11-column distinct source rows over all time (no window). The wheel
    code travels through the count as its class code: see ``hit_candidates``."""
    gate = _gate(t).withColumn("vehicle_class_code", vehicle_class_code()).drop("vehicle_wheel_code")
    x = paid_active(singleton_groups(gate))
    x = province_lookup(x, t.province_office)
    x = camera_left_join(x, t.camera)
    x = back_camera_left_join(x, t.back_camera)
    return source_union_distinct(x.withColumn("vehicle_class", vehicle_class_name()))


def q_scan_gate_txn(spark, sf_dir):
    return _gate(_tables(spark, sf_dir))


def q_filter_window_inclusive(spark, sf_dir):
    return _gate(_tables(spark, sf_dir), LOOKBACK)


def q_paid_active_txn(spark, sf_dir):
    return paid_active(_gate(_tables(spark, sf_dir)))


def q_singleton_groups(spark, sf_dir):
    return singleton_groups(_gate(_tables(spark, sf_dir)))


def q_province_lookup(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return province_lookup(_gate(t), t.province_office)


def q_camera_left_join(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return camera_left_join(_gate(t), t.camera)


def q_back_camera_left_join(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return back_camera_left_join(_gate(t), t.back_camera)


def q_dead_left_join_dedup(spark, sf_dir):
    # The literal rollback join under a distinct of left-side columns:
    # Catalyst removes the join, leaving a distinct over the scan.
    t = _tables(spark, sf_dir)
    g = _gate(t)
    return rollback_left_join(g, t.invoice_rollback).select(*GATE_COLUMNS).distinct()


def q_vehicle_class_case(spark, sf_dir):
    g = with_vehicle_class(_gate(_tables(spark, sf_dir)))
    return g.select("mem_type", "transaction_id", "vehicle_wheel_code", "vehicle_class")


def q_source_union_distinct(spark, sf_dir):
    return _source_rows(_tables(spark, sf_dir))


def q_invoice_union_distinct(spark, sf_dir):
    return invoice_union_distinct(_tables(spark, sf_dir))


def q_invoice_status_left_join(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return invoice_status_left_join(_source_rows(t), invoice_union_distinct(t))


def q_watchlist_type_filter(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return watchlist_type_filter(t.watchlist_master, t.watchlist_type, LIST_NAME)


def q_watchlist_like_join(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return watchlist_like_join(_source_rows(t), t.watchlist_master).select(
        *SOURCE_ROW_COLUMNS, *[c for c in WATCHLIST_COLUMNS if c not in ("plate1", "plate2", "province")]
    )


def q_first_hit_per_vehicle(spark, sf_dir):
    return watchlist_hits(_tables(spark, sf_dir), None, LIST_NAME)


def q_hits_lookback(spark, sf_dir):
    return watchlist_hits(_tables(spark, sf_dir), LOOKBACK, LIST_NAME)


def q_watchlist_hits(spark, sf_dir):
    return watchlist_hits(_tables(spark, sf_dir), FULL_DAY, LIST_NAME)


def q_hits_overnight(spark, sf_dir):
    return watchlist_hits(_tables(spark, sf_dir), OVERNIGHT, LIST_NAME)


def _run_days(t: TollTables) -> DataFrame:
    return calendar_days(_gate(t))


def q_slot_windows(spark, sf_dir):
    return slot_windows(_run_days(_tables(spark, sf_dir)))


def report_candidates(t: TollTables, slot_name: str, run_date: date) -> tuple[Candidates, DataFrame]:
    """(candidates of the slot's own window, ids its earlier reports listed),
    from one candidate computation over the cover of all windows involved.

    The earlier reports are taken to have run on the same data, so together
    they listed every hit of their windows. Hits are local to their
    transaction time, so those ids are the hit ids of the candidates whose time
    lies in the union of the earlier windows: one filter, not one branch per
    report, and no pictures. They are candidate ids, so the measured candidate
    count bounds them.
    """
    earlier = [slot_window(s, d) for d, s in excluded_reports(slot_name, run_date)]
    own = slot_window(slot_name, run_date)
    c = measured_candidates(t, reduce(Window.cover, earlier, own), LIST_NAME)
    published = hit_ids(t, replace(c, rows=filter_windows(c.rows, earlier)))
    return replace(c, rows=filter_window_inclusive(c.rows, own)), published


def q_published_ids(spark, sf_dir):
    _, published = report_candidates(_tables(spark, sf_dir), "NIGHT", RUN_DATE)
    return published.distinct()


def _report(slot_name: str) -> Query:
    def q(spark, sf_dir):
        t = _tables(spark, sf_dir)
        c, published = report_candidates(t, slot_name, RUN_DATE)
        hits = enrich_candidates(t, c.rows, c.keys, c.watchlist, with_invoices=False)
        fresh = exclude_ids(hits, published, c.keys["transaction_id"].small)
        return report_columns(fresh, RUN_DATE, slot_name, URL_PREFIX)

    q.__name__ = f"q_report_{slot_name}"
    return q


def q_report_columns(spark, sf_dir):
    hits = watchlist_hits(_tables(spark, sf_dir), LOOKBACK, LIST_NAME, with_invoices=False)
    return report_columns(hits, RUN_DATE, "DAY-1", URL_PREFIX)


def q_report_width_profile(spark, sf_dir):
    return report_width_profile(watchlist_hits(_tables(spark, sf_dir), LOOKBACK, LIST_NAME, with_invoices=False))


def q_picture_names(spark, sf_dir):
    return picture_names(_tables(spark, sf_dir).watchlist_master)


def q_expected_reports(spark, sf_dir):
    return expected_reports(_run_days(_tables(spark, sf_dir)), LIST_NAME)


def q_rollback_left_join(spark, sf_dir):
    # The join alone: a plate with several rollback rows gives several rows.
    t = _tables(spark, sf_dir)
    return rollback_left_join(_gate(t), t.invoice_rollback).select(*GATE_COLUMNS)


def q_missing_reports(spark, sf_dir):
    expected = expected_reports(_run_days(_tables(spark, sf_dir)), LIST_NAME)
    return missing_reports(expected, stored_runs(spark, sf_dir), LIST_NAME)


def q_fresh_against_stored(spark, sf_dir):
    hits = watchlist_hits(_tables(spark, sf_dir), LOOKBACK, LIST_NAME)
    return exclude_ids(hits, stored_ids(spark, sf_dir))


def q_picture_scale(spark, sf_dir):
    return picture_table(picture_names(_tables(spark, sf_dir).watchlist_master), stored_pictures(spark, sf_dir))


def q_stale_reports(spark, sf_dir):
    return stale_reports(stored_run_records(spark, sf_dir))


def _day_in_store(spark: SparkSession, sf_dir: str) -> ReportStore:
    """A new store, under the shared checkpoint folder, with the four reports
    of the run date."""
    store = ReportStore(spark, stage_path(spark, "reports"))
    nodes = [(RUN_DATE, s) for s in SLOT_NAMES]
    run_reports(_tables(spark, sf_dir), store, nodes, LIST_NAME, URL_PREFIX)
    return store


def q_stored_reports(spark, sf_dir):
    return _day_in_store(spark, sf_dir).reports()


def q_report_of_id(spark, sf_dir):
    # Which report listed each member transaction.
    ids = _tables(spark, sf_dir).transactions(MEMBER).select("transaction_id")
    return _day_in_store(spark, sf_dir).find(ids)


def q_camera_lookup_reduced(spark, sf_dir):
    # The lookback window's member ids, with the first and the last id of the
    # table as outliers, which stretch one range over all cameras.
    t = _tables(spark, sf_dir)
    own = paid_active(t.transactions(MEMBER, LOOKBACK)).select("transaction_id")
    ends = t.transactions(MEMBER).agg(F.min("transaction_id").alias("lo"), F.max("transaction_id").alias("hi"))
    ids = own.union(ends.select(F.explode(F.array("lo", "hi"))))
    ids, keys = materialize_and_measure(ids, ["transaction_id"], HitLimits())
    k = keys["transaction_id"]
    k = replace(k, cover=interval_cover(ids, "transaction_id", k.lo, k.hi))
    return k.restrict(t.camera[MEMBER], "transaction_id")


QUERIES: dict[str, Query] = {
    "stale_reports": q_stale_reports,
    "stored_reports": q_stored_reports,
    "report_of_id": q_report_of_id,
    "camera_lookup_reduced": q_camera_lookup_reduced,
    "rollback_left_join": q_rollback_left_join,
    "missing_reports": q_missing_reports,
    "fresh_against_stored": q_fresh_against_stored,
    "picture_scale": q_picture_scale,
    "scan_gate_txn": q_scan_gate_txn,
    "filter_window_inclusive": q_filter_window_inclusive,
    "paid_active_txn": q_paid_active_txn,
    "singleton_groups": q_singleton_groups,
    "province_lookup": q_province_lookup,
    "camera_left_join": q_camera_left_join,
    "back_camera_left_join": q_back_camera_left_join,
    "dead_left_join_dedup": q_dead_left_join_dedup,
    "vehicle_class_case": q_vehicle_class_case,
    "source_union_distinct": q_source_union_distinct,
    "invoice_union_distinct": q_invoice_union_distinct,
    "invoice_status_left_join": q_invoice_status_left_join,
    "watchlist_type_filter": q_watchlist_type_filter,
    "watchlist_like_join": q_watchlist_like_join,
    "first_hit_per_vehicle": q_first_hit_per_vehicle,
    "hits_lookback": q_hits_lookback,
    "watchlist_hits": q_watchlist_hits,
    "hits_overnight": q_hits_overnight,
    "slot_windows": q_slot_windows,
    "published_ids": q_published_ids,
    "report_day_1": _report("DAY-1"),
    "report_day": _report("DAY"),
    "report_afternoon": _report("AFTERNOON"),
    "report_night": _report("NIGHT"),
    "report_columns": q_report_columns,
    "report_width_profile": q_report_width_profile,
    "picture_names": q_picture_names,
    "expected_reports": q_expected_reports,
}
