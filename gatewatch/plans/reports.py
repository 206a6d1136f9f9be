"""Slot report jobs (JOB4-JOB7), the report projection (PRJ4) and widths (AGG4)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.functions.columns import (
    display_length,
    joined_text,
    text_or_empty,
    timestamp_text,
    url_or_empty,
)
from gatewatch.operators.broadcast import bounded_broadcast
from gatewatch.operators.published import exclude_ids
from gatewatch.plans.hits import HitLimits, watchlist_hits
from gatewatch.plans.slots import excluded_reports, slot, slot_window
from gatewatch.schemas import REPORT_COLUMNS
from gatewatch.sources.report_store import ReportStore
from gatewatch.sources.tables import TollTables

# The report's header labels (display text). Their lengths are
# the lower bound of each column's display width.
HEADER_LABELS = {
    "transaction_id": "Transaction ID",
    "transaction_time": "วันที่",
    "plate": "ป้ายทะเบียน",
    "province": "จังหวัด",
    "vehicle_class": "ประเภทของรถ",
    "user_type": "ประเภทของผู้ใช้รถ",
    "correct_plate": "ป้ายที่เบียนที่ถูกต้อง",
}


def exclude_published(
    hits: DataFrame, published: DataFrame, limits: HitLimits = HitLimits(), bound: int | None = None
) -> DataFrame:
    """Hits whose id no earlier report listed (NULL-safe left anti join).
    ``bound`` is a known upper bound on the published rows; without one they
    are counted before deciding to broadcast them."""
    if bound is None:
        _, small = bounded_broadcast(published.select("transaction_id"), limits.candidate_rows, "published ids")
    else:
        small = bound <= limits.candidate_rows
    return exclude_ids(hits, published, small)


def report_columns(hits: DataFrame, report_date: date, slot_name: str, url_prefix: str) -> DataFrame:
    """One report row per hit (PRJ4, FN7-FN9): NULL text as '', joined plates,
    picture URLs only for non-empty paths."""
    return hits.select(
        F.lit(report_date).alias("report_date"),
        F.lit(slot_name).alias("slot"),
        F.col("transaction_id"),
        text_or_empty(timestamp_text("transaction_date")).alias("transaction_time"),
        joined_text("vehicle_license_1", "vehicle_license_2").alias("plate"),
        text_or_empty("description").alias("province"),
        text_or_empty("vehicle_class").alias("vehicle_class"),
        text_or_empty("mem_type").alias("user_type"),
        text_or_empty("img_body").alias("body_key"),
        text_or_empty("img_plate").alias("plate_key"),
        text_or_empty("img_back").alias("back_key"),
        joined_text("plate1_origin", "plate2_origin", "province_origin").alias("correct_plate"),
        url_or_empty("body_path_pic", url_prefix).alias("body_url"),
        url_or_empty("plate_path_pic", url_prefix).alias("plate_url"),
        url_or_empty("back_path_pic", url_prefix).alias("back_url"),
    ).select(*REPORT_COLUMNS)


def report_width_profile(hits: DataFrame) -> DataFrame:
    """Display width per report column in one aggregation pass (AGG4).

    Width = longest printed value (NULL prints as 'None', a missing time as
    'NaT'; 0 for an empty report), at least the header's length. The plate
    width adds the longest of each part; the correct-plate width adds three.
    """

    def longest(c, null_text: str = "None"):
        return F.coalesce(F.max(display_length(c, null_text)), F.lit(0))

    def width(name: str, expr):
        return F.greatest(expr, F.lit(len(HEADER_LABELS[name]))).cast("bigint").alias(f"width_{name}")

    return hits.agg(
        width("transaction_id", longest("transaction_id")),
        width("transaction_time", longest(timestamp_text("transaction_date"), "NaT")),
        width("plate", longest("vehicle_license_1") + longest("vehicle_license_2")),
        width("province", longest("description")),
        width("vehicle_class", longest("vehicle_class")),
        width("user_type", longest("mem_type")),
        width(
            "correct_plate",
            longest("plate1_origin") + longest("plate2_origin") + longest("province_origin"),
        ),
    )


def publish(
    hits: DataFrame,
    store: ReportStore,
    slot_name: str,
    run_date: date,
    list_name: str,
    url_prefix: str,
    limits: HitLimits = HitLimits(),
) -> int:
    """Write the hits of a slot's window, minus the ids that the slot's earlier
    reports published, as the slot's report. Returns the row count (0 still
    records a run)."""
    s = slot(slot_name)
    after = store.last_number(list_name, run_date, s.name)
    published, bound = store.published(list_name, excluded_reports(s.name, run_date))
    fresh = exclude_published(hits, published, limits, bound=bound)
    return store.write(report_columns(fresh, run_date, s.name, url_prefix), list_name, run_date, s.name, after)


def build_report(
    tables: TollTables,
    store: ReportStore,
    slot_name: str,
    run_date: date,
    list_name: str,
    url_prefix: str,
    limits: HitLimits = HitLimits(),
) -> int:
    """Run one slot for one date: the hits of its window, published."""
    hits = watchlist_hits(tables, slot_window(slot_name, run_date), list_name, limits, with_invoices=False)
    return publish(hits, store, slot_name, run_date, list_name, url_prefix, limits)
