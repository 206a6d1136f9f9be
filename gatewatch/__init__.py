"""gatewatch: watchlist hits and incremental toll-gate reports on Spark.

The public entry points are re-exported here; everything is a lazy
DataFrame transformation except the measured steps (counts, checkpoints)
and the report store writes.
"""

from gatewatch.plans.completeness import expected_reports, missing_reports
from gatewatch.plans.hits import HitLimits, compute_hits, hits_by_window, watchlist_hits
from gatewatch.plans.reports import (
    build_report,
    exclude_published,
    report_columns,
    report_width_profile,
)
from gatewatch.plans.slots import SLOTS, slot_window, slot_windows
from gatewatch.sources.fixtures import fixture_tables
from gatewatch.sources.jdbc import tables_from_jdbc
from gatewatch.sources.report_store import ReportStore
from gatewatch.sources.tables import (
    TollTables,
    Window,
    tables_from_frames,
    tables_from_parquet,
)

__all__ = [
    "HitLimits",
    "ReportStore",
    "SLOTS",
    "TollTables",
    "Window",
    "build_report",
    "compute_hits",
    "exclude_published",
    "expected_reports",
    "fixture_tables",
    "hits_by_window",
    "missing_reports",
    "report_columns",
    "report_width_profile",
    "slot_window",
    "slot_windows",
    "tables_from_frames",
    "tables_from_jdbc",
    "tables_from_parquet",
    "watchlist_hits",
]
