"""The report calendar: four slots per run date, their windows and exclusions.

Everything about the schedule lives in ``SLOTS``; the jobs take the run date
as a parameter (never "now").
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.sources.tables import Window


@dataclass(frozen=True)
class Slot:
    name: str
    code: str
    lo_days_back: int  # window starts at 00:00:00 this many days before the run date
    hi_time: time  # window ends (inclusive) at this time on the run date
    excludes: tuple[tuple[int, str], ...]  # (days back, slot name) of reports whose ids are excluded
    folder: str  # report folder kind used in object names
    suffix: str  # object name suffix


# The slot calendar (run order DAY-1, DAY, AFTERNOON, NIGHT).
_ALL = ("DAY-1", "DAY", "AFTERNOON", "NIGHT")
SLOTS = (
    Slot("DAY-1", "C", 2, time(8, 0, 0), tuple((d, s) for d in (2, 1) for s in _ALL), "{list}_1_Day_Ago", "-Day-1"),
    Slot("DAY", "A", 0, time(11, 0, 0), ((0, "DAY-1"),), "{list}", "_Day"),
    Slot("AFTERNOON", "D", 0, time(14, 0, 0), ((0, "DAY"), (0, "DAY-1")), "{list}", "_Afternoon"),
    Slot("NIGHT", "B", 0, time(16, 0, 0), ((0, "DAY-1"), (0, "DAY"), (0, "AFTERNOON")), "{list}", "_Night"),
)
SLOT_BY_NAME = {s.name: s for s in SLOTS}
SLOT_BY_CODE = {s.code: s for s in SLOTS}
SLOT_NAMES = tuple(s.name for s in SLOTS)
# Fixed value: the object name layout of a report.
OBJECT_NAME = "WatchList/{folder}/{date}/{list}_List_{date}{suffix}.xlsx"


def slot(name_or_code: str) -> Slot:
    key = name_or_code.upper()
    if key in SLOT_BY_NAME:
        return SLOT_BY_NAME[key]
    if key in SLOT_BY_CODE:
        return SLOT_BY_CODE[key]
    raise ValueError(f"unknown slot {name_or_code!r}")


def slot_window(name_or_code: str, run_date: date) -> Window:
    s = slot(name_or_code)
    lo = datetime.combine(run_date - timedelta(days=s.lo_days_back), time(0, 0, 0))
    return Window(lo, datetime.combine(run_date, s.hi_time))


def excluded_reports(name_or_code: str, run_date: date) -> list[tuple[date, str]]:
    """(report_date, slot) of the earlier reports whose ids this run excludes."""
    return [(run_date - timedelta(days=d), n) for d, n in slot(name_or_code).excludes]


def object_name(name_or_code: str, run_date: date, list_name: str) -> str:
    s = slot(name_or_code)
    d = run_date.isoformat()
    return OBJECT_NAME.format(folder=s.folder.format(list=list_name), date=d, list=list_name, suffix=s.suffix)


def explode_slots(run_dates: DataFrame, date_col: str = "run_date") -> DataFrame:
    """One row per (run date, slot): a generator over a 4-element literal
    array (no join), carrying each slot's calendar fields."""
    arr = F.array(
        *[
            F.struct(
                F.lit(s.name).alias("slot"),
                F.lit(s.code).alias("slot_code"),
                F.lit(s.lo_days_back).alias("_lo_days"),
                F.lit(s.hi_time.hour).alias("_hi_h"),
                F.lit(s.hi_time.minute).alias("_hi_m"),
                F.lit(s.hi_time.second).alias("_hi_s"),
                F.lit(s.folder).alias("_folder"),
                F.lit(s.suffix).alias("_suffix"),
            )
            for s in SLOTS
        ]
    )
    return run_dates.select(F.col(date_col).alias("run_date"), F.inline(arr))


def slot_windows(run_dates: DataFrame, date_col: str = "run_date") -> DataFrame:
    """(run_date, slot, slot_code, lo, hi) for every run date (FN5, FN13)."""
    x = explode_slots(run_dates, date_col)
    d = F.col("run_date")
    lo_day = F.date_sub(d, F.col("_lo_days"))
    lo = F.make_timestamp_ntz(F.year(lo_day), F.month(lo_day), F.dayofmonth(lo_day), F.lit(0), F.lit(0), F.lit(0))
    hi = F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), F.col("_hi_h"), F.col("_hi_m"), F.col("_hi_s"))
    return x.select("run_date", "slot", "slot_code", lo.alias("lo"), hi.alias("hi"))


def calendar_days(txn: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last transaction, days without
    traffic included: a report is expected for each of them. One partial
    aggregation of two values; no rows give no days."""
    day = F.to_date("transaction_date")
    ends = txn.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return ends.where("lo IS NOT NULL").select(F.explode(F.sequence("lo", "hi")).alias("run_date"))
