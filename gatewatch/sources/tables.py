"""The input tables of the hit query and how to scan them.

``TollTables`` is a plain bundle of DataFrames. The three gate transaction
tables are held as *scans*: callables that take an optional time window and
may use it to prune at the source (Parquet row groups, partition folders,
JDBC range predicates). The exact inclusive window predicate is always applied
afterwards by ``operators.transactions.filter_window_inclusive``, so a scan
only has to return a superset of the window's rows.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The three transaction kinds and their tag in the output
# (the spelling "ILLIGAL" is the data value the reports carry).
MEMBER = "MEMBER"
NON_MEMBER = "NON-MEMBER"
ILLEGAL = "ILLIGAL"
MEM_TYPES = (MEMBER, NON_MEMBER, ILLEGAL)


@dataclass(frozen=True)
class Window:
    """A transaction-time window, inclusive at both ends, second precision."""

    lo: datetime
    hi: datetime

    @staticmethod
    def parse(lo: str, hi: str) -> "Window":
        fmt = "%Y-%m-%d %H:%M:%S"
        return Window(datetime.strptime(lo, fmt), datetime.strptime(hi, fmt))

    def lo_lit(self) -> Column:
        return ts_literal(self.lo)

    def hi_lit(self) -> Column:
        return ts_literal(self.hi)

    def cover(self, other: "Window") -> "Window":
        return Window(min(self.lo, other.lo), max(self.hi, other.hi))


def merge_windows(windows) -> list[Window]:
    """The union of inclusive second-precision windows as disjoint windows,
    sorted; windows that overlap or touch (next second) are merged."""
    out: list[Window] = []
    for w in sorted(windows, key=lambda w: w.lo):
        if out and w.lo <= out[-1].hi + timedelta(seconds=1):
            out[-1] = out[-1].cover(w)
        else:
            out.append(w)
    return out


def ts_literal(value: datetime) -> Column:
    """A time-zone-free timestamp literal (folded to a constant by Catalyst)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


GateScan = Callable[["Window | None"], DataFrame]


@dataclass(frozen=True)
class TollTables:
    """All inputs of the hit query, keyed the way the operators use them."""

    gate: Mapping[str, GateScan]
    camera: Mapping[str, DataFrame]
    province_office: DataFrame
    back_camera: DataFrame
    invoice_rollback: DataFrame
    member_invoice: DataFrame
    member_invoice_detail: DataFrame
    nonmember_invoice: DataFrame
    nonmember_invoice_detail: DataFrame
    watchlist_master: DataFrame
    watchlist_type: DataFrame
    extra: Mapping[str, DataFrame] = field(default_factory=dict)

    def transactions(self, mem_type: str, window: Window | None = None) -> DataFrame:
        return self.gate[mem_type](window)

    @property
    def spark(self) -> SparkSession:
        return self.province_office.sparkSession


# Logical table names (the keys the loaders expect).
GATE_TABLES = {MEMBER: "member_txn", NON_MEMBER: "nonmember_txn", ILLEGAL: "illegal_txn"}
CAMERA_TABLES = {MEMBER: "member_camera", NON_MEMBER: "nonmember_camera", ILLEGAL: "illegal_camera"}
OTHER_TABLES = (
    "province_office",
    "back_camera",
    "invoice_rollback",
    "member_invoice",
    "member_invoice_detail",
    "nonmember_invoice",
    "nonmember_invoice_detail",
    "watchlist_master",
    "watchlist_type",
)


def tables_from_frames(frames: Mapping[str, DataFrame], day_column: str | None = None) -> TollTables:
    """Bundle DataFrames keyed by logical name (see ``GATE_TABLES`` etc.).

    The gate tables must carry a bare ``transaction_date`` column, so the
    window predicate reaches the Parquet scan as a pushed filter. If they are
    also partitioned by a date column (``day_column``), the scan adds a
    predicate on it so whole day folders are pruned.
    """

    def gate_scan(df: DataFrame) -> GateScan:
        def scan(window: Window | None) -> DataFrame:
            if window is None:
                return df
            out = df.where(F.col("transaction_date").between(window.lo_lit(), window.hi_lit()))
            if day_column:
                out = out.where(
                    F.col(day_column).between(F.lit(window.lo.date()), F.lit(window.hi.date()))
                )
            return out

        return scan

    return TollTables(
        gate={kind: gate_scan(frames[name]) for kind, name in GATE_TABLES.items()},
        camera={kind: frames[name] for kind, name in CAMERA_TABLES.items()},
        **{name: frames[name] for name in OTHER_TABLES},
    )


def tables_from_parquet(spark: SparkSession, root: str, day_column: str | None = None) -> TollTables:
    """Tables stored as ``{root}/{logical_name}`` Parquet folders."""
    names = list(GATE_TABLES.values()) + list(CAMERA_TABLES.values()) + list(OTHER_TABLES)
    frames = {name: spark.read.parquet(f"{root}/{name}") for name in names}
    return tables_from_frames(frames, day_column)
