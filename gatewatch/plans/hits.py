"""The watchlist hit query (JOB1-JOB3): one function, the window is a parameter.

Logical result (what the source SQL computes): within the window, per kind,
keep transactions alone in their (time, plate, province) group that are paid
and not deleted; add province name, camera and back pictures, vehicle class;
distinct; left join invoice status; inner join the named watchlist by plate
and province pattern; keep the first row per (time, plate text, province).

Physical shape chosen here (SURVEY section 4, rewrites R1-R6, R11):

1. The list-filtered watchlist's plate pairs semi-join the windowed
   transactions *before* the singleton count. Legal because both plate parts
   are group keys: a group is kept or dropped whole. With a measured small
   watchlist this is a map-side broadcast filter in the scan stage, so the
   large transaction window is never shuffled.
2. The singleton count is one group-by that counts each group and carries
   ``min()`` of the other columns (a one-row group is its row): partial
   aggregation before the shuffle makes a hot group cheap, and the input is
   read once. The wheel code rides as its integer class code, so the buffer
   is fixed-width and the aggregation is hash-based. Paid/active follow. The candidates are checkpointed to the
   shared checkpoint folder (cuts lineage, survives executor loss).
3. The checkpoint job also measures the candidates (observed metrics):
   count and id ranges. The camera,
   back-camera and invoice-detail tables are reduced to the candidate ids by
   a range predicate pushed to their scans (row groups and files outside the
   range are skipped) and a left semi join, broadcast when the count is within
   bound, so those large tables are never shuffled. The reduced invoice
   details are checkpointed and measured in turn before they reduce the
   invoice headers the same way. The reduced tables meet the candidates in
   joins the planner sizes (AQE makes them broadcasts at runtime when small).
4. The watchlist is broadcast into the final LIKE join only when measured
   small; a larger one is first reduced to the candidates' plates. The
   province and list-type tables are fixed dimensions: the planner broadcasts
   them from their file-size statistics (``autoBroadcastJoinThreshold``); a
   source without statistics (JDBC) gets a shuffle join that AQE can turn into
   a broadcast once the runtime size is known.
5. ``rn = 1`` runs as a window group limit, partial before the shuffle.

Every bound has a shuffle-join fallback beyond it, and the result does not
depend on which path runs (``tests/test_properties.py``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.functions.columns import plate_text, vehicle_class_code, vehicle_class_name
from gatewatch.operators.broadcast import (
    KeySet,
    bounded_broadcast,
    checkpoint_and_measure,
    maybe_broadcast,
    measure_keys,
)
from gatewatch.operators.enrich import (
    back_camera_left_join,
    camera_left_join,
    province_lookup,
    source_union_distinct,
)
from gatewatch.operators.invoices import (
    invoice_status_left_join,
    invoices_for_details,
    reduced_details,
)
from gatewatch.operators.transactions import (
    filter_window_inclusive,
    paid_active,
    scan_gate_txn,
    singleton_groups,
)
from gatewatch.operators.watchlist import (
    WATCHLIST_COLUMNS,
    first_hit_per_vehicle,
    watchlist_like_join,
    watchlist_plates,
    watchlist_type_filter,
)
from gatewatch.schemas import HIT_COLUMNS
from gatewatch.session import ensure_checkpoint_dir
from gatewatch.sources.tables import TollTables, Window

CANDIDATE_COLUMNS = (
    "mem_type",
    "transaction_id",
    "transaction_date",
    "ref_transaction_id",
    "vehicle_license_1",
    "vehicle_license_2",
    "vehicle_province",
    "vehicle_class_code",
)


@dataclass(frozen=True)
class HitLimits:
    """Bounds under which a side is broadcast (measured per run). Watchlist rows
    carry text of any length, so they are bounded in bytes as well; candidate
    ids are of fixed width."""

    watchlist_rows: int = 1_000_000
    watchlist_bytes: int = 256 << 20
    candidate_rows: int = 2_000_000
    checkpoint_candidates: bool = True


@dataclass(frozen=True)
class Watchlist:
    rows: DataFrame
    small: bool


def named_watchlist(tables: TollTables, list_name: str, limits: HitLimits = HitLimits()) -> Watchlist:
    """The watchlist rows of one list, with a measured broadcast decision."""
    wl = watchlist_type_filter(tables.watchlist_master, tables.watchlist_type, list_name)
    _, wl_small = bounded_broadcast(wl.select(*WATCHLIST_COLUMNS), limits.watchlist_rows, "watchlist", limits.watchlist_bytes)
    return Watchlist(wl, wl_small)


def hit_candidates(
    tables: TollTables, window: Window | None, watchlist: Watchlist
) -> DataFrame:
    """Paid, live singleton transactions of watchlisted plates in the window.

    The wheel code is only ever used through the vehicle class, a row
    function, so it is reduced to its integer class code before the count:
    every column the aggregation carries is then fixed-width and Spark plans
    a hash aggregation."""
    txn = scan_gate_txn(tables, window)
    plates = maybe_broadcast(watchlist_plates(watchlist.rows), watchlist.small)
    txn = txn.join(plates, ["vehicle_license_1", "vehicle_license_2"], "left_semi")
    txn = txn.withColumn("vehicle_class_code", vehicle_class_code()).drop("vehicle_wheel_code")
    return paid_active(singleton_groups(txn)).select(*CANDIDATE_COLUMNS)


CANDIDATE_KEYS = ["transaction_id", "ref_transaction_id"]


def materialize_and_measure(
    df: DataFrame, columns: list[str], limits: HitLimits
) -> tuple[DataFrame, dict[str, KeySet]]:
    """Checkpoint and measure in one job; without checkpointing, measure only."""
    if limits.checkpoint_candidates:
        ensure_checkpoint_dir(df.sparkSession)
        return checkpoint_and_measure(df, columns, limits.candidate_rows)
    return df, measure_keys(df, columns, limits.candidate_rows)


def enrich_candidates(
    tables: TollTables,
    cand: DataFrame,
    keys: dict[str, KeySet],
    watchlist: Watchlist,
    with_invoices: bool = True,
    limits: HitLimits = HitLimits(),
) -> DataFrame:
    """Candidates -> 22-column hits (steps 3-5 of the module docstring).

    Without invoices, ``status``/``create_channel`` are NULL. The invoice join
    fans a row out by invoice only, a cross product with the other fan-outs of
    the same id, so it never changes the values of the other columns in the
    chosen row: reports, which do not show it, skip it (R11).
    """
    x = province_lookup(cand, tables.province_office)
    x = camera_left_join(x, tables.camera, ids=keys["transaction_id"])
    x = back_camera_left_join(x, tables.back_camera, refs=keys["ref_transaction_id"])
    x = source_union_distinct(x.withColumn("vehicle_class", vehicle_class_name()))
    if with_invoices:
        details, detail_keys = materialize_and_measure(
            reduced_details(tables, keys["transaction_id"]), ["_inv"], limits
        )
        invoice_nos = detail_keys["_inv"]
        x = invoice_status_left_join(x, invoices_for_details(tables, details, invoice_nos))
    else:
        x = x.withColumn("status", F.lit(None).cast("string")).withColumn(
            "create_channel", F.lit(None).cast("string")
        )
    hits = watchlist_like_join(x, *candidate_watchlist(cand, keys["transaction_id"].small, watchlist))
    return first_hit_per_vehicle(hits).select(*HIT_COLUMNS)


def candidate_watchlist(cand: DataFrame, cand_small: bool, watchlist: Watchlist) -> tuple[DataFrame, bool]:
    """The watchlist side of the final LIKE join. A watchlist too large to
    broadcast is first reduced to the candidates' plate pairs (a broadcast
    semi join when the candidates are measured small), so it is not shuffled
    whole; the reduced rows then meet the candidates in a planner-sized join."""
    if watchlist.small or not cand_small:
        return watchlist.rows, watchlist.small
    plates = F.broadcast(
        cand.select(F.col("vehicle_license_1").alias("_p1"), F.col("vehicle_license_2").alias("_p2"))
    )
    wl = watchlist.rows
    cond = (wl["plate1"] == plates["_p1"]) & (wl["plate2"] == plates["_p2"])
    return wl.join(plates, cond, "left_semi"), False


@dataclass(frozen=True)
class Candidates:
    """Checkpointed candidates of a window, their measured keys, and the
    watchlist they were chosen by."""

    rows: DataFrame
    keys: dict[str, KeySet]
    watchlist: Watchlist


def measured_candidates(
    tables: TollTables, window: Window | None, list_name: str, limits: HitLimits = HitLimits()
) -> Candidates:
    watchlist = named_watchlist(tables, list_name, limits)
    cand, keys = materialize_and_measure(hit_candidates(tables, window, watchlist), CANDIDATE_KEYS, limits)
    return Candidates(cand, keys, watchlist)


def hit_ids(tables: TollTables, c: Candidates) -> DataFrame:
    """The ``transaction_id`` of every hit, without its other columns.

    The first row of a vehicle and moment is the one of the smallest id, and
    pictures and invoices only add columns or fan rows out, so neither they
    nor the distinct are needed: one ``min`` per (time, plate text, province)."""
    x = province_lookup(c.rows, tables.province_office)
    small = c.keys["transaction_id"].small
    x = watchlist_like_join(x, *candidate_watchlist(c.rows, small, c.watchlist))
    first = x.groupBy("transaction_date", plate_text().alias("_plate"), "description")
    return first.agg(F.min("transaction_id").alias("transaction_id")).select("transaction_id")


@dataclass(frozen=True)
class Hits:
    """A hit DataFrame plus a measured bound: the number of candidate
    transactions it was built from. Every hit id is a candidate id, so at most
    ``id_bound`` distinct ids occur in ``rows`` (and in any filter of it)."""

    rows: DataFrame
    id_bound: int
    limits: HitLimits

    @property
    def ids_small(self) -> bool:
        return self.id_bound <= self.limits.candidate_rows


def compute_hits(
    tables: TollTables,
    window: Window | None,
    list_name: str,
    limits: HitLimits = HitLimits(),
    with_invoices: bool = True,
) -> Hits:
    """``watchlist_hits`` with the measured candidate bound kept."""
    c = measured_candidates(tables, window, list_name, limits)
    rows = enrich_candidates(tables, c.rows, c.keys, c.watchlist, with_invoices, limits)
    return Hits(rows, c.keys["transaction_id"].count, limits)


def watchlist_hits(
    tables: TollTables,
    window: Window | None,
    list_name: str,
    limits: HitLimits = HitLimits(),
    with_invoices: bool = True,
) -> DataFrame:
    """Watchlist hits of ``list_name`` with transaction time in ``window``
    (inclusive; ``None`` = all time). 22 columns, ``rn`` always 1."""
    return compute_hits(tables, window, list_name, limits, with_invoices).rows


def hits_by_window(
    tables: TollTables,
    windows: Mapping[str, Window],
    list_name: str,
    limits: HitLimits = HitLimits(),
    with_invoices: bool = True,
) -> tuple[dict[str, DataFrame], Hits]:
    """Hits of several windows from one candidate computation over their cover.

    Exact, not an approximation: every step is local to one transaction
    time. The singleton groups and the first-hit partitions are keyed by
    it, and all joins are row-wise, so hits(W) = hits(U) restricted to W for
    any W inside U. The candidates of the cover are checkpointed once; each
    window's filter is pushed down onto them, so every window reads only its
    own slice.
    """
    cover = reduce(Window.cover, windows.values())
    hits = compute_hits(tables, cover, list_name, limits, with_invoices)
    return {name: filter_window_inclusive(hits.rows, w) for name, w in windows.items()}, hits
