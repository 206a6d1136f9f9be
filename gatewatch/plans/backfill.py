"""Running and re-running reports over several dates, in dependency order.

A report leaves out what its slot's earlier reports listed, so the reports form
a graph: (date, slot) depends on ``excluded_reports(slot, date)``. A range of
dates is run in topological order of that graph. When a report is run again,
those that left out its former rows were built on something that is no more:
they are stale until they are run again. That is not written down anywhere, it
follows from the run records: a report is stale if one that it depends on has
the later run.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from datetime import date, timedelta
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.operators.transactions import filter_window_inclusive
from gatewatch.plans.hits import HitLimits, enrich_candidates, measured_candidates
from gatewatch.plans.reports import publish
from gatewatch.plans.slots import SLOT_NAMES, SLOTS, excluded_reports, slot_window
from gatewatch.sources.report_store import ReportStore
from gatewatch.sources.tables import TollTables, Window

Node = tuple[date, str]
CHUNK_DAYS = 7  # days whose hits are computed together


def run_order(nodes: Iterable[Node]) -> list[Node]:
    """The reports in an order in which each comes after all it depends on;
    among those that are ready, by date and slot."""
    wanted = set(nodes)
    graph = TopologicalSorter({(d, s): [n for n in excluded_reports(s, d) if n in wanted] for d, s in wanted})
    graph.prepare()
    out: list[Node] = []
    while graph.is_active():
        ready = sorted(graph.get_ready(), key=lambda n: (n[0], SLOT_NAMES.index(n[1])))
        out += ready
        graph.done(*ready)
    return out


def reports_between(first: date, last: date) -> list[Node]:
    """All reports from ``first`` to ``last``, in run order."""
    days = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    return run_order((d, s) for d in days for s in SLOT_NAMES)


def dependents(report_date: date, slot_name: str) -> list[Node]:
    """The reports that leave out what this one lists, in run order."""
    later = [(report_date + timedelta(days=back), s.name) for s in SLOTS for back, name in s.excludes if name == slot_name]
    return run_order(later)


def stale_reports(runs: DataFrame) -> DataFrame:
    """``list_name, report_date, slot, newer_date, newer_slot`` for each report
    and each report it depends on that has the later run. ``runs`` are the last
    records: ``list_name, report_date, slot, run_id``; run ids sort by time.
    One join of the records with themselves, on their whole key."""
    needs = F.array(*[F.struct(F.lit(s.name).alias("slot"), F.lit(back).alias("back"), F.lit(name).alias("name")) for s in SLOTS for back, name in s.excludes])
    own = runs.select("list_name", "report_date", "slot", "run_id", F.explode(F.filter(needs, lambda x: x["slot"] == F.col("slot"))).alias("need"))
    own = own.select("list_name", "report_date", "slot", "run_id", F.date_sub("report_date", F.col("need.back")).alias("newer_date"), F.col("need.name").alias("newer_slot"))
    other = runs.select("list_name", F.col("report_date").alias("newer_date"), F.col("slot").alias("newer_slot"), F.col("run_id").alias("newer_run"))
    both = own.join(other, ["list_name", "newer_date", "newer_slot"])
    return both.where("newer_run > run_id").select("list_name", "report_date", "slot", "newer_date", "newer_slot")


def _chunks(nodes: list[Node], days: int) -> Iterator[list[Node]]:
    """Runs of nodes of at most ``days`` consecutive dates; any order that puts
    dates in turn is a run order, as no report depends on a later date."""
    chunk: list[Node] = []
    for node in sorted(nodes, key=lambda n: n[0]):
        if chunk and (node[0] - chunk[0][0]).days >= days:
            yield run_order(chunk)
            chunk = []
        chunk.append(node)
    if chunk:
        yield run_order(chunk)


def run_reports(
    tables: TollTables,
    store: ReportStore,
    nodes: Iterable[Node],
    list_name: str,
    url_prefix: str,
    limits: HitLimits = HitLimits(),
    chunk_days: int = CHUNK_DAYS,
) -> dict[Node, int]:
    """Run the given reports in dependency order and return their row counts.

    The windows of a day's reports overlap, and two of the three days of a
    DAY-1 window are in its neighbours': the candidates of ``chunk_days`` days
    are found once, over the cover of their windows, and each report filters
    its own window, which is exact as every step is keyed by transaction time.
    Each report is committed by itself, so a run that breaks off leaves a store
    that the same call completes.
    """
    counts: dict[Node, int] = {}
    for chunk in _chunks(list(nodes), chunk_days):
        windows = {n: slot_window(n[1], n[0]) for n in chunk}
        c = measured_candidates(tables, reduce(Window.cover, windows.values()), list_name, limits)
        hits = enrich_candidates(tables, c.rows, c.keys, c.watchlist, with_invoices=False, limits=limits)
        for day, name in chunk:
            own = filter_window_inclusive(hits, windows[day, name])
            counts[day, name] = publish(own, store, name, day, list_name, url_prefix, limits)
    return counts


def stale_nodes(store: ReportStore, list_name: str, first: date, last: date) -> list[Node]:
    """The stale reports of a list and date range, in run order."""
    runs = store.runs().where((F.col("list_name") == list_name) & F.col("report_date").between(first - timedelta(days=_reach()), last))
    found = stale_reports(runs).where(F.col("report_date") >= first).select("report_date", "slot").distinct().collect()
    return run_order((r.report_date, r.slot) for r in found)


def _reach() -> int:
    """How many days back a report's dependencies go."""
    return max(back for s in SLOTS for back, _ in s.excludes)


def missing_nodes(store: ReportStore, list_name: str, first: date, last: date) -> list[Node]:
    """The reports of a list and date range that no run has recorded."""
    runs = store.runs().where((F.col("list_name") == list_name) & F.col("report_date").between(first, last))
    there = {(r.report_date, r.slot) for r in runs.select("report_date", "slot").collect()}
    return [n for n in reports_between(first, last) if n not in there]


def rerun(
    tables: TollTables,
    store: ReportStore,
    first: date,
    last: date,
    list_name: str,
    url_prefix: str,
    limits: HitLimits = HitLimits(),
) -> dict[Node, int]:
    """Run what is missing or stale in a date range until nothing is. A report
    that is run again makes its dependents stale, but those come later in run
    order, so one pass over what is stale and all its dependents settles it."""
    todo = {*missing_nodes(store, list_name, first, last), *stale_nodes(store, list_name, first, last)}
    there = {(r.report_date, r.slot) for r in store.runs().where(F.col("list_name") == list_name).select("report_date", "slot").collect()}
    for node in reports_between(first, last):
        if node in todo:
            todo |= {n for n in dependents(*node) if n[0] <= last and (n in there or n in todo)}
    return run_reports(tables, store, todo, list_name, url_prefix, limits)
