"""Running and re-running several dates in dependency order."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from conftest import SF001

from gatewatch import fixture_tables
from gatewatch.__main__ import main
from gatewatch.plans.backfill import dependents, missing_nodes, reports_between, rerun, run_order, run_reports, stale_nodes, stale_reports
from gatewatch.plans.reports import build_report
from gatewatch.plans.slots import SLOT_NAMES, excluded_reports
from gatewatch.sources.report_store import ReportStore

DAYS = [date(2024, 1, 10), date(2024, 1, 11), date(2024, 1, 12)]


def rows(store):
    return sorted(tuple(r) for r in store.reports().collect())


def test_run_order_puts_each_report_after_what_it_needs():
    nodes = reports_between(date(2024, 2, 27), date(2024, 3, 2))
    assert len(nodes) == len(set(nodes)) == 20
    for i, (day, slot) in enumerate(nodes):
        assert not set(excluded_reports(slot, day)) & set(nodes[i:])
    assert [s for d, s in nodes if d == date(2024, 2, 29)] == ["DAY-1", "DAY", "AFTERNOON", "NIGHT"]
    assert run_order(reversed(nodes)) == nodes
    assert reports_between(DAYS[1], DAYS[0]) == []


def test_dependents():
    d = DAYS[0]
    assert dependents(d, "DAY") == [(d, "AFTERNOON"), (d, "NIGHT"), (d + timedelta(1), "DAY-1"), (d + timedelta(2), "DAY-1")]
    assert dependents(d, "NIGHT") == [(d + timedelta(1), "DAY-1"), (d + timedelta(2), "DAY-1")]


def test_stale_by_run_ids(spark):
    runs = [("L", DAYS[0], "DAY", "5"), ("L", DAYS[0], "NIGHT", "4"), ("L", DAYS[0], "DAY-1", "1"), ("L", DAYS[2], "DAY-1", "3"), ("M", DAYS[0], "NIGHT", "0")]
    found = stale_reports(spark.createDataFrame(runs, "list_name string, report_date date, slot string, run_id string"))
    assert sorted(tuple(r) for r in found.collect()) == [
        ("L", DAYS[0], "NIGHT", DAYS[0], "DAY"),
        ("L", DAYS[2], "DAY-1", DAYS[0], "DAY"),
        ("L", DAYS[2], "DAY-1", DAYS[0], "NIGHT"),
    ]


@pytest.mark.parametrize("chunk_days", [1, 2, 7])
def test_range_equals_slot_by_slot(spark, scratch, chunk_days):
    tables = fixture_tables(spark, SF001)
    store = ReportStore(spark, f"{scratch}/range")
    nodes = reports_between(DAYS[0], DAYS[-1])
    counts = run_reports(tables, store, reversed(nodes), "ASIA", "p/", chunk_days=chunk_days)
    assert list(counts) == nodes
    # FIXTURES.md: report sizes at sf 0.001
    assert [counts[n] for n in nodes] == [11, 1, 0, 0, 8, 4, 0, 0, 3, 0, 1, 0]
    if chunk_days == 2:
        single = ReportStore(spark, f"{scratch}/single")
        for day, slot in nodes:
            build_report(tables, single, slot, day, "ASIA", "p/")
        assert rows(single) == rows(store)


def test_rerun_marks_and_settles_what_is_stale(spark, scratch):
    tables, store = fixture_tables(spark, SF001), ReportStore(spark, scratch)
    first, last = DAYS[0], DAYS[-1]
    run_reports(tables, store, [n for n in reports_between(first, last) if n != (DAYS[1], "AFTERNOON")], "ASIA", "p/")
    assert stale_nodes(store, "ASIA", first, last) == []
    assert missing_nodes(store, "ASIA", first, last) == [(DAYS[1], "AFTERNOON")]
    before = rows(store)
    build_report(tables, store, "DAY", DAYS[0], "ASIA", "p/")
    marked = [(DAYS[0], "AFTERNOON"), (DAYS[0], "NIGHT"), (DAYS[1], "DAY-1"), (DAYS[2], "DAY-1")]
    assert stale_nodes(store, "ASIA", first, last) == marked
    assert stale_nodes(store, "ASIA", DAYS[2], DAYS[2]) == [(DAYS[2], "DAY-1")]  # its cause lies before the range
    args = ["--store", scratch, "--list", "ASIA", "--from", "2024-01-10", "--to", "2024-01-12"]
    assert main(["stale", *args], spark) == 1
    done = rerun(tables, store, first, last, "ASIA", "p/")
    assert set(marked) <= set(done) and (DAYS[1], "AFTERNOON") in done and (DAYS[0], "DAY-1") not in done and (DAYS[0], "DAY") not in done
    assert stale_nodes(store, "ASIA", first, last) == [] and missing_nodes(store, "ASIA", first, last) == []
    assert main(["stale", *args], spark) == 0
    assert rows(store) == before  # the same data gives the same reports


def test_command_line_range(spark, scratch, capsys):
    args = ["--store", scratch, "--list", "ASIA", "--from", "2024-01-11", "--to", "2024-01-12"]
    tables = ["--tables", f"fixture:{SF001}"]
    assert main(["run", "NIGHT", *args, *tables], spark) == 0
    assert [(r.report_date, r.slot) for r in ReportStore(spark, scratch).runs().orderBy("report_date").collect()] == [(d, "NIGHT") for d in DAYS[1:]]
    assert main(["run", "--only-open", *args, *tables], spark) == 0
    store = ReportStore(spark, scratch)
    assert store.runs().count() == 8 and main(["stale", *args], spark) == 0
    assert {r.slot for r in store.runs().collect()} == set(SLOT_NAMES)
    assert main(["clean", "--store", scratch, "--list", "ASIA"], spark) == 0
    for bad in (["run", "--store", scratch, "--list", "L"], ["stale", "--store", scratch, "--list", "L"], ["run", "A", "--store", "s", "--list", "L", "--from", "2024-01-01"]):
        with pytest.raises(SystemExit):
            main(bad, spark)
