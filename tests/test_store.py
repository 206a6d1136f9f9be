"""The report store: commits, clean-up, order of the files, looking up ids."""

from __future__ import annotations

import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from gatewatch.schemas import REPORT, REPORT_COLUMNS
from gatewatch.sources.report_store import CommitConflict, ReportStore

D = date(2024, 1, 12)


def report(spark, ids, slot="DAY", day=D):
    row = {f.name: F.lit("") for f in REPORT.fields}
    row |= {"transaction_time": F.concat(F.lit("2024-01-12 00:"), F.lpad((F.col("id") % 60).cast("string"), 2, "0"), F.lit(":00"))}
    row |= {"transaction_id": F.col("id"), "report_date": F.lit(day), "slot": F.lit(slot)}
    df = spark.range(ids) if isinstance(ids, int) else spark.createDataFrame([(i,) for i in ids], "id long")
    return df.select(*[row[c].alias(c) for c in REPORT_COLUMNS])


def ids_of(store):
    return sorted(r.transaction_id for r in store.reports().collect())


def run_folders(root):
    return [d for _, dirs, _ in os.walk(os.path.join(root, "reports")) for d in dirs if d.startswith("run_id=")]


def test_one_of_two_interleaved_runs_commits(spark, scratch):
    store = ReportStore(spark, scratch)
    store.write(report(spark, [1]), "L", D, "DAY")
    first, second = (store.last_number("L", D, "DAY") for _ in range(2))  # both begin here
    assert first == second == 1
    store.write(report(spark, [2]), "L", D, "DAY", first)
    with pytest.raises(CommitConflict):
        store.write(report(spark, [3]), "L", D, "DAY", second)
    assert ids_of(store) == [2] and store.published("L", [(D, "DAY")])[1] == 1
    assert len(run_folders(scratch)) == 2  # the loser took its rows away, the superseded run stays
    store.write(report(spark, [4]), "L", D, "DAY")
    assert ids_of(store) == [4]
    assert store.records().count() == 3 and store.runs().count() == 1
    store.write(report(spark, [5], "NIGHT"), "L", D, "NIGHT", 0)  # another slot has numbers of its own
    assert ids_of(store) == [4, 5]


def test_a_record_that_broke_off_is_no_run(spark, scratch):
    store = ReportStore(spark, scratch)
    store.write(report(spark, [1]), "L", D, "DAY")
    folder = os.path.join(scratch, "runs", "list_name=L", "report_date=2024-01-12", "slot=DAY")
    open(os.path.join(folder, "0000000002.json"), "w").close()
    assert ids_of(store) == [1] and store.has_run("L", D, "DAY")
    assert store.last_number("L", D, "DAY") == 2
    store.write(report(spark, [2]), "L", D, "DAY")
    assert ids_of(store) == [2]


def test_clean_deletes_orphans_only(spark, scratch, monkeypatch):
    store = ReportStore(spark, scratch)
    assert store.clean(timedelta(0)) == []  # a store that does not exist
    store.write(report(spark, [1]), "A B", D, "DAY")
    store.write(report(spark, [2]), "A B", D, "DAY")
    with monkeypatch.context() as m:
        m.setattr(store, "_create", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            store.write(report(spark, [3]), "A B", D, "DAY")  # breaks off before its record
    foreign = report(spark, [3]).withColumn("slot", F.lit("NIGHT"))
    with pytest.raises(Exception, match="is not of"):
        store.write(foreign, "A B", D, "DAY")
    assert len(run_folders(scratch)) >= 3
    assert store.clean(timedelta(hours=1)) == []  # it may still be writing
    gone = store.clean(timedelta(0))
    assert len(gone) >= 1 and len(run_folders(scratch)) == 2
    assert ids_of(store) == [2] and store.records().count() == 2


def test_file_names_are_in_report_order(spark, scratch):
    store = ReportStore(spark, scratch)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    try:
        store.write(report(spark, 3000), "L", D, "DAY")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    folder = next(d for d, _, files in os.walk(os.path.join(scratch, "reports")) if any(f.endswith(".parquet") for f in files))
    files = sorted(f for f in os.listdir(folder) if f.endswith(".parquet"))
    assert len(files) > 2
    rows = [(r.transaction_time, r.transaction_id) for f in files for r in spark.read.parquet(os.path.join(folder, f)).collect()]
    assert len(rows) == 3000 and rows == sorted(rows)


def scanned_rows(df) -> int:
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        if "QueryStage" in node.getClass().getName():
            todo.append(node.plan())
        elif "FileSourceScan" in node.getClass().getName() and "parquet" in node.toString().lower():
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_find_reads_only_reports_with_the_id(spark, scratch):
    store = ReportStore(spark, scratch)
    # Ids of all slots have the same range: only the Bloom filters tell them apart.
    for k, slot in enumerate(("DAY-1", "DAY", "AFTERNOON", "NIGHT")):
        store.write(report(spark, range(k, 4000, 4), slot), "L", D, slot)
    store.write(report(spark, range(3, 4000, 4), "NIGHT"), "L", D, "NIGHT")  # a second run of NIGHT
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "transaction_id long")
    found = store.find(ids(1001, 9999, None, 1001))
    assert [tuple(r) for r in found.collect()] == [(1001, "L", D, "DAY")]
    assert scanned_rows(found) <= 1000
    assert sorted(r.slot for r in store.find(ids(3, 4)).collect()) == ["DAY-1", "NIGHT"]
    many = store.find(ids(*range(0, 4000, 2)), listed=10)
    assert sorted(r.transaction_id for r in many.collect()) == list(range(0, 4000, 2))
    assert store.find(ids()).count() == 0
    assert ReportStore(spark, scratch + "/none").find(ids(1)).count() == 0
