"""The report store: published reports as Parquet, run records as JSON.

Layout under ``root`` (any Hadoop path: local, HDFS, ``s3a://``):

- ``reports/list_name=L/report_date=YYYY-MM-DD/slot=NAME/run_id=ID/``: the rows
  that one run wrote (SNK1, SNK2)
- ``runs/list_name=L/report_date=YYYY-MM-DD/slot=NAME/NUMBER.json``: one record
  per committed run, also for an empty report (SNK3)

A run notes the slot's last record number before it reads anything, writes its
rows into a fresh folder, and commits by creating the next number. A record is
created only if it does not exist yet: of two runs of a slot that overlap, one
commits and the other fails and takes its rows away. Of a slot's records the
last one counts. Rows without a record are no report; ``clean`` deletes them
once they are old enough not to belong to a run that is still writing.

Readers name exact folders, so no listing of the whole store is needed (SRC4,
SRC5, SET3); a store that does not exist yet reads as empty. The files of a
report are range-partitioned by time and id, so that their names' order is the
report's order (SRT1, SRT2), and carry a Bloom filter on the transaction id, by
which ``find`` skips the reports that did not list an id.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from datetime import date, timedelta
from urllib.parse import quote, unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatewatch.schemas import REPORT, REPORT_COLUMNS, REPORT_RUNS

Pairs = Iterable[tuple[date, str]]
_STORED = T.StructType([*REPORT.fields, T.StructField("list_name", T.StringType()), T.StructField("run_id", T.StringType())])
_RECORD = T.StructType([T.StructField("number", T.LongType()), *REPORT_RUNS.fields])
_SLOT = ("list_name", "report_date", "slot")
FIND_IDS = 10_000  # ids that go into the scan of ``find`` as a predicate


class CommitConflict(RuntimeError):
    """Another run of the slot has committed since this one began."""


class ReportStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.reports_path = f"{self.root}/reports"
        self.runs_path = f"{self.root}/runs"

    @staticmethod
    def _folder(root: str, list_name: str, report_date: date, slot: str, run_id: str = "") -> str:
        folder = f"{root}/list_name={quote(list_name, safe='')}/report_date={report_date.isoformat()}/slot={slot}"
        return f"{folder}/run_id={run_id}" if run_id else folder

    def _fs(self, path: str):
        """The Hadoop path and its file system."""
        jvm, sc = self.spark.sparkContext._jvm, self.spark.sparkContext
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(sc._jsc.hadoopConfiguration())

    def _create(self, path: str, text: str) -> bool:
        """Create a file that does not exist yet; False if it does."""
        p, fs = self._fs(path)
        try:
            out = fs.create(p, False)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName() or fs.exists(p):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _read(self, base: str, paths: list[str], schema: T.StructType, form: str = "parquet") -> DataFrame:
        """The folders of ``paths`` that exist."""
        there = [path for path in paths if self._exists(path)]
        if not there:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).format(form).load(there).select(*schema.fieldNames())

    def _exists(self, path: str) -> bool:
        p, fs = self._fs(path)
        return fs.exists(p)

    def _latest(self, records: DataFrame) -> DataFrame:
        last = F.max(F.struct("number", "run_id", "row_count")).alias("last")
        named = records.where("run_id IS NOT NULL").groupBy(*_SLOT)
        return named.agg(last).select("last.run_id", "last.row_count", *_SLOT)

    def records(self) -> DataFrame:
        """Every committed run, superseded ones included."""
        found = self._read(self.runs_path, [self.runs_path], _RECORD, "json").where("run_id IS NOT NULL")
        return found.select(*REPORT_RUNS.fieldNames())

    def runs(self) -> DataFrame:
        """The last record of every (list, date, slot)."""
        return self._latest(self._read(self.runs_path, [self.runs_path], _RECORD, "json"))

    def has_run(self, list_name: str, report_date: date, slot: str) -> bool:
        """Whether a slot's report is there; reads that slot's records only."""
        return bool(self._records(list_name, [(report_date, slot)]))

    def last_number(self, list_name: str, report_date: date, slot: str) -> int:
        """Number of the slot's last record, 0 without any, by file name: a
        record that broke off while written takes its number as well."""
        p, fs = self._fs(self._folder(self.runs_path, list_name, report_date, slot))
        if not fs.exists(p):
            return 0
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return max((int(n.partition(".")[0]) for n in names if n.partition(".")[0].isdigit()), default=0)

    def reports(self) -> DataFrame:
        """All committed reports: REPORT columns and ``list_name``."""
        rows = self._read(self.reports_path, [self.reports_path], _STORED)
        return rows.join(self.runs(), [*_SLOT, "run_id"], "left_semi").select(*REPORT.fieldNames(), "list_name")

    def _records(self, list_name: str, pairs: Pairs) -> list:
        """Latest records of the given slots: at most one per pair."""
        paths = [self._folder(self.runs_path, list_name, d, s) for d, s in pairs]
        return self._latest(self._read(self.runs_path, paths, _RECORD, "json")).collect() if paths else []

    def _reports_of(self, records: list) -> DataFrame:
        paths = [self._folder(self.reports_path, r.list_name, r.report_date, r.slot, r.run_id) for r in records]
        if not paths:
            return self.spark.createDataFrame([], _STORED)
        return self._read(self.reports_path, paths, _STORED)

    def published_ids(self, list_name: str, pairs: Pairs) -> DataFrame:
        """Transaction ids of a list's reports of the given (date, slot); a
        missing report contributes nothing."""
        return self._reports_of(self._records(list_name, pairs)).select("transaction_id")

    def published(self, list_name: str, pairs: Pairs) -> tuple[DataFrame, int]:
        """``published_ids`` and how many there are, by the records that name
        the folders read: rows and bound cannot disagree."""
        records = self._records(list_name, pairs)
        return self._reports_of(records).select("transaction_id"), sum(r.row_count for r in records)

    def write(self, report: DataFrame, list_name: str, report_date: date, slot: str, after: int | None = None) -> int:
        """Write one slot's report, commit it, return its row count. A row of
        another date or slot fails the run. ``after`` is the slot's
        ``last_number`` when the run began (now, if not given); if a record has
        been added since, the rows are deleted and ``CommitConflict`` is raised."""
        after = self.last_number(list_name, report_date, slot) if after is None else after
        own = F.col("report_date").eqNullSafe(F.lit(report_date)) & F.col("slot").eqNullSafe(F.lit(slot))
        foreign = F.raise_error(F.lit(f"a row is not of {report_date} {slot}")).cast("boolean")
        rows = report.where(F.when(own, True).otherwise(foreign)).select(*REPORT_COLUMNS).drop("report_date", "slot")
        run_id = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        folder = self._folder(self.reports_path, list_name, report_date, slot, run_id)
        order = ("transaction_time", "transaction_id")
        writer = rows.repartitionByRange(*order).sortWithinPartitions(*order).write
        writer.option("parquet.bloom.filter.enabled#transaction_id", "true").parquet(folder)
        written = self.spark.read.schema(REPORT).parquet(folder).count()
        record = f"{self._folder(self.runs_path, list_name, report_date, slot)}/{after + 1:010d}.json"
        if not self._create(record, json.dumps({"number": after + 1, "run_id": run_id, "row_count": written})):
            p, fs = self._fs(folder)
            fs.delete(p, True)
            raise CommitConflict(f"another run of {list_name} {report_date} {slot} has committed")
        return written

    def clean(self, older_than: timedelta = timedelta(days=1)) -> list[str]:
        """Delete the run folders without a record that were begun longer ago
        than ``older_than``, and return their paths. Committed rows stay, also
        superseded ones. The folders are listed, as many as there were runs."""
        p, fs = self._fs(f"{self.reports_path}/list_name=*/report_date=*/slot=*/run_id=*")
        found = [f.getPath() for f in fs.globStatus(p) or []]
        kept = {r.run_id for r in self.records().select("run_id").collect()} if found else set()
        before = time.time_ns() - int(older_than.total_seconds() * 1e9)
        gone = []
        for path in found:
            run_id = unquote(path.getName().partition("=")[2])
            if run_id not in kept and run_id.partition("-")[0].isdigit() and int(run_id.partition("-")[0]) <= before:
                fs.delete(path, True)
                gone.append(path.toString())
        return gone

    def find(self, ids: DataFrame, listed: int = FIND_IDS) -> DataFrame:
        """``transaction_id, list_name, report_date, slot`` of the committed
        reports that list the ids in ``ids["transaction_id"]``. Up to ``listed``
        distinct ids go into the scan as a predicate, which the files' Bloom
        filters answer without reading rows; more meet the reports in a join."""
        wanted = ids.select("transaction_id").where("transaction_id IS NOT NULL").distinct()
        rows = self._read(self.reports_path, [self.reports_path], _STORED).select("transaction_id", *_SLOT, "run_id")
        few = wanted.limit(listed + 1).collect()
        if len(few) <= listed:
            rows = rows.where(F.col("transaction_id").isin([r.transaction_id for r in few]))
        else:
            rows = rows.join(wanted, "transaction_id", "left_semi")
        return rows.join(self.runs(), [*_SLOT, "run_id"], "left_semi").select("transaction_id", *_SLOT)

    def export_csv(self, list_name: str, report_date: date, slot: str, path: str) -> None:
        """Report rows as CSV with a header, globally ordered by time then id."""
        rows = self._reports_of(self._records(list_name, [(report_date, slot)])).select(*REPORT.fieldNames())
        rows.orderBy(F.asc_nulls_last("transaction_time"), "transaction_id").write.mode("overwrite").option("header", True).csv(path)
