"""Predicate reads of a database: which rows each query selects, and the whole
hit query over a reader that applies the predicates to the fixture tables.
No database is started; the live read is not tested here."""

from __future__ import annotations

import json

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from gatewatch import Window, fixture_tables, watchlist_hits
from gatewatch.__main__ import main
from gatewatch.operators.transactions import scan_gate_txn
from gatewatch.sources import jdbc
from gatewatch.sources.fixtures import fixture_frames
from gatewatch.sources.jdbc import DIALECTS, SMALL_TABLES, SPLIT_COLUMNS, dialect_of, jdbc_reader, tables_from_reader
from gatewatch.sources.tables import CAMERA_TABLES, GATE_TABLES, OTHER_TABLES

W = Window.parse("2024-01-10 00:00:00", "2024-01-12 08:00:00")


def test_predicate_texts():
    assert DIALECTS["oracle"].hash_predicates("PLATE2", 3) == [
        "(PLATE2 IS NULL OR ORA_HASH(PLATE2, 2) = 0)",
        "(PLATE2 IS NOT NULL AND ORA_HASH(PLATE2, 2) = 1)",
        "(PLATE2 IS NOT NULL AND ORA_HASH(PLATE2, 2) = 2)",
    ]
    assert DIALECTS["sqlserver"].hash_predicates("K", 2)[1] == "(K IS NOT NULL AND ((CHECKSUM(K) & 2147483647) % 2) = 1)"
    assert DIALECTS["oracle"].hash_predicates("K", 1) == ["1 = 1"]
    assert DIALECTS["oracle"].window_predicates("T", W, 2) == [
        "(T >= TIMESTAMP '2024-01-10 00:00:00' AND T < TIMESTAMP '2024-01-11 04:00:00')",
        "(T >= TIMESTAMP '2024-01-11 04:00:00' AND T <= TIMESTAMP '2024-01-12 08:00:00')",
    ]
    one = Window.parse("2024-01-10 00:00:00", "2024-01-10 00:00:00")
    assert DIALECTS["sqlserver"].window_predicates("T", one, 8) == ["(T >= '2024-01-10 00:00:00' AND T <= '2024-01-10 00:00:00')"]


def test_dialects():
    assert dialect_of("jdbc:oracle:thin:@//host/db") is DIALECTS["oracle"]
    with pytest.raises(ValueError, match="hash_sql"):
        dialect_of("jdbc:h2:mem:x")
    assert dialect_of("jdbc:h2:mem:x", "MOD(ORA_HASH({c}), {n})").hash_predicates("K", 2)[1] == "(K IS NOT NULL AND MOD(ORA_HASH(K), 2) = 1)"


@pytest.mark.parametrize("values", [[None, "a", "b", "", "a"] * 20, [str(i) for i in range(500)], ["hot"] * 300])
def test_every_row_is_in_one_bucket(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "k string")
    predicates = DIALECTS["hive2"].hash_predicates("k", 16)
    times = df.select(sum(F.when(F.expr(p), 1).otherwise(0) for p in predicates).alias("n"))
    assert times.where("n != 1").count() == 0


def test_every_time_of_the_window_is_in_one_slice(spark):
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2024-01-09 23:00:00', TIMESTAMP_NTZ'2024-01-12 10:00:00', INTERVAL 7 MINUTES)) AS t")
    df = df.union(spark.sql("SELECT TIMESTAMP_NTZ'2024-01-12 08:00:00'")).union(spark.sql("SELECT TIMESTAMP_NTZ'2024-01-12 08:00:01'"))
    inside = F.col("t").between(W.lo_lit(), W.hi_lit()).cast("int")
    for n in (1, 2, 7, 64):
        predicates = DIALECTS["hive2"].window_predicates("t", W, n)
        times = df.select(inside.alias("want"), sum(F.when(F.expr(p), 1).otherwise(0) for p in predicates).alias("n"))
        assert len(predicates) == n and times.where("n != want").count() == 0


class FakeReader:
    """Applies each predicate to a table as a database would, one query each."""

    def __init__(self, spark):
        self.frames = fixture_frames(spark, SF001)
        self.calls: dict[str, list] = {}

    def __call__(self, table, predicates):
        df = self.frames[table.lower().removeprefix("toll.")]
        df = df.toDF(*[c.upper() for c in df.columns])
        self.calls.setdefault(table, []).append(predicates)
        if predicates is None:
            return df
        out = None
        for p in predicates:
            part = df.where(F.expr(p))
            out = part if out is None else out.union(part)
        return out


def test_hits_over_predicate_reads(spark):
    read = FakeReader(spark)
    names = {n: f"TOLL.{n.upper()}" for n in [*GATE_TABLES.values(), *CAMERA_TABLES.values(), *OTHER_TABLES]}
    t = tables_from_reader(read, DIALECTS["hive2"], names, num_partitions=3)
    key = lambda df: sorted(tuple(r) for r in df.collect())
    fixture = fixture_tables(spark, SF001)
    assert key(watchlist_hits(t, W, "ASIA")) == key(watchlist_hits(fixture, W, "ASIA"))
    columns = scan_gate_txn(fixture).columns
    assert key(scan_gate_txn(t).select(columns)) == key(scan_gate_txn(fixture))
    for name in names:
        for predicates in read.calls[names[name]]:
            assert (predicates is None) == (name in SMALL_TABLES), name
            assert predicates is None or len(predicates) == 3
    assert set(SPLIT_COLUMNS) | set(SMALL_TABLES) == set(names)


def test_reader_options(spark, monkeypatch):
    seen = []

    class Recorder:
        def jdbc(self, url, table, **kw):
            seen.append((url, table, kw))

    class Session:
        read = Recorder()

    read = jdbc_reader(Session(), "jdbc:oracle:x", {"user": "u"})
    read("T", None)
    read("T", ["a", "b"])
    props = {"preferTimestampNTZ": "true", "user": "u"}
    assert seen == [("jdbc:oracle:x", "T", {"properties": props}), ("jdbc:oracle:x", "T", {"predicates": ["a", "b"], "properties": props})]


def test_command_line_route(spark, scratch, monkeypatch):
    """``--tables jdbc:...`` reads by the options file; the reader is replaced."""
    options = f"{scratch}/jdbc.json"
    with open(options, "w") as f:
        json.dump({"num_partitions": 2, "properties": {"user": "u"}}, f)
    read, asked = FakeReader(spark), []
    monkeypatch.setattr(jdbc, "jdbc_reader", lambda s, url, props: asked.append((url, props)) or read)
    monkeypatch.setitem(jdbc.DIALECTS, "oracle", DIALECTS["hive2"])
    args = ["--date", "2024-01-12", "--store", f"{scratch}/store", "--list", "ASIA"]
    assert main(["run", "C", *args, "--tables", "jdbc:oracle:thin:@//db/toll", "--jdbc-options", options], spark) == 0
    assert asked == [("jdbc:oracle:thin:@//db/toll", {"user": "u"})]
    assert len(read.calls["member_txn"][0]) == 2
    assert main(["check", "C", *args], spark) == 0
