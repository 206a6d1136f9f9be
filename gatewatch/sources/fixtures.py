"""Fixture views: the reference's input tables mapped onto the driver tables.

The mapping (FIXTURES.md section 1) turns ``events`` into gate transactions
and cameras, ``nation`` into the province office, ``customer`` into the
watchlist and rollback rows, ``region`` into watchlist types and
``orders``/``lineitem`` into invoices. Each view is a projection over a
Parquet scan, so Catalyst keeps column pruning and filter pushdown.

The gate views' ``transaction_date`` is the event time truncated to the hour,
a derived column that Parquet cannot filter on. Their scan therefore pushes a
covering predicate on the raw ``ts`` column as well: ``trunc_hour(ts)`` lies in
``[lo, hi]`` only if ``ts`` lies in ``[trunc_hour(lo), trunc_hour(hi) + 1h)``.
The projection carries ``ts`` through as a hidden column so that predicate,
placed above the projection, still reaches the Parquet scan; the column is
dropped before the rows leave the scan.

The views are built once per (session, folder) and reused: DataFrames are
immutable plans, and building them costs many driver round trips.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.sources.tables import (
    ILLEGAL,
    MEMBER,
    NON_MEMBER,
    TollTables,
    Window,
    tables_from_frames,
    ts_literal,
)

# Fixed values of the fixture mapping: event types per transaction kind.
EVENT_TYPES = {
    MEMBER: ("click", "purchase"),
    NON_MEMBER: ("view", "signup"),
    ILLEGAL: ("error",),
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def trunc_hour(ts: Column) -> Column:
    """Hour truncation of a ``timestamp_ntz`` without any time-zone round trip."""
    return F.make_timestamp_ntz(
        F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0)
    )


RAW_TS = "_event_ts"


def _gate_projection(ev: DataFrame, keep_ts: bool = False) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    extra = [F.col("ts").alias(RAW_TS)] if keep_ts else []
    return ev.select(
        e.alias("transaction_id"),
        trunc_hour(F.col("ts")).alias("transaction_date"),
        (e * 7).alias("ref_transaction_id"),
        F.concat(F.lit("K"), _s(u % 10)).alias("vehicle_license_1"),
        _s(u).alias("vehicle_license_2"),
        (u % 25).cast("int").alias("vehicle_province"),
        F.concat(F.lit("VWHEL000"), _s(e % 5)).alias("vehicle_wheel_code"),
        F.floor(F.col("value") / 5).cast("bigint").alias("fee_amount"),
        F.when(e % 17 == 0, 1).otherwise(0).cast("int").alias("delete_flag"),
        *extra,
    )


def _hour_floor(w):
    return w.replace(minute=0, second=0, microsecond=0)


def fixture_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every fixture view as a DataFrame, keyed by logical name (no window)."""
    events = _read(spark, sf_dir, "events")
    customer = _read(spark, sf_dir, "customer")
    nation = _read(spark, sf_dir, "nation")
    region = _read(spark, sf_dir, "region")
    orders = _read(spark, sf_dir, "orders")
    lineitem = _read(spark, sf_dir, "lineitem")
    e = F.col("event_id")

    frames: dict[str, DataFrame] = {}
    for kind, name in ((MEMBER, "member"), (NON_MEMBER, "nonmember"), (ILLEGAL, "illegal")):
        typed = events.where(F.col("event_type").isin(*EVENT_TYPES[kind]))
        frames[f"{name}_txn"] = _gate_projection(typed)
        frames[f"{name}_camera"] = typed.where(e % 3 != 0).select(
            e.alias("transaction_id"),
            F.concat(F.lit("body/"), _s(e), F.lit(".png")).alias("body_path_pic"),
            F.concat(F.lit("plate/"), _s(e), F.lit(".png")).alias("plate_path_pic"),
        )

    frames["province_office"] = nation.select(
        F.col("n_nationkey").cast("int").alias("code"), F.col("n_name").alias("description")
    )
    frames["back_camera"] = events.where(e % 2 == 0).select(
        (e * 7).alias("ref_transaction_id"),
        F.concat(F.lit("back/"), _s(e), F.lit(".png")).alias("back_path_pic"),
        F.when(e % 4 == 0, 1).otherwise(0).cast("int").alias("delete_flag"),
    )

    k = F.col("c_custkey")
    rollback_keys = customer.where(k % 6 == 0).select(k).unionAll(customer.where(k % 12 == 0).select(k))
    frames["invoice_rollback"] = rollback_keys.select(
        F.concat(F.lit("K"), _s(k % 10)).alias("plate1"),
        _s(k).alias("plate2"),
        (k % 25).cast("int").alias("province"),
    )

    ok = F.col("o_orderkey")
    lk = F.col("l_orderkey")
    for name, mod in (("member", 2), ("nonmember", 3)):
        frames[f"{name}_invoice"] = orders.where(ok % mod == 0).select(
            ok.alias("invoice_no"), F.col("o_orderstatus").alias("status")
        )
        frames[f"{name}_invoice_detail"] = lineitem.where(lk % mod == 0).select(
            lk.alias("invoice_no"),
            F.col("l_returnflag").alias("create_channel"),
            lk.alias("transaction_id"),
        )

    frames["watchlist_master"] = customer.select(
        F.concat(F.lit("K"), _s(k % 10)).alias("plate1"),
        _s(k).alias("plate2"),
        F.when(k % 3 == 0, F.lit("%"))
        .when(k % 3 == 1, F.lit("NATION_1%"))
        .otherwise(F.concat(F.lit("NATION_"), _s(k % 25)))
        .alias("province"),
        (F.col("c_nationkey") % 5).cast("int").alias("list_type"),
        F.when(k % 4 != 0, F.concat(F.lit("body/"), _s(k), F.lit(".png"))).alias("img_body"),
        F.concat(F.lit("plate/"), _s(k), F.lit(".png")).alias("img_plate"),
        F.when(k % 5 != 0, F.concat(F.lit("back/"), _s(k), F.lit(".png"))).alias("img_back"),
        F.concat(F.lit("K"), _s(k % 10)).alias("plate1_origin"),
        _s(k).alias("plate2_origin"),
        F.concat(F.lit("NATION_"), _s(F.col("c_nationkey"))).alias("province_origin"),
        F.col("c_name").alias("model"),
        F.col("c_mktsegment").alias("color"),
    )
    frames["watchlist_type"] = region.select(
        F.col("r_regionkey").cast("int").alias("id"), F.col("r_name").alias("list_name")
    )
    frames["_events"] = events
    return frames


_CACHE: dict[tuple[str, str], TollTables] = {}


def fixture_tables(spark: SparkSession, sf_dir: str) -> TollTables:
    """The fixture views bundled as ``TollTables`` with ts-pruning gate scans."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = _build_fixture_tables(spark, sf_dir)
    return _CACHE[key]


def _build_fixture_tables(spark: SparkSession, sf_dir: str) -> TollTables:
    frames = fixture_frames(spark, sf_dir)
    base = tables_from_frames(frames)
    events = frames["_events"]

    def gate_scan(kind: str):
        typed = events.where(F.col("event_type").isin(*EVENT_TYPES[kind]))
        plain = _gate_projection(typed)
        with_ts = _gate_projection(typed, keep_ts=True)

        def scan(window: Window | None) -> DataFrame:
            if window is None:
                return plain
            lo = ts_literal(_hour_floor(window.lo))
            hi = ts_literal(_hour_floor(window.hi) + timedelta(hours=1))
            return with_ts.where((F.col(RAW_TS) >= lo) & (F.col(RAW_TS) < hi)).drop(RAW_TS)

        return scan

    return TollTables(
        gate={kind: gate_scan(kind) for kind in (MEMBER, NON_MEMBER, ILLEGAL)},
        camera=base.camera,
        province_office=base.province_office,
        back_camera=base.back_camera,
        invoice_rollback=base.invoice_rollback,
        member_invoice=base.member_invoice,
        member_invoice_detail=base.member_invoice_detail,
        nonmember_invoice=base.nonmember_invoice,
        nonmember_invoice_detail=base.nonmember_invoice_detail,
        watchlist_master=base.watchlist_master,
        watchlist_type=base.watchlist_type,
        extra={"events": events},
    )


def _as_runs(events: DataFrame) -> DataFrame:
    """Events as run records: list_name, report_date, slot, and the value, by
    which they are ordered."""
    kinds = {"click": "DAY-1", "purchase": "DAY", "view": "AFTERNOON"}
    slot = F.lit("NIGHT")
    for kind, name in kinds.items():
        slot = F.when(F.col("event_type") == kind, name).otherwise(slot)
    lists = F.when(F.col("user_id") % 2 == 0, "ASIA").otherwise("OTHER")
    return events.select(lists.alias("list_name"), F.to_date("ts").alias("report_date"), slot.alias("slot"), "value")


def stored_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run records (list_name, report_date, slot) as an earlier deployment
    would have left them, with gaps; derived from the events."""
    return _as_runs(spark.read.parquet(f"{sf_dir}/events.parquet").where("event_id % 23 = 0")).drop("value").distinct()


def stored_run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last run of every (list_name, report_date, slot), with a run_id that
    sorts by time; derived from all events."""
    runs = _as_runs(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return runs.groupBy("list_name", "report_date", "slot").agg(F.max("value").alias("run_id"))


def stored_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction ids of reports that a store already holds."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.where("event_id % 5 = 0").select(F.col("event_id").alias("transaction_id"))


def stored_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, width and height of the stored reference pictures."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_custkey % 7 <> 0")
    kinds = customer.select("c_custkey", F.explode(F.array(F.lit("body"), F.lit("plate"), F.lit("back"))).alias("kind"))
    return kinds.select(
        F.concat("kind", F.lit("/"), F.col("c_custkey").cast("string"), F.lit(".png")).alias("key"),
        (F.col("c_custkey") % 700).cast("int").alias("width"),
        (F.col("c_custkey") % 400).cast("int").alias("height"),
    )
