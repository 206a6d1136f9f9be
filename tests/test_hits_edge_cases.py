"""Hand-made edge rows for the hit query (FIXTURES.md section 4)."""

from __future__ import annotations

from datetime import timedelta

from conftest import make_tables, txn, wl_row

from gatewatch import Window, watchlist_hits
from gatewatch.operators.enrich import rollback_left_join
from gatewatch.operators.transactions import paid_active, scan_gate_txn, singleton_groups
from gatewatch.operators.watchlist import first_hit_per_vehicle
from gatewatch.functions.columns import like_column, vehicle_class
from gatewatch.schemas import HIT_COLUMNS

W = Window.parse("2024-01-10 00:00:00", "2024-01-12 08:00:00")
T0 = "2024-01-11 10:00:00"


def hits(spark, **rows):
    rows.setdefault("watchlist_master", [wl_row()])
    df = watchlist_hits(make_tables(spark, **rows), W, "LIST")
    assert df.columns == HIT_COLUMNS
    return df.collect()


def ids(rows):
    return sorted(r.transaction_id for r in rows)


def test_single_paid_row_is_a_hit(spark):
    out = hits(spark, member_txn=[txn(1, T0)])
    assert ids(out) == [1]
    r = out[0]
    assert (r.description, r.vehicle_class, r.mem_type, r.rn) == ("PROV_1", "C1", "MEMBER", 1)
    assert r.body_path_pic is None and r.back_path_pic is None  # no camera rows: kept, paths NULL


def test_exact_duplicate_group_drops_both(spark):
    assert hits(spark, member_txn=[txn(1, T0), txn(2, T0)]) == []


def test_deleted_or_free_twin_still_disqualifies(spark):
    assert hits(spark, member_txn=[txn(1, T0), txn(2, T0, deleted=1)]) == []
    assert hits(spark, member_txn=[txn(1, T0), txn(2, T0, fee=0)]) == []


def test_same_key_in_two_kinds_keeps_smaller_id(spark):
    out = hits(spark, member_txn=[txn(5, T0)], illegal_txn=[txn(3, T0)])
    assert ids(out) == [3]
    assert out[0].mem_type == "ILLIGAL"


def test_null_key_rows_are_dropped(spark):
    out = hits(
        spark,
        member_txn=[txn(1, T0, l1=None), txn(2, T0, prov=None), txn(3, None)],
        watchlist_master=[wl_row(p1=None), wl_row()],
    )
    assert out == []


def test_window_bounds_are_inclusive(spark):
    rows = [
        txn(1, W.lo, l2="1"),
        txn(2, W.hi, l2="2"),
        txn(3, W.hi + timedelta(seconds=1), l2="3"),
        txn(4, W.lo - timedelta(seconds=1), l2="4"),
    ]
    wl = [wl_row(p2=str(i)) for i in range(1, 5)]
    assert ids(hits(spark, member_txn=rows, watchlist_master=wl)) == [1, 2]


def test_fee_filter(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, 0.0), (2, None), (3, 0.01)], "id long, fee_amount double").withColumn(
        "delete_flag", F.lit(0)
    )
    assert [r.id for r in paid_active(df).collect()] == [3]


def test_vehicle_class_case(spark):
    df = spark.createDataFrame([(c,) for c in ["VWHEL0001", "VWHEL0002", "VWHEL0003", "VWHEL0004", None]], "w string")
    assert [r.c for r in df.select(vehicle_class("w").alias("c")).collect()] == ["C1", "C2", "C3", "Unknown", "Unknown"]


def test_unknown_province_code_is_dropped(spark):
    assert hits(spark, member_txn=[txn(1, T0, prov=9)]) == []


def test_back_picture_delete_flag_is_part_of_the_join(spark):
    out = hits(
        spark,
        member_txn=[txn(1, T0, ref=70), txn(2, "2024-01-11 11:00:00", ref=80)],
        back_camera=[(70, "back/70.png", 1), (80, "back/80.png", 0)],
    )
    by_id = {r.transaction_id: r.back_path_pic for r in out}
    assert by_id == {1: None, 2: "back/80.png"}


def test_camera_join_uses_the_kinds_own_table(spark):
    out = hits(
        spark,
        nonmember_txn=[txn(1, T0)],
        member_camera=[(1, "body/wrong.png", "plate/wrong.png")],
        nonmember_camera=[(1, "body/1.png", "plate/1.png")],
    )
    assert [(r.body_path_pic, r.plate_path_pic) for r in out] == [("body/1.png", "plate/1.png")]


def test_rollback_fan_out_is_removed_by_distinct(spark):
    t = make_tables(spark, member_txn=[txn(1, T0)], invoice_rollback=[("K1", "100", 1), ("K1", "100", 1)])
    g = scan_gate_txn(t)
    assert rollback_left_join(g, t.invoice_rollback).count() == 2
    assert rollback_left_join(g, t.invoice_rollback).select(*g.columns).distinct().count() == 1
    assert len(hits(spark, member_txn=[txn(1, T0)], invoice_rollback=[("K1", "100", 1)] * 2)) == 1


def test_several_invoices_tie_break_is_total(spark):
    out = hits(
        spark,
        member_txn=[txn(1, T0)],
        member_invoice=[(10, "O"), (11, "F")],
        member_invoice_detail=[(10, "R", 1), (11, "A", 1)],
    )
    assert len(out) == 1
    assert (out[0].status, out[0].create_channel) == ("F", "A")


def test_like_patterns(spark):
    df = spark.createDataFrame(
        [("ABC", "%"), ("ABC", "A_C"), ("ABC", "ABC"), ("ABC", "abc"), ("ABC", None), ("A\\C", "A\\C")],
        "d string, p string",
    )
    got = [r.m for r in df.select(like_column("d", "p").alias("m")).collect()]
    assert got == [True, True, True, False, None, True]


def test_list_name_filters_watchlist(spark):
    wl = [wl_row(list_type=2), wl_row(p2="200", list_type=7)]
    assert hits(spark, member_txn=[txn(1, T0), txn(2, T0, l2="200")], watchlist_master=wl) == []


def test_watchlist_province_pattern(spark):
    # the pattern is a column; '_' and '%' are wildcards, matching is case-sensitive
    out = hits(spark, member_txn=[txn(1, T0)], watchlist_master=[wl_row(province="PROV_1")])
    assert ids(out) == [1]
    out = hits(spark, member_txn=[txn(1, T0)], watchlist_master=[wl_row(province="PROVX1")])
    assert out == []
    out = hits(spark, member_txn=[txn(1, T0)], watchlist_master=[wl_row(province="PR_V%")])
    assert ids(out) == [1]
    out = hits(spark, member_txn=[txn(1, T0)], watchlist_master=[wl_row(province="prov_1")])
    assert out == []


def test_plate_text_collision_is_one_vehicle(spark):
    rows = [txn(1, T0, l1="A B", l2="C"), txn(2, T0, l1="A", l2="B C")]
    wl = [wl_row(p1="A B", p2="C"), wl_row(p1="A", p2="B C")]
    assert ids(hits(spark, member_txn=rows, watchlist_master=wl)) == [1]


def test_first_hit_per_vehicle_keeps_rn_one(spark):
    from pyspark.sql import functions as F

    t = make_tables(spark, member_txn=[txn(1, T0)], watchlist_master=[wl_row()])
    df = watchlist_hits(t, W, "LIST").drop("rn")
    dup = df.unionByName(df.withColumn("transaction_id", F.lit(0).cast("bigint")))
    out = first_hit_per_vehicle(dup).collect()
    assert [(r.transaction_id, r.rn) for r in out] == [(0, 1)]


def test_singleton_groups_matches_self_join_form(spark):
    t = make_tables(
        spark,
        member_txn=[txn(1, T0), txn(2, T0), txn(3, T0, l2="300"), txn(4, T0, l2=None)],
    )
    g = scan_gate_txn(t)
    assert sorted(r.transaction_id for r in singleton_groups(g).collect()) == [3]


def test_empty_inputs_give_empty_hits(spark):
    assert hits(spark) == []
