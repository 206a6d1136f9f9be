"""Enrichment joins of the gate transactions (JOIN2-JOIN5, FN1, SET1/AGG2).

The camera tables are as large as the transaction tables and have no time
column, so every camera join takes an optional measured ``KeySet`` of the
transactions' ids: when given, the camera rows are first reduced to those ids
(range predicate pushed to the scan, then a left semi join that is broadcast
when the set is small), and only the reduced rows meet the transactions. Row
results are identical either way.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.functions.columns import vehicle_class
from gatewatch.operators.broadcast import KeySet, maybe_broadcast
from gatewatch.schemas import SOURCE_ROW_COLUMNS


def province_lookup(df: DataFrame, office: DataFrame, office_small: bool = False) -> DataFrame:
    """Inner join province code -> description (JOIN2). An unknown code drops
    the row; a duplicated code fans out."""
    o = office.select(F.col("code").alias("_code"), "description")
    o = maybe_broadcast(o, office_small)
    return df.join(o, df["vehicle_province"] == o["_code"], "inner").drop("_code")


def tagged_cameras(cameras: Mapping[str, DataFrame]) -> DataFrame:
    """The per-kind camera tables as one table tagged by ``mem_type``."""
    out = None
    for kind, cam in cameras.items():
        t = cam.select(
            F.lit(kind).alias("_cam_kind"),
            F.col("transaction_id").alias("_cam_id"),
            "body_path_pic",
            "plate_path_pic",
        )
        out = t if out is None else out.unionByName(t)
    return out


def camera_left_join(
    df: DataFrame, cameras: Mapping[str, DataFrame], ids: KeySet | None = None
) -> DataFrame:
    """Left join each kind's camera table by transaction id (JOIN3)."""
    if ids is not None:
        cameras = {k: ids.restrict(c, "transaction_id") for k, c in cameras.items()}
    cam = tagged_cameras(cameras)
    cond = (df["mem_type"] == cam["_cam_kind"]) & (df["transaction_id"] == cam["_cam_id"])
    return df.join(cam, cond, "left").drop("_cam_kind", "_cam_id")


def back_camera_left_join(df: DataFrame, back: DataFrame, refs: KeySet | None = None) -> DataFrame:
    """Left join the back picture by reference id, with ``delete_flag = 0``
    part of the join condition, not a filter on the result (JOIN5)."""
    live = back.where(F.col("delete_flag") == 0).select(
        F.col("ref_transaction_id").alias("_ref"), "back_path_pic"
    )
    if refs is not None:
        live = refs.restrict(live, "_ref")
    return df.join(live, df["ref_transaction_id"] == live["_ref"], "left").drop("_ref")


def rollback_left_join(df: DataFrame, rollback: DataFrame) -> DataFrame:
    """The literal rollback join (JOIN4): left join by plate and province.
    It adds no column; its only effect is fan-out, which the distinct over
    the source rows removes. ``source_rows`` therefore omits it."""
    r = rollback.select(
        F.col("plate1").alias("_rb1"), F.col("plate2").alias("_rb2"), F.col("province").alias("_rbp")
    )
    cond = (
        (df["vehicle_license_1"] == r["_rb1"])
        & (df["vehicle_license_2"] == r["_rb2"])
        & (df["vehicle_province"] == r["_rbp"])
    )
    return df.join(r, cond, "left").drop("_rb1", "_rb2", "_rbp")


def with_vehicle_class(df: DataFrame) -> DataFrame:
    return df.withColumn("vehicle_class", vehicle_class("vehicle_wheel_code"))


def source_union_distinct(df: DataFrame) -> DataFrame:
    """The 11 source columns, distinct (SET1 + AGG2). The kinds are tagged in
    ``mem_type``, so one distinct over the tagged union equals the UNION of
    per-kind branches."""
    return df.select(*SOURCE_ROW_COLUMNS).distinct()
