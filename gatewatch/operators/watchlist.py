"""Watchlist match and the first hit per vehicle (JOIN8, JOIN9, FLT5, WIN1, FLT6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.functions.columns import like_column, plate_text
from gatewatch.operators.broadcast import maybe_broadcast

WATCHLIST_COLUMNS = (
    "plate1",
    "plate2",
    "province",
    "img_body",
    "img_plate",
    "img_back",
    "plate1_origin",
    "plate2_origin",
    "province_origin",
    "model",
    "color",
)

# After the transaction id, ties (invoice, watchlist or camera fan-out of one
# id) are broken over every other column, NULLs last, so the pick is total.
TIE_BREAK = (
    "transaction_id",
    "status",
    "create_channel",
    "model",
    "color",
    "img_body",
    "img_plate",
    "img_back",
    "plate1_origin",
    "plate2_origin",
    "province_origin",
    "body_path_pic",
    "plate_path_pic",
    "back_path_pic",
    "mem_type",
    "vehicle_class",
    "ref_transaction_id",
    "vehicle_license_1",
    "vehicle_license_2",
)


def watchlist_type_filter(
    master: DataFrame, types: DataFrame, list_name: str, types_small: bool = False
) -> DataFrame:
    """Watchlist rows whose type is named ``list_name`` (JOIN9 + FLT5).

    The source writes a left join followed by ``list_name = ...``; the
    equality rejects the NULLs a left join would add, so it is an inner join.
    The type table is filtered by name first. It is hinted as a broadcast
    only when the caller measured it small (``types_small``); otherwise the
    planner sizes the join from the table's statistics.
    """
    t = list_type_ids(types, list_name)
    t = maybe_broadcast(t, types_small)
    return master.join(t, master["list_type"] == t["_type_id"], "left_semi")


def list_type_ids(types: DataFrame, list_name: str) -> DataFrame:
    """Ids of the watchlist types named ``list_name``."""
    return types.where(F.col("list_name") == list_name).select(F.col("id").alias("_type_id"))


def watchlist_plates(watchlist: DataFrame) -> DataFrame:
    """(plate1, plate2) of a watchlist, named like the transaction columns.
    Not deduplicated: it only feeds semi-joins, which ignore duplicates."""
    return watchlist.select(
        F.col("plate1").alias("vehicle_license_1"), F.col("plate2").alias("vehicle_license_2")
    )


HEAD = 4  # literal characters at the start of a pattern that become a join key


def pattern_key(pattern: Column) -> Column:
    """The join key of a LIKE pattern: the whole of a pattern without wildcards,
    the first ``HEAD`` characters of one that starts with as many literal ones,
    the same for all others. Null for a null pattern, which matches nothing."""
    wild = F.regexp_instr(pattern, F.lit("[%_]"))
    head = F.concat(F.lit("^"), F.substring(pattern, 1, HEAD))
    return F.when(wild == 0, F.concat(F.lit("="), pattern)).when(wild > HEAD, head).when(wild > 0, F.lit("*"))


def value_keys(value: Column) -> Column:
    """The keys of all patterns that may match a value; null for a null value."""
    head = F.when(F.char_length(value) >= HEAD, F.concat(F.lit("^"), F.substring(value, 1, HEAD)))
    keys = F.array_compact(F.array(F.concat(F.lit("="), value), head, F.lit("*")))
    return F.when(value.isNotNull(), keys)


def watchlist_like_join(df: DataFrame, watchlist: DataFrame, watchlist_small: bool = False) -> DataFrame:
    """Inner join by both plate parts and ``description LIKE province`` (JOIN8).

    Each watchlist row has one key by its pattern's class, each transaction the
    up to three keys it can meet, so a plate with thousands of patterns is not
    compared with all of them: a pattern without wildcards meets its own value
    only and needs no LIKE, one with a literal head the values of that head.
    LIKE runs as a residual condition on what is left, never as a nested loop,
    and no pair meets by more than one key.
    """
    wl = watchlist.select(*WATCHLIST_COLUMNS, pattern_key(F.col("province")).alias("_pattern_key")).where("_pattern_key IS NOT NULL")
    wl = maybe_broadcast(wl, watchlist_small)
    keyed = df.withColumn("_value_key", F.explode(value_keys(F.col("description"))))
    cond = (
        (keyed["vehicle_license_1"] == wl["plate1"])
        & (keyed["vehicle_license_2"] == wl["plate2"])
        & (keyed["_value_key"] == wl["_pattern_key"])
        & (wl["_pattern_key"].startswith("=") | like_column(keyed["description"], wl["province"]))
    )
    return keyed.join(wl, cond, "inner").drop("plate1", "plate2", "province", "_pattern_key", "_value_key")


def first_hit_per_vehicle(df: DataFrame) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY time, 'L1 L2', province ORDER BY id, ...) = 1``
    (WIN1 + FLT6). The plate is the joined text, so ('A B','C') and
    ('A','B C') are one vehicle. Catalyst plans the ``rn = 1`` filter as a
    window group limit that also runs before the shuffle, so a hot group is
    cut to one row per map task."""
    w = Window.partitionBy("transaction_date", plate_text(), "description").orderBy(
        *[F.asc_nulls_last(c) for c in TIE_BREAK]
    )
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1).withColumn(
        "rn", F.col("rn").cast("bigint")
    )
