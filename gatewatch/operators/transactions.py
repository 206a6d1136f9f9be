"""Gate transaction operators: tagged scan, window, paid/active, singleton groups."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatewatch.operators.broadcast import checkpoint_and_size, maybe_broadcast
from gatewatch.sources.tables import MEM_TYPES, TollTables, Window, merge_windows

# A transaction is reported only if it is the single row of its
# (time, plate part 1, plate part 2, province) group within its kind.
SINGLETON_KEYS = ("transaction_date", "vehicle_license_1", "vehicle_license_2", "vehicle_province")


def scan_gate_txn(
    tables: TollTables, window: Window | None = None, kinds: Iterable[str] = MEM_TYPES
) -> DataFrame:
    """The three transaction tables as one DataFrame tagged by ``mem_type``
    (SRC2 + PRJ3). With a window, each scan prunes at the source and the
    exact inclusive predicate is applied (FLT1)."""
    out = None
    for kind in kinds:
        df = tables.transactions(kind, window)
        if window is not None:
            df = filter_window_inclusive(df, window)
        df = df.withColumn("mem_type", F.lit(kind))
        out = df if out is None else out.unionByName(df)
    return out


def filter_window_inclusive(df: DataFrame, window: Window, column: str = "transaction_date") -> DataFrame:
    """``column BETWEEN lo AND hi`` on the bare column, so it is pushed to the scan (FLT1)."""
    return df.where(F.col(column).between(window.lo_lit(), window.hi_lit()))


def filter_windows(df: DataFrame, windows: Iterable[Window], column: str = "transaction_date") -> DataFrame:
    """Rows whose ``column`` lies in any of the windows (merged first, so the
    predicate is one range per disjoint interval)."""
    cond = None
    for w in merge_windows(windows):
        term = F.col(column).between(w.lo_lit(), w.hi_lit())
        cond = term if cond is None else cond | term
    return df.where(cond if cond is not None else F.lit(False))


def paid_active(df: DataFrame) -> DataFrame:
    """``fee_amount > 0 AND delete_flag = 0`` (FLT2, FLT3). NULL fails both."""
    return df.where((F.col("fee_amount") > 0) & (F.col("delete_flag") == 0))


_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
REPEATED_BYTES = 64 << 20  # of repeated groups that may be broadcast


def singleton_groups(
    df: DataFrame,
    keys: Sequence[str] = SINGLETON_KEYS,
    by: Sequence[str] = ("mem_type",),
    broadcast_bytes: int = REPEATED_BYTES,
) -> DataFrame:
    """Rows that are alone in their ``by + keys`` group (AGG1 + FLT4 + JOIN1).

    Rows with a NULL key are dropped (the source joins the groups back on
    equality). Both forms count the groups by a hash aggregation that is partial
    on the map side, so a hot group costs one row per map task rather than
    landing whole in one task.

    If all other columns are of fixed width, the count carries ``min()`` of each
    of them; for a group of one row that *is* the row (and ``min`` is
    deterministic, unlike ``first``, so a retried stage reproduces its output),
    and the input is scanned once. A ``min`` of text would need a sort; then the
    groups that occur more than once are counted by their keys alone,
    checkpointed with their measured size, and the rows that are in none of them
    are the result: an anti join, broadcast up to ``broadcast_bytes``.
    """
    group = [*by, *keys]
    payload = [c for c in df.columns if c not in group]
    keyed = df.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    if all(isinstance(df.schema[c].dataType, _FIXED) for c in payload):
        counted = keyed.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(c) for c in payload])
        return counted.where(F.col("_n") == 1).select(*df.columns)
    repeated = keyed.groupBy(*group).count().where("count > 1").select(*group)
    repeated, size = checkpoint_and_size(repeated)
    # The grouping takes NULL tags as equal, so the join does as well.
    other = maybe_broadcast(repeated.select(*[F.col(c).alias(f"_r_{c}") for c in group]), size <= broadcast_bytes)
    same = [keyed[c].eqNullSafe(other[f"_r_{c}"]) if c in by else keyed[c] == other[f"_r_{c}"] for c in group]
    return keyed.join(other, reduce(and_, same), "left_anti").select(*df.columns)
