"""Broadcast only behind a measured size bound; prune by measured key ranges.

``bounded_broadcast`` counts the side's rows and bytes (a distributed partial
aggregation; not ``limit(n).count()``, whose global limit funnels up to n rows
per map partition into one task) and hints a broadcast only when the side is
within the bounds. Beyond it the join is left to the planner, which shuffles both
sides (sort-merge join, with AQE splitting skewed partitions).

``KeySet`` is a measured set of join keys (usually checkpointed): one job
gives its row count and its value range. It reduces a large table to the rows
whose key is in the set in two steps: range predicates on the bare key
column, which reach the Parquet scan and skip row groups and files outside
the ranges (ids and invoice numbers are assigned in time order, so a few days
of keys cover a narrow slice of a large table), then a left semi join,
broadcast when the set is within its bound.

One back-dated key would stretch a single range over the whole table. Where the
range is wide for the number of keys, ``interval_cover`` replaces it by a few
dozen intervals that leave out its widest gaps.
"""

from __future__ import annotations

import logging
import os
import uuid
from dataclasses import dataclass
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from gatewatch.session import ensure_checkpoint_dir

log = logging.getLogger(__name__)

BINS = 1024  # of an interval cover's histogram
INTERVALS = 32  # of an interval cover at most
REFINEMENTS = 4  # rounds in which its intervals are divided at most
SPARSE = 1024  # key values for each key from which a range counts as wide


def byte_size(df: DataFrame) -> Column:
    """Bytes of a row in memory, roughly: 16 for each value, and the length of
    text and binary values."""
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    return (F.lit(16 * len(df.columns)) + sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in text), F.lit(0))).cast("long")


def bounded_broadcast(df: DataFrame, max_rows: int, what: str = "side", max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` if df has at most ``max_rows`` rows and, where
    that is given, ``max_bytes`` bytes, else ``(df, False)``; one aggregation."""
    n, size = df.agg(F.count(F.lit(1)), F.sum(byte_size(df)) if max_bytes is not None else F.lit(None).cast("long")).first()
    small = n <= max_rows and (max_bytes is None or (size or 0) <= max_bytes)
    log.info("%s: %s rows, %s bytes -> %s", what, n, size, "broadcast" if small else "shuffle")
    return (F.broadcast(df) if small else df), small


def maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    """Hint a broadcast for a side whose bound was already measured."""
    return F.broadcast(df) if small else df


@dataclass(frozen=True)
class KeySet:
    """Keys in ``rows[column]``, with their measured count and range."""

    rows: DataFrame
    column: str
    count: int
    lo: Any
    hi: Any
    small: bool
    cover: tuple[tuple[Any, Any], ...] = ()

    def restrict(self, table: DataFrame, key: str) -> DataFrame:
        """Rows of ``table`` whose ``key`` is in the set."""
        inside = [F.col(key).between(F.lit(lo), F.lit(hi)) for lo, hi in self.cover or ((self.lo, self.hi),)]
        ranged = table.where(reduce(or_, inside))
        keys = maybe_broadcast(self.rows.select(F.col(self.column).alias("_k")), self.small)
        return ranged.join(keys, ranged[key] == keys["_k"], "left_semi")


def _key_aggs(columns: list[str]) -> list:
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in columns:
        aggs += [F.min(c).alias(f"_lo_{c}"), F.max(c).alias(f"_hi_{c}")]
    return aggs


def interval_cover(df: DataFrame, column: str, lo: Any, hi: Any, bins: int = BINS, intervals: int = INTERVALS) -> tuple[tuple[Any, Any], ...]:
    """At most ``intervals`` disjoint intervals, in order, that hold every key
    of ``df[column]`` (all within ``lo`` and ``hi``).

    One partial aggregation gives the least and greatest key of each of
    ``bins`` bins, and between the bins that hold keys the widest gaps stay
    open. A far outlier leaves all other keys in one bin, so the intervals are
    divided again, as long as that halves what they cover. Numbers fall into
    equal slices, text by the first characters in which an interval's ends
    differ; the width of a gap in text is taken from the bytes after those that
    all keys share.
    """
    if lo is None:
        return ()
    skip = 0 if isinstance(lo, int) else len(os.path.commonprefix([lo.encode(), hi.encode()]))

    def at(v: Any) -> int:
        return v if isinstance(v, int) else int.from_bytes(v.encode()[skip : skip + 8].ljust(8, b"\0"), "big")

    def covered(held) -> int:
        return sum(at(b) - at(a) + 1 for a, b in held)

    def bin_of(a: Any, b: Any, n: int) -> Column:
        if isinstance(a, int):
            offset = F.col(column).cast("decimal(38,0)") - F.lit(a).cast("decimal(38,0)")
            return F.floor(offset / F.lit((b - a) // n + 1).cast("decimal(20,0)")).cast("string")
        return F.substring(column, 1, len(os.path.commonprefix([a, b])) + 2)

    keys = df.where(F.col(column).isNotNull())
    cover = [(lo, hi)]
    for _ in range(REFINEMENTS):
        which = reduce(lambda e, ab: e.when(F.col(column) <= F.lit(ab[1][1]), F.concat(F.lit(f"{ab[0]}:"), bin_of(*ab[1], bins // len(cover) + 1))), enumerate(cover), F)
        found = keys.groupBy(which.alias("_bin")).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
        held = sorted((r.lo, r.hi) for r in found.limit(16 * bins + 1).collect())
        if len(held) > 16 * bins:  # text of many beginnings
            break
        gaps = sorted(range(1, len(held)), key=lambda i: at(held[i][0]) - at(held[i - 1][1]), reverse=True)
        ends = [0, *sorted(gaps[: intervals - 1]), len(held)]
        former, cover = cover, [(held[a][0], held[b - 1][1]) for a, b in zip(ends, ends[1:])]
        if 2 * covered(cover) > covered(former):
            break
    return tuple(cover)


def _is_wide(n: int, lo: Any, hi: Any) -> bool:
    """Whether one range from ``lo`` to ``hi`` may hold far more than ``n`` keys."""
    if n < 2 or lo is None or lo == hi:
        return False
    return hi - lo > SPARSE * n if isinstance(lo, int) else isinstance(lo, str)


def _key_sets(df: DataFrame, r, columns: list[str], max_rows: int) -> dict[str, KeySet]:
    n = r["_n"]
    log.info("key set %s: %s rows", columns, n)
    out = {}
    for c in columns:
        lo, hi = r[f"_lo_{c}"], r[f"_hi_{c}"]
        cover = interval_cover(df, c, lo, hi) if _is_wide(n, lo, hi) else ()
        out[c] = KeySet(df, c, n, lo, hi, n <= max_rows, cover)
    return out


def measure_keys(df: DataFrame, columns: list[str], max_rows: int) -> dict[str, KeySet]:
    """One aggregation job: row count and min/max of each key column of ``df``
    (meant for a checkpointed frame), as a ``KeySet`` per column."""
    return _key_sets(df, df.agg(*_key_aggs(columns)).first(), columns, max_rows)


def checkpoint_and_measure(
    df: DataFrame, columns: list[str], max_rows: int
) -> tuple[DataFrame, dict[str, KeySet]]:
    """Checkpoint ``df`` (reliable, to the session's checkpoint folder) and
    measure its key sets in the same job: the count and ranges are observed
    metrics (``DataFrame.observe``) collected while the checkpoint is written."""
    obs = Observation(f"keys-{uuid.uuid4().hex}")
    ck = df.observe(obs, *_key_aggs(columns)).checkpoint(eager=True)
    return ck, _key_sets(ck, obs.get, columns, max_rows)


def checkpoint_and_size(df: DataFrame) -> tuple[DataFrame, int]:
    """Checkpoint ``df`` and measure its bytes (``byte_size``) in the same job."""
    ensure_checkpoint_dir(df.sparkSession)
    obs = Observation(f"size-{uuid.uuid4().hex}")
    ck = df.observe(obs, F.sum(byte_size(df)).alias("bytes")).checkpoint(eager=True)
    return ck, obs.get["bytes"] or 0
