"""Written intermediate tables and joins whose broadcast is checked by size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.session import stage_path

# Rows of a key table that may be broadcast (keys of at most some 50 bytes:
# about 100 MB in each executor). Beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: cuts
    lineage, and later readers prune columns."""
    path = stage_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``rows`` rows; else leave
    the join to the planner, which shuffles both sides. ``df`` should be a
    staged table: it is counted here."""
    return F.broadcast(df) if df.count() <= rows else df


def keep_where(df: DataFrame, keys: DataFrame, on: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is (``left_semi``) or is not (``left_anti``) in
    the staged table ``keys``; columns as in ``df``."""
    return df.join(sized(keys), list(on), how).select(*[F.col(f"`{c}`") for c in df.columns])
