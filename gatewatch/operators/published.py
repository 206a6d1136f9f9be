"""Drop transactions an earlier report already listed (FLT7, JOIN10, SET4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.operators.broadcast import maybe_broadcast


def exclude_ids(df: DataFrame, published: DataFrame, published_small: bool = False, id_col: str = "transaction_id") -> DataFrame:
    """Left anti join on a NULL-safe id match.

    The source's membership test is two-valued: a NULL in the published list
    never hides other ids (``NOT IN`` would return nothing) and a NULL id
    matches a published NULL. ``<=>`` as the join key gives exactly that and
    still plans as a hash join.
    """
    p = maybe_broadcast(published.select(F.col(id_col).alias("_pub_id")), published_small)
    return df.join(p, df[id_col].eqNullSafe(p["_pub_id"]), "left_anti")
