"""Connected components by alternating large-star and small-star steps.

Every step is a partial aggregation and a join over the edges, so no
component, hub or edge list meets in one task or in the driver. Each round is
written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.tables import staged


def _large(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u, root`` for every end of ``edges`` (u, v) but the roots themselves;
    ``root`` is the least end of the component. Repeated, reversed and self
    edges are harmless; no edges give no rows."""
    e = edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, seen = staged(e, "star"), None
    while True:
        e = staged(_small(_large(e)), "star")
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == seen or not state[0]:
            return e.select("u", F.col("v").alias("root"))
        seen = state
