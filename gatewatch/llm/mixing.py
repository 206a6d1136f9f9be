"""Mixing sources to target weights, with DataFrame functions only.

Words are summed per source, every source gets a target, and the ratio of
target to size is the source's repetition rate. Each document is taken
floor(rate) times, plus one copy more if a hash of the seed and its id falls
below the fraction of the rate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.llm.tables import staged
from gatewatch.llm.words import WORD

MAX_RATE = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
_UNIT = 16.0**13


def size_of(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(key: Column, digest: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the MD5 of the seed, the key and the text's MD5
    (null: '')."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(digest, F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(_UNIT)


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """``source, source_size`` -> plus ``target`` (double), one row per source.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    the sum of all sizes. A target stops at ``max_rate`` times its source's
    size; the excess goes to the others by weight. Closed form: in ascending
    order of cap / weight, the sources before the first one whose cap is not
    exceeded by the level that is left stay at their caps, the rest get the
    level times their weight (that level is the highest one within a cap). The windows run over one row per source, not
    over documents.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("__r") - 1, F.lit(len(weights))) + 1)
    s = sizes.withColumn("__r", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("int"))
    s = s.select("source", "source_size", weight.alias("__w"), (F.col("source_size") * max_rate).alias("__cap"), "__r")
    before = Window.orderBy(F.col("__cap") / F.col("__w"), "__r").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    s = s.withColumns(
        {
            "__left": F.sum("source_size").over(whole) - F.coalesce(F.sum("__cap").over(before), F.lit(0)),
            "__weights": F.sum("__w").over(whole) - F.coalesce(F.sum("__w").over(before), F.lit(0)),
        }
    )
    level = F.col("__left").cast("double") / F.col("__weights").cast("double")
    s = s.withColumn("__level", F.max(F.when(level * F.col("__w") <= F.col("__cap"), level)).over(whole))
    target = F.least(F.col("__cap").cast("double"), F.coalesce(F.col("__level") * F.col("__w"), F.col("__cap").cast("double")))
    return s.select("source", "source_size", target.alias("target"))


def mix_plan(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", seed: str = SEED) -> DataFrame:
    """``doc_id, size, source_size, target, copies`` for every row of ``docs``.

    The measured sizes are staged once, so texts are read a single time. The
    sums are partial before the exchange, so a hot source costs one row per
    task; its rows meet the small table of targets in a join that is planned
    from run-time sizes (skewed sides are split). Null text has size 0, null
    sources form a source of their own; each (id, text) has a draw of its own, so
    only rows that repeat both share one; an empty table gives an empty plan; other columns are not looked at.
    """
    d = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        size_of(F.col(f"`{text}`")).alias("size"),
        F.md5(F.col(f"`{text}`")).alias("digest"),
    )
    d = staged(d, "mix-sizes")
    targets = source_targets(d.groupBy("source").agg(F.sum("size").alias("source_size")))
    t = targets.select(F.col("source").alias("__s"), "source_size", "target")
    j = d.join(t, F.col("source").eqNullSafe(F.col("__s")), "left")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = unit_hash(F.col("doc_id"), F.col("digest"), seed) < F.col("__rate") - F.floor("__rate")
    return j.withColumn("__rate", rate).select(
        "doc_id", "source", "size", "source_size", "target", (F.floor("__rate") + extra.cast("long")).cast("long").alias("copies")
    )


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", seed: str = SEED) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the plan takes it,
    all columns unchanged, plus ``copy_no`` (1, 2, ...; it must not exist yet).

    The copies follow from the row itself and its source's rate, so only the
    small table of rates is joined to the texts.
    """
    if "copy_no" in docs.columns:
        raise ValueError("docs already has a column copy_no")
    sizes = staged(docs.select(F.col(f"`{source}`").alias("source"), size_of(F.col(f"`{text}`")).alias("size")).groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    t = source_targets(sizes).where("source_size > 0").select(F.col("source").alias("__s"), (F.col("target") / F.col("source_size")).alias("__rate"))
    j = docs.select(F.struct("*").alias("__row")).join(
        t, F.col("__row").getField(source).eqNullSafe(F.col("__s")), "inner"
    )
    extra = unit_hash(F.col("__row").getField(key), F.md5(F.col("__row").getField(text)), seed) < F.col("__rate") - F.floor("__rate")
    copies = (F.floor("__rate") + extra.cast("long")).cast("int")
    j = j.withColumn("__n", copies).where("__n > 0")
    j = j.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("__n"))))
    return j.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns], "copy_no")
