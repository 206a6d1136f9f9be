"""Audit of filters that overlap: what every order of five filters removes.

A filter's verdict on a document does not depend on what was removed before it.
So a document is known by the set of filters it fails, and a part (language) by
how many documents fail each of the 32 sets. Of a coalition S of filters the
removal game's worth v(S) is the number of documents that fail one of S. Then

* the filter f after the coalition S removes v(S + f) - v(S): coalition
  differences supply every step of all 120 orders;
* the Hart-Mas-Colell potential P(S) = (v(S) + sum of P(S - i) over i in S) / |S|,
  P of nothing being 0, is computed by size over the 32 coalitions, and the
  Shapley value of f is P(all) - P(all - f). It is kept whole as
  Q(S) = |S|! P(S) = (|S| - 1)! v(S) + sum of Q(S - i); the removals of f summed
  over all 120 orders are Q(all) - 5 Q(all - f).

The documents are read once, by one projection; what is shuffled is one narrow
row per document (a digest of the text, never the text), and later counts.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_UPPER_PERCENT = 3
SIGNS = "#$%&*|"

_FULL = (1 << len(FILTERS)) - 1
_UPPER = bytes(range(65, 91))
_COPY = 1 << FILTERS.index("E")


def _own_failures(text: str) -> int:
    """Bits of the filters A to D that a whole text fails. ``bytes.split``
    splits at exactly the six ASCII blanks."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    upper = len(data) - len(data.translate(None, _UPPER))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
        | (100 * upper > MAX_UPPER_PERCENT * len(text)) << 2
        | (len(data.translate(None, SIGNS.encode())) < len(data)) << 3
    )


def _judged(docs: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """``doc_id, part, digest, own``: one narrow row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, digest = [], []
            for value in batch.column(2):
                value = value.as_py() or ""
                own.append(_own_failures(value))
                digest.append(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).digest())
            part_ = pc.fill_null(batch.column(1), "")
            yield pa.RecordBatch.from_arrays([batch.column(0), part_, pa.array(digest, pa.binary()), pa.array(own, pa.int32())], names=["doc_id", "part", "digest", "own"])

    d = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{part}`").cast("string").alias("part"), F.col(f"`{text}`").cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, part string, digest binary, own int")


def failures(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """``part, mask, n, good, toxic``: how many documents of a part fail exactly
    the filters in ``mask`` (bit 0 is A), and how many of them are labelled
    quality=1 and toxic=1.

    Equal texts fail the same of A to D, so a text counts once per (part,
    labels) before texts meet across the table: a text that holds a third of
    all rows moves a few rows per map task.
    """
    judged = _judged(docs, key, text, part)
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").where("doc_id IS NOT NULL").groupBy("doc_id")
    marks = marks.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    judged = judged.join(marks, "doc_id", "left")
    judged = judged.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})

    same = ["digest", "own", "part", "good", "toxic"]
    ids = judged.groupBy("doc_id", *same).agg(F.count("*").alias("m"))
    named = F.col("doc_id").isNotNull()
    texts = ids.groupBy(*same).agg(
        F.sum("m").alias("n"),
        F.sum(F.when(~named, F.col("m")).otherwise(0)).alias("unnamed"),
        F.min("doc_id").alias("least"),
        F.min_by("m", "doc_id").alias("rows"),
    )
    # The rows of a text are now at most four for each part.
    first = F.min("least").over(Window.partitionBy("digest"))
    texts = texts.withColumn("first", first)
    origin = F.col("unnamed") + F.when(F.col("least") == F.col("first"), F.col("rows")).otherwise(0)
    split = F.array(
        F.struct(F.col("own").alias("mask"), origin.alias("n")),
        F.struct(F.col("own").bitwiseOR(F.lit(_COPY)).alias("mask"), (F.col("n") - origin).alias("n")),
    )
    rows = texts.select("part", "good", "toxic", F.inline(split))
    count = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), count("good"), count("toxic"))


def _members(coalition: int) -> list[int]:
    return [i for i in range(len(FILTERS)) if coalition >> i & 1]


def potentials(worth: list[Column]) -> list[Column]:
    """Q(S) = |S|! P(S) of all coalitions, in the order of their numbers."""
    q = {0: F.lit(0).cast("long")}
    for s in sorted(range(1, _FULL + 1), key=lambda s: s.bit_count()):
        total = worth[s] * factorial(s.bit_count() - 1)
        for i in _members(s):
            total = total + q[s & ~(1 << i)]
        q[s] = total
    return [q[s] for s in range(_FULL + 1)]


def _steps() -> str:
    rows = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            rows.append({"filter_order": "".join(FILTERS[i] for i in order), "step": step, "f": f, "before": before, "after": before | 1 << f})
            before |= 1 << f
    return json.dumps(rows)


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per part, order of the five filters and step: ``part,
    filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley`` (all counts long).

    A: under 200 words; B: distinct words below half of the words; C: A-Z above
    3% of the code points; D: one of ``#$%&*|``; E: a smaller id holds the same
    text anywhere in the table. Null texts are empty (they fail A, and E among
    themselves); a null part is the empty string, as an empty one; a row without
    an id is no copy and makes none; rows of one id are no copies of each
    other. An id is good (toxic) if one of its label rows says so. Very long
    texts are read whole. No documents give no rows; no labels lose none; other
    columns are not looked at.
    """
    masks = failures(docs, labels, key, text, part)
    fails = lambda s, c: F.sum(F.when(F.col("mask").bitwiseAND(F.lit(s)) != 0, F.col(c)).otherwise(0))
    game = masks.groupBy("part").agg(F.sum("n").alias("total"), *[fails(s, c).alias(f"{c}{s}") for c in ("n", "good", "toxic") for s in range(_FULL + 1)])
    listed = lambda c: [F.col(f"{c}{s}") for s in range(_FULL + 1)]
    q = potentials(listed("n"))
    shares = [q[_FULL] - len(FILTERS) * q[_FULL & ~(1 << i)] for i in range(len(FILTERS))]
    game = game.select("part", "total", *[F.array(*listed(c)).alias(c) for c in ("n", "good", "toxic")], F.array(*shares).alias("shares"))

    steps = F.from_json(F.lit(_steps()), "array<struct<filter_order: string, step: int, f: int, before: int, after: int>>")
    rows = game.select("*", F.inline(steps))
    gain = lambda c: F.get(c, F.col("after")) - F.get(c, F.col("before"))
    alone = F.expr("shiftleft(1, f)")
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.get("n", F.col("after"))).alias("kept"),
        gain("n").alias("removed"),
        (F.get("n", alone) - gain("n")).alias("redundant"),
        (F.get("n", F.lit(_FULL)) - F.get("n", F.lit(_FULL) - alone)).alias("unique_fails"),
        gain("good").alias("good_lost"),
        gain("toxic").alias("toxic_lost"),
        F.get("shares", F.col("f")).alias("shapley"),
    )
