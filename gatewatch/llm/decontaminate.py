"""Benchmark decontamination: size-partitioned MinHash containment search.

A benchmark item is contained in a document if the document has at least
``CONTAINMENT`` of the item's distinct five-word shingles. Items are short and
documents long, so a plain MinHash of the documents would find nothing:
their Jaccard similarity is tiny even at full containment. Therefore

1. a document's domain is its set of shingles that any item has (others
   cannot contribute); equal domains are searched once;
2. domains and items are partitioned by size (powers of two), and for each
   pair of partitions the containment threshold becomes a Jaccard threshold
   from the partition's upper bound and the item's lower bound;
3. the number of one-row bands of a pair of partitions is the least that
   misses a pair at that threshold with a probability under ``MISS``;
4. pairs that share a band value are verified by exact containment.

DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.tables import keep_where, sized, staged
from gatewatch.llm.words import SHINGLE, ascii_lower, words

CONTAINMENT = 75  # percent
MISS = 1e-9


def shingle_hashes(w: Column) -> Column:
    """64-bit hash of every five-word shingle of a words array, in order."""
    part = lambda i, k: F.get(w, i + k)
    return F.when(
        F.size(w) >= SHINGLE,
        F.transform(F.sequence(F.lit(0), F.size(w) - SHINGLE), lambda i: F.xxhash64(*[part(i, k) for k in range(SHINGLE)])),
    ).otherwise(F.array().cast("array<bigint>"))


def _shingled(df: DataFrame, text: str, *keep: Column) -> DataFrame:
    d = df.select(*keep, words(ascii_lower(F.coalesce(F.col(f"`{text}`"), F.lit("")))).alias("__w"))
    names = [c for c in d.columns if c != "__w"]
    return d.select(*names, F.array_distinct(shingle_hashes(F.col("__w"))).alias("shingles"))


def bands(size_class: int, item_class: int, percent: int = CONTAINMENT, miss: float = MISS) -> int:
    """Bands for domains of at most 2**size_class and items of more than
    2**(item_class - 1) shingles."""
    c = percent / 100
    q = 2**item_class // 2 + 1
    x = max(2**size_class, q * c)
    j = min(q * c / (x + q - q * c), 0.999999)
    return math.ceil(math.log(miss) / math.log1p(-j))


def _class(n: Column) -> Column:
    return F.ceil(F.log2(n)).cast("int")


def _signed(sets: DataFrame, key: str, n_bands: Column) -> DataFrame:
    """(key, other class, band, value): one row per band of each partition pair."""
    s = sets.withColumn("band", F.explode(F.sequence(F.lit(0), n_bands - 1)))
    return s.select(key, "shingles", "band").withColumn(
        "value", F.array_min(F.transform("shingles", lambda x: F.xxhash64(x, "band")))
    ).select(key, "band", "value")


def find_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id",
    percent: int = CONTAINMENT, miss: float = MISS,
) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared`` for each row of ``docs`` and item
    contained in it (n_shared * 100 >= percent * n_item; distinct shingles).

    Items and documents of fewer than five words, or null, have no shingles
    and are in no result. Repeated rows and repeated items give repeated
    results (one per pair of ids and distinct content); empty tables give none.
    Columns other than the named ones are not looked at.
    """
    # One row per distinct item content; ids come back at the end.
    i = _shingled(items, item_text, F.col(f"`{item_key}`").alias("item_id")).where(F.size("shingles") > 0)
    i = staged(i.select("item_id", F.array_sort("shingles").alias("shingles")), "leak-items")
    sets = i.select("shingles").distinct().withColumn("item", F.xxhash64("shingles", F.lit(1)))
    sets = staged(sets.withColumn("n_item", F.size("shingles")).withColumn("item_class", _class(F.size("shingles"))), "leak-sets")
    known = staged(sets.select(F.explode("shingles").alias("shingle")).distinct(), "leak-known")

    # A document's domain: its known shingles. Ids ride along as a list of
    # one so that equal domains can be searched once.
    d = _shingled(docs, text, F.monotonically_increasing_id().alias("__id"), F.col(f"`{key}`").alias("doc_id"))
    hits = d.select("__id", "doc_id", F.explode("shingles").alias("shingle"))
    hits = keep_where(hits, known, ["shingle"])
    domains = hits.groupBy("__id", "doc_id").agg(F.array_sort(F.collect_list("shingle")).alias("shingles"))
    domains = staged(domains.select("doc_id", "shingles", F.md5(F.concat_ws(",", F.transform("shingles", lambda x: x.cast("string")))).alias("domain")), "leak-domains")

    # A domain smaller than every threshold cannot contain any item. Classes
    # are powers of two: a few dozen at most, whatever the number of items.
    classes = {r[0]: r[1] for r in sets.groupBy("item_class").agg(F.min("n_item")).collect()}
    x = domains.groupBy("domain").agg(F.first("shingles").alias("shingles"))
    x = x.where(F.size("shingles") * 100 >= min(classes.values(), default=1) * percent)
    x = staged(x.withColumn("size_class", _class(F.size("shingles"))), "leak-distinct")

    # Bands that each size class needs against each class of the other side.
    sizes = [r[0] for r in x.select("size_class").distinct().collect()]
    pairs = [(s, q, bands(s, q, percent, miss)) for s in sizes for q, n in classes.items() if 100 * 2**s >= n * percent]
    most = lambda k: F.coalesce(
        *[F.when(F.col(("size_class", "item_class")[k]) == c, F.lit(max(p[2] for p in pairs if p[k] == c))) for c in sorted({p[k] for p in pairs})],
        F.lit(0),
    )
    left = x.withColumn("n", most(0)).where("n > 0")
    right = sets.withColumn("n", most(1)).where("n > 0")
    a = _signed(left, "domain", F.col("n"))
    b = _signed(right, "item", F.col("n"))
    found = a.join(sized(staged(b, "leak-signatures")), ["band", "value"]).select("domain", "item").distinct()

    # Exact verification on the domains (containment is the same as on the texts).
    v = found.join(x.select("domain", F.col("shingles").alias("__x")), "domain")
    v = v.join(sized(sets.select("item", "n_item", F.col("shingles").alias("__q"))), "item")
    v = v.withColumn("n_shared", F.size(F.array_intersect("__x", "__q"))).where(F.col("n_shared") * 100 >= F.col("n_item") * percent)
    v = v.select("domain", F.col("__q").alias("shingles"), "n_item", "n_shared")
    v = v.join(i, "shingles").select("domain", "item_id", "n_item", "n_shared")
    return domains.select("doc_id", "domain").join(v, "domain").select(
        "doc_id", "item_id", F.col("n_item").cast("long").alias("n_item"), F.col("n_shared").cast("long").alias("n_shared")
    )


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that contain no item; all columns unchanged. Each
    row is decided by its own text, whatever its id, by a 128-bit digest."""
    digest = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary"))
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"), digest.alias("digest"))
    leaks = staged(find_leaks(packed, items, "text", "digest").select(F.col("doc_id").alias("digest")).distinct(), "leak-ids")
    kept = keep_where(packed.select("row", "digest"), leaks, ["digest"], "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
