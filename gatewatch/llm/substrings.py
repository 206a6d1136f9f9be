"""Exact substring removal with suffix sorting.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else
is removed. All starts of all texts cannot be sorted at a bearable cost, so
starts that cannot repeat are ruled out first, without loss: each string has an
anchor, the least (by hash, leftmost) of its ``GRAM``-byte grams. Equal strings
have equal anchors at equal places, so only strings whose anchor gram occurs
again need a look.

1. Anchors of every distinct text, with the run of starts each one serves.
2. The context of each repeated anchor (all bytes its strings touch); contexts
   that are equal byte for byte are counted by a partial aggregation, which
   settles copies without comparing them.
3. Distinct contexts of one anchor gram are sorted twice, by what follows the
   anchor and by what precedes it (reversed), with deep-shallow sorting. Two
   strings at distance ``o`` before their anchors are equal if the common
   prefixes reach ``LENGTH - o`` to the right and ``o`` to the left.
   Grams with more than ``HOT`` distinct contexts are instead spread over the
   cluster by a digest of each string and counted: no group grows unbounded.
4. Removed ranges go back to the texts by their digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.suffixes import order_within
from gatewatch.llm.tables import sized, staged
from gatewatch.llm.words import mix, powers, prefix_hash, slabs

LENGTH = 400
GRAM = 64
HOT = 4_000
BLOCK = 10_000  # contexts sorted at once in a task
PIECE = 1 << 20  # bytes of a long text handled at once
_BITS = np.uint64(24)
_MASK = np.uint64((1 << 24) - 1)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of every window of ``width``: running minima of blocks."""
    n = len(keys) - width + 1
    pad = np.full(-len(keys) % width, np.iinfo(np.uint64).max, np.uint64)
    blocks = np.concatenate([keys, pad]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(text, anchor, first start, last start, gram hash) of every run of
    starts with one anchor; positions are relative to their text."""
    n = len(data)
    if n < length:
        return [np.zeros(0, np.int64)] * 5
    h = prefix_hash(data)
    g = mix((h[gram:] - h[:-gram]) * powers(n)[1][: n - gram + 1])
    keys = (g >> _BITS << _BITS) | np.arange(len(g), dtype=np.uint64)
    at = (_least(keys, length - gram + 1) & _MASK).astype(np.int64)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(at)]
    p = np.flatnonzero(np.arange(len(at)) + length <= ends)
    if not len(p):
        return [np.zeros(0, np.int64)] * 5
    a = at[p]
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (p[1:] != p[:-1] + 1)]))
    last = np.concatenate([new[1:], [len(p)]]) - 1
    text = np.searchsorted(offsets, p[new], side="right") - 1
    base = offsets[text]
    return text, a[new] - base, p[new] - base, p[last] - base, g[a[new]].view(np.int64)


def _pieces(data, offsets, length: int):
    """(base of the positions, bytes, offsets); a long text comes in pieces
    that overlap by ``length - 1`` bytes, so each start is in one of them."""
    if len(offsets) > 2 or len(data) <= 2 * PIECE:
        yield 0, data, offsets
        return
    for lo in range(0, len(data) - length + 1, PIECE):
        part = data[lo : lo + PIECE + length - 1]
        yield lo, part, np.array([0, len(part)])


def _anchor_rows(d: DataFrame, length: int, gram: int) -> DataFrame:
    names = ["key", "row", "gram", "at", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, data, offsets in slabs(batch.column("text")):
                for base, part, offs in _pieces(data, offsets, length):
                    text, at, first, last, g = anchors(part, offs, length, gram)
                    rows = pa.array(text + lo)
                    cols = [batch.column("key").take(rows), batch.column("row").take(rows), g, at + base, first + base, last + base]
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=names)

    return d.select("key", "row", "text").mapInArrow(run, "key string, row long, gram long, at long, lo long, hi long")


def _contexts(d: DataFrame, length: int) -> DataFrame:
    """One row per anchor of ``spots``: its context and where it lies."""
    names = ["gram", "key", "at", "back", "least", "context", "same"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, spots in zip(batch.column("key").to_pylist(), batch.column("text"), batch.column("spots")):
                raw = memoryview(text.as_buffer())
                rows = []
                for s in spots.as_py():
                    part = bytes(raw[s["lo"] : s["hi"] + length])
                    back, least = s["at"] - s["lo"], s["at"] - s["hi"]
                    same = hashlib.md5(b"%d %d " % (back, least) + part).digest()
                    rows.append((s["gram"], key, s["at"], back, least, part, same))
                    if len(rows) == BLOCK:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    return d.mapInArrow(run, "gram long, key string, at long, back long, least long, context binary, same binary")


def repeated_starts(group: np.ndarray, contexts: list[bytes], back: np.ndarray, least: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Boolean matrix: row, distance before the anchor -> the string that
    starts there equals one of another row of the same group."""
    n, top = len(contexts), int(back.max(initial=0)) + 1
    flags = np.zeros((n, top), bool)
    right, rl = order_within([c[b:] for c, b in zip(contexts, back.tolist())], group)
    left, ll = order_within([c[:b][::-1] for c, b in zip(contexts, back.tolist())], group)
    rc, lc = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(int(least.min(initial=0)), top):
        rows = np.flatnonzero((least <= o) & (o <= back))
        if len(rows) < 2:
            continue
        rc[right] = np.cumsum(rl < length - o)
        lc[left] = np.cumsum(ll < o)
        both = rc[rows] * (n + 1) + lc[rows]
        by = np.argsort(both, kind="stable")
        same = both[by][1:] == both[by][:-1]
        hit = np.zeros(len(rows), bool)
        hit[by[1:]] |= same
        hit[by[:-1]] |= same
        flags[rows[hit], o] = True
    return flags


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first column, last column) of the runs of true cells."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edge == 1)
    return row, first, np.nonzero(edge == -1)[1] - 1


def _sorted_ranges(d: DataFrame, length: int) -> DataFrame:
    """``same, least, most``: distances at which a context's strings repeat.
    Input rows are sorted by gram inside partitions that hold whole grams."""
    cols = ["gram", "same", "back", "least", "context"]

    def settle(table: pa.Table) -> pa.RecordBatch:
        gram = table.column("gram").to_numpy()
        group = np.cumsum(np.concatenate([[0], gram[1:] != gram[:-1]])) if len(gram) else gram
        flags = repeated_starts(group, table.column("context").to_pylist(), table.column("back").to_numpy(), table.column("least").to_numpy(), length)
        row, least, most = _runs(flags)
        same = table.column("same").combine_chunks().take(pa.array(row))
        same = same.combine_chunks() if isinstance(same, pa.ChunkedArray) else same
        return pa.RecordBatch.from_arrays([same, pa.array(least), pa.array(most)], names=["same", "least", "most"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK:  # all but the last gram, which may go on
                table = pa.Table.from_batches(held)
                gram = table.column("gram").to_numpy()
                cut = int(np.flatnonzero(gram != gram[-1])[-1]) + 1 if gram[0] != gram[-1] else 0
                if cut:
                    yield settle(table.slice(0, cut))
                held, n = table.slice(cut).to_batches(), table.num_rows - cut
        if n:
            yield settle(pa.Table.from_batches(held))

    return d.select(*cols).mapInArrow(run, "same binary, least long, most long")


def _hot_ranges(d: DataFrame, length: int) -> DataFrame:
    """As ``_sorted_ranges`` for grams with very many contexts: every string is
    counted by its digest, with partial counts before the exchange."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for gram, same, back, least, c in zip(*(batch.column(i).to_pylist() for i in range(5))):
                at = list(range(least, back + 1))
                digest = [hashlib.md5(c[back - o : back - o + length]).digest() for o in at]
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([gram] * n), pa.array([same] * n, pa.binary()), pa.array(at), pa.array(digest, pa.binary())], names=["gram", "same", "o", "digest"]
                )

    each = d.select("gram", "same", "back", "least", "context").mapInArrow(run, "gram long, same binary, o long, digest binary")
    twice = each.groupBy("gram", "o", "digest").agg(F.count("*").alias("m")).where("m > 1")
    return each.join(twice, ["gram", "o", "digest"], "left_semi").select("same", F.col("o").alias("least"), F.col("o").alias("most"))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of half-open ranges."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def _cut(d: DataFrame) -> DataFrame:
    names = ["key", "spans", "n_removed", "kept_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, ranges in zip(batch.column("key").to_pylist(), batch.column("text"), batch.column("ranges").to_pylist()):
                raw, at, kept = memoryview(text.as_buffer()), 0, hashlib.sha256()
                spans = merged([(r["a"], r["b"]) for r in ranges])
                for a, b in spans:
                    kept.update(raw[at:a])
                    at = b
                kept.update(raw[at:])
                rows.append((key, [{"a": a, "b": b} for a, b in spans], sum(b - a for a, b in spans), kept.hexdigest()))
            if rows:
                kinds = [pa.string(), pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return d.select("key", "text", "ranges").mapInArrow(run, "key string, spans array<struct<a:long,b:long>>, n_removed long, kept_sha256 string")


def repeated_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` per row.

    ``spans`` are the removed byte ranges (a to b, end exclusive). Null texts
    count as empty; texts shorter than ``length`` lose nothing; repeated rows
    and exact copies of at least ``length`` bytes are removed whole, each one;
    an empty table gives an empty result. Other columns are not looked at.
    """
    d = docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    d = d.select("doc_id", "text", F.md5("text").alias("key"), F.xxhash64("doc_id", "text").alias("row"))
    slim = staged(d.select("doc_id", "key", "row", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole")), "cut-rows")
    copies = slim.groupBy("key").agg(F.count("*").alias("copies"), F.min("row").alias("row"))
    repeated = not slim.groupBy("row").count().where("count > 1").isEmpty()

    # Copies have equal anchors: one row each after a partial aggregation.
    spots = _anchor_rows(d.where(F.octet_length("text") >= length), length, gram)
    spots = staged(spots.groupBy("gram", "key", "at", "lo", "hi").agg(F.min("row").alias("row")), "cut-spots")
    again = spots.groupBy("gram").agg(F.count("*").alias("m")).where("m > 1").select("gram")
    spots = spots.join(again, "gram").groupBy("key", "row").agg(F.collect_list(F.struct("gram", "at", "lo", "hi")).alias("spots"))
    spots = staged(spots, "cut-repeated")

    def texts(wanted: DataFrame) -> DataFrame:
        """Texts of ``wanted`` rows, once per key; filtered before the exchange."""
        some = d.join(sized(wanted.select("row")), "row", "left_semi").select("row", "text").join(wanted, "row")
        return some.dropDuplicates(["key"]) if repeated else some

    c = staged(_contexts(texts(spots).select("key", "text", "spots"), length), "cut-contexts")
    kinds = staged(c.groupBy("gram", "same").agg(F.count("*").alias("m"), F.min(F.struct("key", "at")).alias("one")), "cut-kinds")
    crowd = kinds.groupBy("gram").agg(F.count("*").alias("kinds")).where("kinds > 1")
    one = kinds.join(crowd, "gram").select("gram", "same", "kinds", F.col("one.key").alias("key"), F.col("one.at").alias("at"))
    distinct = c.join(one, ["gram", "same", "key", "at"]).select("gram", "same", "back", "least", "context", "kinds")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    calm = distinct.where(F.col("kinds") <= HOT).repartition(parts, "gram").sortWithinPartitions("gram")
    ranges = staged(_sorted_ranges(calm, length), "cut-sorted")
    if not crowd.where(F.col("kinds") > HOT).isEmpty():
        ranges = ranges.union(staged(_hot_ranges(distinct.where(F.col("kinds") > HOT), length), "cut-hot"))
    ranges = ranges.union(c.join(kinds.where("m > 1").select("gram", "same"), ["gram", "same"]).select("same", "least", F.col("back").alias("most")).distinct())

    # Back from contexts to texts; whole copies are settled by their number.
    found = c.select("same", "key", "at").join(ranges, "same").select("key", (F.col("at") - F.col("most")).alias("a"), (F.col("at") - F.col("least") + length).alias("b"))
    found = found.distinct().groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    found = staged(found.join(copies, "key").where("copies = 1").select("key", "row", "ranges"), "cut-ranges")
    cut = staged(_cut(texts(found)), "cut-texts")
    out = slim.join(copies.select("key", "copies"), "key").join(cut, "key", "left")
    gone = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    every = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n_bytes").alias("b")))
    spans = F.when(gone, every).otherwise(F.coalesce("spans", F.array().cast("array<struct<a:bigint,b:bigint>>")))
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
        spans.alias("spans"),
    )
