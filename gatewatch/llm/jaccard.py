"""N-gram Jaccard join by grouped prefixes, and the components of its links.

A document's set is its distinct five-word shingles. All shingles have one
global order: first by the count of their hash bucket, one of a fixed number (rare
first), then by hash. A shingle that a given share of all documents has stands
out of its bucket the more, the larger the corpus. Two sets of a similarity of at least t share a shingle of their
prefixes, the first n - ceil(t n) + 1 shingles. Documents of equal prefix and
size form one group, and only groups are looked up by shingle; group pairs
pass a size filter and are then expanded to their members and verified on the
whole sets.

The result needs the components, not all pairs, so similar members of a bucket
never meet pairwise: each group is first verified against one pivot, of the
pivots of its buckets the one met most often; the pivot of a bucket is the group
that meets most others over all its buckets. Buckets that then still hold far more
pairs of components than members go through further rounds with other pivots,
as long as those rounds settle many pairs. Of the members of a bucket that are then still in different
components, only those are paired and verified, whatever their number, that can still share enough:
if two prefixes must have q shingles in common, the bucket must not be among the
last q - 1 of either, the most common ones. A link is thereby
either verified or lies within a component already, so none is lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatewatch.llm.components import components
from gatewatch.llm.tables import keep_where, sized, staged
from gatewatch.llm.words import WORD, mix, shingle_sets, slabs

PERCENT = 75
BUCKETS = 1 << 22  # counters of the shingle order; fixed, whatever the corpus
BLOCK = 1 << 16  # counters that travel together
HOT = 20_000  # members of a shingle's bucket handled together
TOGETHER = 500  # sets verified against one pivot in a task
DENSE = 4  # pairs of different components for each bucket place that call for a round
WORTH = 0.5  # a round that leaves more than this share of the pairs is the last


def _digests(s: np.ndarray) -> tuple[int, int]:
    """128 bits that identify a sorted set of hashes."""
    if not len(s):
        return 0, 0
    at = np.arange(1, len(s) + 1, dtype=np.uint64)
    a = mix(s + at * np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    b = mix(s ^ mix(at * np.uint64(0xA0761D6478BD642F) + np.uint64(len(s)))).sum(dtype=np.uint64)
    pair = np.array([a, b], np.uint64).view(np.int64)
    return int(pair[0]), int(pair[1])


def _bucket_counts(docs: DataFrame) -> dict[int, bytes]:
    """Document count of every hash bucket: ``BUCKETS`` numbers in all. Tasks
    give them on in blocks, which are added up as they stream by. The driver
    only passes the sums on, deflated; a block without documents is left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, data, offsets in slabs(batch.column(0)):
                found = [s for s in shingle_sets(data, offsets) if len(s)]
                if found:
                    np.add.at(total, (np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
        for block, part in enumerate(total.reshape(-1, BLOCK)):
            if part.any():
                width = next(w for w in (1, 2, 4, 8) if part.max() < 1 << 8 * w)
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([width]), pa.array([part.astype(f"<u{width}").tobytes()])], names=names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, width, part in zip(*[c.to_pylist() for c in batch.columns]):
                total.setdefault(block, np.zeros(BLOCK, np.int64))
                total[block] += np.frombuffer(part, f"<u{width}")
        for block, part in total.items():
            part = np.minimum(part, np.iinfo(np.uint32).max).astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([4]), pa.array([zlib.compress(part, 1)])], names=names)

    names, schema = ["block", "width", "counts"], "block long, width long, counts binary"
    blocks = docs.select("text").mapInArrow(count, schema).repartition(BUCKETS // BLOCK, "block").mapInArrow(add, schema)
    return {block: bytes(part) for block, _, part in blocks.collect()}


def _inflated(blocks: dict[int, bytes]) -> np.ndarray:
    """The counts of ``_bucket_counts``."""
    out = np.zeros((BUCKETS // BLOCK, BLOCK), np.uint32)
    for block, part in blocks.items():
        out[block] = np.frombuffer(zlib.decompress(part), "<u4")
    return out.reshape(-1)


def _prefixes(docs: DataFrame, blocks: dict[int, bytes], percent: int) -> DataFrame:
    """One row per document: id, size, set digest (a, b), group and prefix."""
    schema = "doc_id long, row long, n long, a long, b long, grp long, prefix array<struct<token:long,of:long>>"
    token = [pa.field("token", pa.int64()), pa.field("of", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _inflated(blocks)
        # A shingle whose bucket sticks out may be in very many documents: spread.
        usual = 2 * int(counts.mean())
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("row")
            for lo, hi, data, offsets in slabs(batch.column("text")):
                sizes, firsts, seconds, groups, tokens, wide, heads = [], [], [], [], [], [], []
                for s in shingle_sets(data, offsets):
                    n = len(s)
                    a, b = _digests(s)
                    p = n - -(-percent * n // 100) + 1 if n else 0
                    rank = counts[s & np.uint64(BUCKETS - 1)]
                    head = s[np.lexsort((s, rank))[:p]]
                    group = np.array(_digests(head)[0] * 31 + n & (1 << 64) - 1, np.uint64).view(np.int64)
                    sizes.append(n), firsts.append(a), seconds.append(b), groups.append(int(group))
                    parts = 1 + np.maximum(0, counts[head & np.uint64(BUCKETS - 1)].astype(np.int64) - usual) // HOT
                    piece = (abs(int(group)) % parts).astype(np.uint64)
                    # Piece 0 keeps the shingle's hash, the others get their own.
                    tokens.append(np.where(piece > 0, mix(head + piece * np.uint64(0x9E3779B97F4A7C15)), head).view(np.int64))
                    wide.append(parts > 1)
                    heads.append(head.view(np.int64))
                of = pa.array(np.concatenate(heads), mask=~np.concatenate(wide))
                flat = pa.StructArray.from_arrays([pa.array(np.concatenate(tokens)), of], fields=token)
                starts = pa.array(np.cumsum([0, *map(len, tokens)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), keys.slice(lo, hi - lo), *(pa.array(x, pa.int64()) for x in (sizes, firsts, seconds, groups)), pa.ListArray.from_arrays(starts, flat)],
                    names=["doc_id", "row", "n", "a", "b", "grp", "prefix"],
                )

    return docs.select("doc_id", "row", "text").mapInArrow(run, schema)


def _sets(docs: DataFrame) -> DataFrame:
    """``row`` and its whole set as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slabs(batch.column("text")):
                found = [s.tobytes() for s in shingle_sets(data, offsets)]
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(lo, hi - lo), pa.array(found, pa.binary())], names=["node", "hashes"])

    return docs.select("node", "text").mapInArrow(run, "node long, hashes binary")


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (pivot, other) that are similar enough. Each pivot's set meets
    at most ``TOGETHER`` others in a group, whatever the size of its star."""
    piece = F.pmod(F.xxhash64("other"), F.ceil(F.col("m") / TOGETHER).cast("long"))
    large = staged(pairs.groupBy("pivot").agg(F.count("*").alias("m")).where(F.col("m") > TOGETHER), "join-large")
    stars = pairs.join(sized(large), "pivot", "left").select("pivot", "other", F.coalesce(piece, F.lit(0)).alias("piece"))
    stars = staged(stars, "join-stars")
    others = stars.select("pivot", "piece", F.col("other").alias("node"))
    heads = stars.select("pivot", "piece", F.col("pivot").alias("node")).distinct()
    rows = staged(others.union(heads), "join-places")
    rows = sets.join(sized(rows), "node")

    def similar(left: np.ndarray, right: np.ndarray) -> bool:
        both = len(np.intersect1d(left, right, assume_unique=True))
        return 100 * both >= percent * (len(left) + len(right) - both)

    def run(key, table):
        nodes = table.column("node").to_pylist()
        found = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
        pivot = key[0].as_py()
        head = found[nodes.index(pivot)]
        linked = [n for n, s in zip(nodes, found) if n != pivot and similar(head, s)]
        return pa.table({"u": pa.array([pivot] * len(linked), pa.int64()), "v": pa.array(linked, pa.int64())})

    return rows.groupBy("pivot", "piece").applyInArrow(run, "u long, v long")


def _bounds(percent: int):
    """Expressions of two set sizes: whether they can be similar; how many
    common shingles lie beyond the prefix of one of them at most; how many
    common ones they need. Sets whose prefixes share m share at most m plus
    what lies beyond."""
    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent
    beyond = lambda x, y: F.ceil(F.greatest(x, y) * percent / 100) - 1
    needed = lambda x, y: F.ceil((F.col(x) + F.col(y)) * percent / (100 + percent))
    return fits, beyond, needed


def _placed(slots: DataFrame) -> DataFrame:
    """``slots`` with ``tail``: the weight of a node's places from this one on,
    in one order of all places, those in few nodes first."""
    places = slots.repartition("token")
    places = places.join(places.groupBy("token").agg(F.count("*").alias("crowd")), "token")
    whole = Window.partitionBy("node")
    so_far = whole.orderBy("crowd", "token").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tail = F.sum("w").over(whole) - F.sum("w").over(so_far) + F.col("w")
    return staged(places.withColumn("tail", tail).select("token", "node", "n", "comp", "tail"), "join-placed")


def _meetings(placed: DataFrame, percent: int) -> DataFrame:
    """(token, pivot, other, ..) of the nodes of different components that meet
    in a place and can be similar. Nodes that need q common places have one,
    their first, with a tail of at least q in both: later ones need not meet."""
    fits, beyond, needed = _bounds(percent)
    x = placed.select("token", F.col("node").alias("pivot"), F.col("n").alias("xn"), F.col("comp").alias("xc"), F.col("tail").alias("xt"))
    y = placed.select("token", F.col("node").alias("other"), F.col("n").alias("yn"), F.col("comp").alias("yc"), F.col("tail").alias("yt"))
    ahead = (F.col("xn") < F.col("yn")) | ((F.col("xn") == F.col("yn")) & (F.col("pivot") < F.col("other")))
    reach = F.least("xt", "yt") + beyond("xn", "yn") >= needed("xn", "yn")
    return x.join(y, "token").where((F.col("xc") != F.col("yc")) & ahead & fits("xn", "yn") & reach)


def _linked(docs: DataFrame, text: str, key: str, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (``doc_id, row, n, node``; ``row`` is a hash of id and text) and the
    nodes with words (``node, least, root``): their least id and component."""
    d = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    d = d.withColumn("row", F.xxhash64("doc_id", "text"))
    rows = staged(_prefixes(d, _bucket_counts(d), percent), "join-rows")
    node = F.xxhash64("a", "b", "n")
    slim = rows.select("doc_id", "row", "n", node.alias("node"), "grp")
    nodes = staged(
        slim.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"), F.min("row").alias("row"), F.first("n").alias("n"), F.first("grp").alias("grp")),
        "join-nodes",
    )

    # Groups (equal prefix and size), each with one node that stands for it.
    groups = staged(
        nodes.groupBy("grp").agg(F.min_by("row", "node").alias("row"), F.min("node").alias("head"), F.first("n").alias("n"), F.count("*").alias("members")),
        "join-groups",
    )
    prefix = rows.where("n > 0").join(sized(groups.select("grp", "row")), ["grp", "row"], "left_semi")
    prefix = prefix.select("grp", "prefix")
    prefix = prefix.dropDuplicates(["grp"]) if _repeated(slim) else prefix
    entries = prefix.select("grp", F.inline("prefix")).repartition("token")
    sizes = entries.groupBy("token").agg(F.count("*").alias("m"), F.max("of").alias("o"))
    # Buckets of one group are done, unless the shingle is spread over several.
    shared = entries.join(sizes.where("m > 1 OR o IS NOT NULL").drop("o"), "token").select("token", "of", "grp", "m")
    shared = staged(shared, "join-met")
    # The pivot of a bucket is the group that meets most others over all its
    # buckets: the text that many were copied from, rather than one of the
    # copies, which may be too far from each other.
    met = staged(shared.groupBy("grp").agg(F.sum("m").alias("met")), "join-central")
    ranked = shared.join(sized(met), "grp").select("token", "of", "grp", "met").repartition("token")
    pivots = ranked.groupBy("token").agg(F.max_by("grp", F.shiftleft("met", 16) + F.pmod("grp", F.lit(1 << 16))).alias("p"))
    shared = staged(ranked.join(pivots, "token").select("token", "of", "grp", "p"), "join-shared")

    fits, beyond, needed = _bounds(percent)
    pieces = shared.where("of IS NOT NULL").select("of", "p").distinct()
    whole = pieces.groupBy("of").agg(F.min("p").alias("g")).join(pieces, "of").select("g", F.col("p").alias("h"))
    star = shared.select(F.col("p").alias("g"), F.col("grp").alias("h")).union(whole).where("g != h")
    star = star.groupBy("g", "h").agg(F.count("*").alias("m"))
    known = lambda side: groups.select(F.col("grp").alias(side), F.col("head").alias(f"{side}_head"), F.col("n").alias(f"{side}_n"))
    # m may be too low here and in the rounds, which only leaves a pair to a
    # later step.
    enough = lambda x, y: F.col("m") + beyond(x, y) >= needed(x, y)
    star = star.join(known("g"), "g").join(known("h"), "h").where(fits("g_n", "h_n") & enough("g_n", "h_n"))
    pairs = star.groupBy("h").agg(F.max_by(F.struct(F.col("g_head").alias("pivot"), F.col("h_head").alias("other")), F.struct("m", "g")).alias("best")).select("best.*")
    inner = nodes.join(groups.where("members > 1").select("grp", "head"), "grp").select(F.col("head").alias("pivot"), F.col("node").alias("other"))
    pairs = staged(pairs.union(inner).where("pivot != other").distinct(), "join-pairs")

    def verified(candidates: DataFrame, name: str) -> DataFrame:
        wanted = candidates.select(F.explode(F.array("pivot", "other")).alias("node")).distinct()
        wanted = staged(wanted.join(nodes.select("node", "row"), "node"), f"join-wanted-{name}")
        texts = d.select("row", "text").join(sized(wanted), "row")
        sets = _sets(texts.dropDuplicates(["node"]) if _repeated(slim) else texts)
        return staged(_verify(candidates, sets, percent), f"join-links-{name}")

    label = components(verified(pairs, "a"))
    tested = [pairs]

    def labelled(df: DataFrame) -> DataFrame:
        named = sized(label.select(F.col("u").alias("node"), "root"))
        return df.join(named, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")

    # Places (bucket, node) of shingles, and of groups, that still hold several
    # components. Equal prefixes share all their shingles: weight n.
    members = staged(labelled(nodes.select("grp", "node", "n")), "join-members")
    held = staged(members.groupBy("grp").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")), "join-held")
    key = F.coalesce("of", "token").alias("token")
    open_ = shared.join(sized(held), "grp").groupBy(key).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("token")
    open_ = staged(open_, "join-tokens")
    slots = keep_where(shared.select(key, "grp"), open_, ["token"]).join(members, "grp").select("token", "node", "n", "comp", F.lit(1).cast("long").alias("w"))
    inside = members.join(held.where("lo < hi").select("grp"), "grp").select(F.col("grp").alias("token"), "node", "n", "comp", F.col("n").alias("w"))
    slots = staged(slots.union(inside), "join-open")

    turn, before = 0, None
    while True:
        # Pairs of places in different components, by counting.
        crowd = slots.groupBy("token", "comp").agg(F.count("*").alias("m")).groupBy("token").agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("same"))
        crowd = crowd.select("token", ((F.col("m") * F.col("m") - F.col("same")) / 2).alias("pairs"), "m").where(F.col("pairs") > DENSE * F.col("m"))
        dense = staged(crowd, f"join-dense-{turn}")
        left = dense.agg(F.sum("pairs")).first()[0] or 0
        if not left or (before is not None and left > WORTH * before):
            break
        turn, before = turn + 1, left
        places = keep_where(slots, dense.select("token"), ["token"])
        pivot = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("pivot"), F.col("n").alias("pn"), F.col("comp").alias("pc"))
        heads = places.groupBy("token").agg(F.min(pivot).alias("p")).select("token", "p.*")
        met = places.join(heads, "token").where((F.col("comp") != F.col("pc")) & fits("n", "pn"))
        met = met.groupBy("node", "pivot", "n", "pn").agg(F.sum("w").alias("m")).where(enough("n", "pn"))
        chosen = met.groupBy("node").agg(F.max_by("pivot", F.struct("m", "pivot")).alias("pivot")).select("pivot", F.col("node").alias("other"))
        tested.append(staged(chosen, f"join-turn-{turn}"))
        links = verified(tested[-1], f"turn-{turn}")
        if links.isEmpty():
            break  # all pairs settle the rest
        label = components(label.select("u", F.col("root").alias("v")).union(links))
        slots = staged(labelled(slots.drop("comp")), f"join-slots-{turn}")
        still = slots.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
        slots = keep_where(slots, staged(still, f"join-still-{turn}"), ["token"])

    rest = _meetings(_placed(slots), percent).select("pivot", "other").distinct()
    for done in tested:
        rest = rest.join(done, ["pivot", "other"], "left_anti").join(done.select(F.col("pivot").alias("other"), F.col("other").alias("pivot")), ["pivot", "other"], "left_anti")
    rest = staged(rest, "join-rest")
    if not rest.isEmpty():
        more = verified(rest, "b")
        if not more.isEmpty():
            label = components(label.select("u", F.col("root").alias("v")).union(more))

    whole = nodes.select("node", "least").join(label, nodes["node"] == label["u"], "left")
    whole = staged(whole.select("node", "least", F.coalesce("root", "node").alias("root")), "join-roots")
    return slim, whole


def join_components(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Words are lower-cased in A-Z. ``component_id`` is the smallest id reachable
    by links, the own one included. Null and blank texts have an empty set and
    link to nothing; a text of one to four words has its whole sequence as one
    shingle. Repeated rows and equal texts are one node; rows without an id take
    part but never name a component (null if no row of it has an id). An empty
    table gives an empty result; other columns are not looked at.
    """
    slim, whole = _linked(docs, text, key, percent)
    least = whole.groupBy("root").agg(F.min("least").alias("component_id"))
    named = whole.join(least, "root").select("node", "component_id")
    out = slim.where("n > 0").join(named, "node").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.union(slim.where("n = 0").select("doc_id", F.lit(0).cast("long"), F.col("doc_id")))


def _repeated(slim: DataFrame) -> bool:
    """Whether any (id, text) row occurs twice."""
    return not slim.groupBy("row").count().where("count > 1").isEmpty()


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each component, all columns unchanged: of its
    rows the one of the smallest id, rows without an id last. Rows are told
    apart by id and text, whatever rows an id stands on; of rows that repeat
    both one stays. Texts without words link to nothing: each row stays."""
    slim, whole = _linked(docs, text, key, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    chosen = slim.where("n > 0").join(whole.select("node", "root"), "node").groupBy("root").agg(first).select(F.col("first.row").alias("__row"))
    chosen = staged(chosen, "join-kept")
    t = F.col(f"`{text}`")
    rows = docs.withColumn("__row", F.xxhash64(F.col(f"`{key}`").cast("long"), t))
    kept = keep_where(rows, chosen, ["__row"])
    twice = staged(slim.where("n > 0").groupBy("row").count().where("count > 1").select(F.col("row").alias("__row")), "join-twice")
    if not twice.isEmpty():
        kept = keep_where(kept, twice, ["__row"], "left_anti").union(keep_where(kept, twice, ["__row"]).dropDuplicates(["__row"]))
    return kept.drop("__row").union(docs.where(t.isNull() | ~t.rlike(WORD)))
