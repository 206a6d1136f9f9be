"""Byte-level BPE encoding and decoding by ranks, in Spark functions and small Arrow steps.

A word is one match of the tokenizer's pattern. It starts as the array of its
bytes, each the id of its token; a fold joins the neighbours that make the token
of the lowest rank, the leftmost first, until no neighbours make a token. The
ranks are a literal map from pairs of ids to the id of their joined bytes, which
is its rank: buckets of a few pairs each, so a lookup costs the same for any
vocabulary.

The words of the whole corpus are counted, and each distinct word that makes up
at least 1/``SHARE`` of them is folded once; there are at most ``SHARE`` such
words, in practice some hundred thousand, at any corpus size. Their ids go to
all tasks. A task codes the words of a batch as a dictionary, so each distinct
word is looked up once in a batch, and one that is neither among the frequent
words nor a token is merged once in a task, by the same rule. No word positions
are shuffled, only the partial word counts. Which words are frequent changes
the cost, never a result.

Decoding looks up the bytes of each id and joins the pieces, spelled in hex,
since Spark joins arrays of strings but not of binaries.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.tables import staged

# The White_Space property, which the pattern's \s means; Java's \s is ASCII only.
SPACE = r"\x{9}-\x{D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SHARE = 1 << 21
PAIRS = 16_381  # buckets of the pair map, a prime
LONG = 256  # bytes; the fold is quadratic in a word, so longer ones are left to the tasks' heap
KEPT = 1 << 18  # merged words that a task remembers
NONE = 2147483647


def java_pattern(pattern: str) -> str:
    """The pattern in Java's notation: \\s and \\S by the White_Space property."""
    out = pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]")
    return out.replace(r"\s", f"[{SPACE}]")


@dataclass(frozen=True)
class Vocabulary:
    """Ranks by token bytes, and the pattern that cuts texts into words."""

    ranks: dict[bytes, int]
    pattern: str

    @staticmethod
    def load(path: str, pattern: str) -> Vocabulary:
        """From a file of lines ``base64(token) rank``."""
        with open(path, "rb") as f:
            return Vocabulary({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}, pattern)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def with_ranks(ranks: dict[bytes, int], body: Callable[[Callable[[Column, Column], Column], Column], Column]) -> Column:
    """``body(rank, byte_ids)``: rank gives the id of the joined bytes of two
    ids, or ``NONE``; byte_ids is the array of the 256 bytes' ids."""
    keys: list[list[int]] = [[] for _ in range(PAIRS)]
    values: list[list[int]] = [[] for _ in range(PAIRS)]
    for token, i in ranks.items():
        for k in range(1, len(token)):
            a, b = ranks.get(token[:k]), ranks.get(token[k:])
            if a is not None and b is not None:
                pair = a << 32 | b
                keys[pair % PAIRS].append(pair)
                values[pair % PAIRS].append(i)
    whole = {"k": keys, "v": values, "b": [ranks[bytes([x])] for x in range(256)]}
    table = F.from_json(F.lit(json.dumps(whole, separators=(",", ":"))), "k array<array<bigint>>, v array<array<int>>, b array<int>")

    def rank(t: Column, a: Column, b: Column) -> Column:
        pair = a.cast("long") * (1 << 32) + b
        at = (pair % PAIRS).cast("int")
        return F.coalesce(F.get(F.get(t["v"], at), (F.array_position(F.get(t["k"], at), pair) - 1).cast("int")), F.lit(NONE))

    return let(table, lambda t: body(lambda a, b: rank(t, a, b), t["b"]))


def fold(word: Column, rank: Callable[[Column, Column], Column], byte_ids: Column) -> Column:
    """Ids of one word. The state is the pieces ``p``, between two marks that
    join with nothing, and the rank ``r`` of each joined with the next."""
    # Each byte as one character; a byte's place in the string is its place in the word.
    latin = F.decode(word.cast("binary"), "ISO-8859-1")
    n = F.octet_length(word)
    ids = let(latin, lambda x: F.transform(F.sequence(F.lit(1), n), lambda i: F.get(byte_ids, F.ascii(F.substring(x, i, F.lit(1))))))
    mark = F.array(F.lit(0))

    def start(ids: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), n - 2), lambda i: rank(F.get(ids, i), F.get(ids, i + 1)))
        none = F.array(F.lit(NONE))
        return F.struct(F.concat(mark, ids, mark).alias("p"), F.concat(none, F.when(n > 1, pairs).otherwise(F.array().cast("array<int>")), none).alias("r"))

    def joined(s: Column, i: Column, m: Column) -> Column:
        """The pieces i and i + 1 (from 1; the mark is piece 1) become ``m``."""
        p, r = s["p"], s["r"]
        left = F.when(i > 2, rank(F.get(p, i - 2), m)).otherwise(F.lit(NONE))
        right = F.when(i + 2 < F.size(p), rank(m, F.get(p, i + 1))).otherwise(F.lit(NONE))
        pieces = F.concat(F.slice(p, F.lit(1), i - 1), F.array(m), F.slice(p, i + 2, n))
        return F.struct(pieces.alias("p"), F.concat(F.slice(r, F.lit(1), i - 2), F.array(left, right), F.slice(r, i + 2, n)).alias("r"))

    def step(s: Column, _: Column) -> Column:
        # A null state, once nothing joins any more, is passed on at no cost.
        least = lambda m: F.when(m < NONE, joined(s, F.array_position(s["r"], m).cast("int"), m)).otherwise(s)
        return let(F.array_min(s["r"]), least)

    end = let(ids, lambda x: F.aggregate(F.sequence(F.lit(1), n), start(x), step, lambda s: F.slice(s["p"], F.lit(2), F.size(s["p"]) - 2)))
    return F.when(n > 0, end).otherwise(F.array().cast("array<int>"))


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word by the same rule, in n log n steps: a heap of neighbours
    by (rank, place); an entry whose pieces have changed since is passed over."""
    n = len(word)
    end = list(range(1, n + 1))  # end of the piece that starts here; 0 if none does
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        mid = end[i]
        if not mid or mid >= n or end[mid] != stop:
            continue
        end[i], end[mid] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (b := before[i]) >= 0 and (r := ranks.get(word[b:stop])) is not None:
            heapq.heappush(heap, (r, b, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def words(text: Column, vocabulary: Vocabulary) -> Column:
    """The words of a text, in order; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(java_pattern(vocabulary.pattern)), F.lit(0))


def frequent_words(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", share: int = SHARE) -> dict[str, list[int]]:
    """Ids of the distinct words that make up at least 1/``share`` of all words:
    at most ``share`` of them."""
    counts = docs.select(F.explode(words(F.col(f"`{text}`"), vocabulary)).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    counts = staged(counts.where(F.octet_length("w") <= LONG), "bpe-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.where(F.col("n") * share >= total).select("w")
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = with_ranks(vocabulary.ranks, lambda rank, byte_ids: fold(F.col("w"), rank, byte_ids))
    rows = often.repartition(spread, "w").select("w", ids.alias("ids")).collect()
    return {w: list(ids) for w, ids in rows}


def _encode_words(ranks: dict[bytes, int], often: dict[str, list[int]]):
    """Arrow function: the ids of each array of words, one after the other."""
    merged: dict[str, list[int]] = {}

    def find(word: str) -> list[int]:
        found = often.get(word) or merged.get(word)
        if found is None:
            raw = word.encode()
            # A word that is a token is that token.
            found = [ranks[raw]] if raw in ranks else merge_long(raw, ranks)
            if len(raw) <= LONG:
                if len(merged) >= KEPT:
                    merged.clear()
                merged[word] = found
        return found

    def run(column: pa.Array) -> pa.Array:
        coded = column.flatten().dictionary_encode()
        distinct = pa.array([find(w) for w in coded.dictionary.to_pylist()], pa.list_(pa.int32()))
        each = distinct.take(coded.indices)
        # Where the words of each text start, in words and then in ids.
        at = np.cumsum([0, *column.value_lengths().to_pylist()])
        starts = np.cumsum(np.concatenate([[0], each.value_lengths().to_numpy(zero_copy_only=False)]))[at]
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), each.flatten())

    return F.arrow_udf(run, "array<int>")


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", share: int = SHARE) -> DataFrame:
    """``docs`` with ``ids``, the token ids (array of int) of each whole text.

    Null and empty texts have no ids; equal texts have equal ids; words of any
    length are encoded whole. Every single byte must be a token. A column of
    the name ``ids`` is replaced; all others stay. No rows give no rows.
    """
    often = frequent_words(docs, vocabulary, text, share)
    return docs.withColumn(ids, _encode_words(vocabulary.ranks, often)(words(F.col(f"`{text}`"), vocabulary)))


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """``df`` with ``out``, the bytes that ``ids`` stand for: the pieces of the
    ids, one after the other. Null ids give null, no ids no bytes; an id that
    no token has is an error."""
    pieces: list[str | None] = [None] * (max(vocabulary.ranks.values()) + 1)
    for k, v in vocabulary.ranks.items():
        pieces[v] = k.hex()
    table = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    piece = lambda t, i: F.coalesce(F.get(t, i), F.raise_error(F.concat(F.lit("no token has the id "), i.cast("string"))))
    return df.withColumn(out, let(table, lambda t: F.unhex(F.array_join(F.transform(ids, lambda i: piece(t, i)), ""))))
