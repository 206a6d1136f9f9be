"""Alignment of two tokenizers over the same bytes, by merge-path partitioning.

Tokenizer A (byte-level BPE) and B (pieces with byte fallback) cut the same
bytes; each token is known by where it ends. The two rising lists of ends are
merged: each distinct end closes a stretch of bytes that lies in one A and one
B token, which is a link, and an end of both lists closes a group.

A diagonal d of the merge grid holds the ways to split the first d merged ends
into i of A and d - i of B; the one the merge goes through is found by binary
search, without merging. Diagonals at equal distances cut the merge into pieces
of equal work that need nothing of each other but one token ahead and one end
behind. Each piece is a row of its own: it emits its links, its whole groups,
and the open parts of a group at both its borders; the parts of a document's
pieces are then stitched in order. A long document is thereby many small pieces.

Counts of id pairs over the corpus are partial sums. They come back to the
documents in two ways: the pairs that hold more than 1/``HOT`` of all links, of
which there are less than ``HOT``, travel to all tasks; the others, none of them
common, are joined by a shuffle. No pair meets all its documents in one task.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.tables import staged

PIECE = 1 << 15  # merged ends of a piece
HOT = 200_000
SLAB = 1 << 18  # characters that B tokenizes in one call
FLUSH = 1 << 20  # links and characters of groups that are held before they are given on
LONG_WORD = 1000  # characters; texts with longer words go to the tokenizers library

ALIGNED = (
    "row long, doc_id long, piece int, pieces int, n_a int, n_b int, a array<int>, b array<int>, m array<int>, groups_sha256 string, "
    "closed int, head_a string, head_b string, whole string, tail_a string, tail_b string"
)
SCORED = "row long, n_best long, count_sum long, a array<int>, b array<int>, m array<int>"

# Characters that every regular expression library sorts alike into blanks,
# letters, digits and others: ASCII without its separators, and Latin letters.
_PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\u024f]*")
_LONG = re.compile(f"\\S{{{LONG_WORD},}}|\\s{{{LONG_WORD},}}")
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Pair:
    """The two tokenizers as file contents, which travel to the executors."""

    a: str  # JSON of a byte-level BPE for the tokenizers library
    b: bytes  # sentencepiece model
    _ready: dict = field(default_factory=dict, compare=False, repr=False)

    @staticmethod
    def load(a: str, b: str) -> Pair:
        with open(a, encoding="utf-8") as f, open(b, "rb") as g:
            return Pair(f.read(), g.read())

    def __getstate__(self):
        return {"a": self.a, "b": self.b}

    def __setstate__(self, state):
        for k, v in {**state, "_ready": {}}.items():
            object.__setattr__(self, k, v)

    def ready(self) -> tuple:
        """(encoder of A, encoder of B, bytes of A's ids, bytes of B's ids)."""
        if not self._ready:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            import sentencepiece

            b = sentencepiece.SentencePieceProcessor(model_proto=self.b)
            spec = json.loads(self.a)
            a_bytes = _byte_level(spec)
            self._ready["all"] = _encoder_a(self.a, spec, a_bytes), lambda texts: b.encode(texts, num_threads=1), a_bytes, _pieces(b)
        return self._ready["all"]


def _encoder_a(source: str, spec: dict, a_bytes: list[bytes]):
    """text -> ids of A. The tokenizers library does any text; tiktoken is some
    five times as fast and does the same where three things hold, of which the
    first two are seen from the vocabulary: its i-th merge makes its i-th token
    that is no byte, so that ranks are ids; each token, tokenized by the merges,
    is itself, so that joining any neighbours whose bytes are a token, lowest
    rank first, never leaves the listed merges; and the text has only
    characters on which the pattern's classes are beyond doubt."""
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_str(source)
    whole.encode_special_tokens = True
    special = {t["id"] for t in spec.get("added_tokens", [])}
    slow = lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, np.int32)
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True) and not spec.get("normalizer")
    vocabulary = model["vocab"]
    merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
    first = sum(i not in special for i in vocabulary.values()) - len(merges)
    ordered = first == 256 and all(vocabulary.get(x + y) == first + i for i, (x, y) in enumerate(merges))
    if not (plain and ordered and all([t.id for t in whole.model.tokenize(token)] == [i] for token, i in vocabulary.items() if i not in special)):
        return slow
    ranks = {a_bytes[i]: i for i in vocabulary.values() if i not in special}
    fast = tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if _PLAIN.fullmatch(text) and not _LONG.search(text):
            return np.array(fast.encode_ordinary(text), np.int32)
        return slow(text)

    return encode


def _byte_level(spec: dict) -> list[bytes]:
    """Bytes of each id. Byte-level vocabularies spell printable Latin-1 bytes
    as themselves and the others, in order, as the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in plain]
    of = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(rest)}
    vocabulary = spec["model"]["vocab"]
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        out[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
    return out


def _pieces(model) -> list[bytes]:
    """Bytes of each id of B."""
    spelled = lambda i: bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
    return [spelled(i) for i in range(model.get_piece_size())]


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """For each diagonal d, how many of the first d merged ends are of ``a``;
    of equal ends the one of ``a`` comes first."""
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        i = (low + high) // 2
        j = diagonals - i - 1
        # a[i] belongs to the first d if it is not above b[j].
        up = open_ & (a[np.minimum(i, len(a) - 1)] <= b[np.clip(j, 0, len(b) - 1)])
        low = np.where(up, i + 1, low)
        high = np.where(open_ & ~up, i, high)
    return low


def _table(ids: list[bytes], last: str) -> np.ndarray:
    return np.array([f"{i}," for i in range(len(ids))] + [f"{i}{last}" for i in range(len(ids))], dtype=object)


@dataclass
class Piece:
    """Ends of A and B in one piece, with the tokens they close, one token ahead
    in each list (if any) and the A end behind."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    n_a: int
    n_b: int
    behind: int


def cut(a_ids: np.ndarray, b_ids: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray, size: int) -> Iterator[Piece]:
    """The pieces of one document, of ``size`` merged ends each but the last."""
    total = len(a_ends) + len(b_ends)
    diagonals = np.append(np.arange(0, total, size), total)
    i = merge_path(a_ends, b_ends, diagonals)
    j = diagonals - i
    for i0, i1, j0, j1 in zip(i[:-1], i[1:], j[:-1], j[1:]):
        x, y = slice(i0, i1 + 1), slice(j0, j1 + 1)
        yield Piece(a_ids[x], b_ids[y], a_ends[x], b_ends[y], int(i1 - i0), int(j1 - j0), int(a_ends[i0 - 1]) if i0 else -1)


def align(p: Piece, a_text: np.ndarray, b_text: np.ndarray) -> tuple:
    """(A ids of the links, their B ids, number of each, groups) of a piece. The
    groups are (closed, head a, head b, whole, tail a, tail b): how many are
    closed, the open parts before the first and after the last end of a group,
    and the text of the groups between. A piece that closes none has only a head."""
    a, b = p.a_ends[: p.n_a], p.b_ends[: p.n_b]
    # An end of A lies in the first token of B that ends there or later, and the reverse.
    with_b = p.b_ids[np.searchsorted(p.b_ends, a)] if p.n_a else p.b_ids[:0]
    at = np.searchsorted(p.a_ends, b)
    tie = p.a_ends[np.minimum(at, len(p.a_ends) - 1)] == b if len(p.a_ends) else np.zeros(p.n_b, bool)
    both = tie & (at < p.n_a) | (b == p.behind)
    single = ~both
    with_a = p.a_ids[at[single]]
    key = np.concatenate([p.a_ids[: p.n_a].astype(np.int64) << 32 | with_b, with_a.astype(np.int64) << 32 | p.b_ids[: p.n_b][single]])
    pairs, m = np.unique(key, return_counts=True)

    closed = b[both]
    group_a, group_b = np.searchsorted(closed, a), np.searchsorted(closed, b)
    # The last token of a side in its group takes the closing sign of the side.
    last_a = np.append(group_a[1:] != group_a[:-1], True) if p.n_a else np.zeros(0, bool)
    last_b = np.append(group_b[1:] != group_b[:-1], True) if p.n_b else np.zeros(0, bool)
    # In a group A's tokens come first: each token's place follows from counts.
    place_a = np.arange(p.n_a) + np.searchsorted(group_b, group_a)
    place_b = np.arange(p.n_b) + np.searchsorted(group_a, group_b, side="right")
    text = np.empty(p.n_a + p.n_b, object)
    text[place_a] = a_text[p.a_ids[: p.n_a] + last_a * (len(a_text) // 2)]
    text[place_b] = b_text[p.b_ids[: p.n_b] + last_b * (len(b_text) // 2)]
    c = len(closed)
    in_a, in_b = np.searchsorted(group_a, [1, c]), np.searchsorted(group_b, [1, c])
    lo, hi = in_a + in_b if c else (len(text), len(text))

    def open_part(x: slice, n_a: int) -> tuple[str, str]:
        part = text[x]
        return "".join(part[:n_a])[:-1], "".join(part[n_a:])[:-1]

    head = open_part(slice(0, lo), int(in_a[0]) if c else p.n_a)
    tail = open_part(slice(hi, None), p.n_a - int(in_a[1]) if c else 0)
    whole = "".join(text[lo:hi])[:-1]
    return (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), m.astype(np.int32), (c, *head, whole, *tail)


def stitch(parts: list[tuple[int, str, str, str, str, str]]) -> Iterator[str]:
    """The groups of a document from (closed, head a, head b, whole, tail a,
    tail b) of its pieces in order, as texts that join with ``;``."""
    open_a: list[str] = []
    open_b: list[str] = []
    for closed, head_a, head_b, whole, tail_a, tail_b in parts:
        open_a += [head_a] * bool(head_a)
        open_b += [head_b] * bool(head_b)
        if closed:
            yield ",".join(open_a) + "|" + ",".join(open_b)
            if whole:
                yield whole
            open_a, open_b = [tail_a] * bool(tail_a), [tail_b] * bool(tail_b)


def sha256_of(groups: Iterator[str]) -> str:
    h, first = hashlib.sha256(), True
    for g in groups:
        h.update(g.encode() if first else b";" + g.encode())
        first = False
    return "" if first else h.hexdigest()


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def aligned(docs: DataFrame, pair: Pair, size: int = PIECE) -> DataFrame:
    """Links and groups of the pieces of every document (``row``, ``doc_id``,
    ``text``), one row per piece. The groups of a document of one piece are
    digested at once; the others keep their parts for the stitching. A text that
    has no tokens by the contract gives one empty piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_a, encode_b, a_bytes, b_bytes = pair.ready()
        a_len, b_len = (np.array([len(x) for x in t], np.int64) for t in (a_bytes, b_bytes))
        a_text, b_text = _table(a_bytes, "|"), _table(b_bytes, ";")
        nothing = np.zeros(0, np.int32)

        def pieces(text: str, b: list[int]) -> list[Piece]:
            data = (" " + text).encode("utf-8", "surrogatepass")
            if not text or b"".join([b_bytes[i] for i in b]) != data:
                return []
            a = encode_a(" " + text)
            ends = np.cumsum(a_len[a])
            if ends[-1] != len(data) or b"".join([a_bytes[i] for i in a.tolist()]) != data:
                return []
            b = np.array(b, np.int32)
            return list(cut(a, b, ends, np.cumsum(b_len[b]), size))

        def rows(row: int, doc_id: int, found: list[Piece]) -> Iterator[tuple]:
            if not found:
                yield row, doc_id, 0, 1, 0, 0, nothing, nothing, nothing, "", 0, "", "", "", "", ""
            for k, p in enumerate(found):
                links_a, links_b, m, groups = align(p, a_text, b_text)
                sha = ""
                if len(found) == 1:
                    sha, groups = sha256_of(stitch([groups])), (groups[0], "", "", "", "", "")
                yield row, doc_id, k, len(found), p.n_a, p.n_b, links_a, links_b, m, sha, *groups

        for keys, texts in _slabs(batches):
            out, held = [], 0
            for key, text, b in zip(keys, texts, encode_b(texts)):
                for row in rows(*key, pieces(text, b)):
                    out.append(row)
                    held += len(row[6]) + len(row[13])
                    if held >= FLUSH:
                        yield _rows(out, ALIGNED)
                        out, held = [], 0
            yield _rows(out, ALIGNED)

    return docs.select("row", "doc_id", "text").mapInArrow(run, ALIGNED)


def _slabs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple], list[str]]]:
    """((row, doc_id) and text) of some rows at a time, of about ``SLAB`` characters."""
    for batch in batches:
        keys, texts, held = [], [], 0
        for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            keys.append((row, doc_id)), texts.append(text.as_py() or "")
            held += len(texts[-1])
            if held >= SLAB:
                yield keys, texts
                keys, texts, held = [], [], 0
        if keys:
            yield keys, texts


def _scored(found: DataFrame, common: list[tuple[int, int, int, bool]]) -> DataFrame:
    """Per piece: the sums over its links that are ``common`` pairs (a, b,
    count, best of b), and the other links."""
    table = np.array(common, np.int64).reshape(-1, 4)
    keys = table[:, 0] << 32 | table[:, 1]
    order = np.argsort(keys)
    keys, counts, best = keys[order], table[order, 2], table[order, 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [batch.column(i) for i in (1, 2, 3)]
            a, b, m = (x.flatten().to_numpy().astype(np.int64) for x in lists)
            owner = np.repeat(np.arange(len(lists[0])), np.diff(lists[0].offsets.to_numpy()))
            at = np.minimum(np.searchsorted(keys, key := a << 32 | b), max(len(keys) - 1, 0))
            hit = keys[at] == key if len(keys) else np.zeros(len(key), bool)
            sums = []
            for value in (best, counts):
                total = np.zeros(len(lists[0]), np.int64)
                np.add.at(total, owner[hit], m[hit] * value[at[hit]])
                sums.append(pa.array(total))
            starts = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[~hit], minlength=len(lists[0])))]), pa.int32())
            rest = [pa.ListArray.from_arrays(starts, pa.array(x[~hit], pa.int32())) for x in (a, b, m)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *sums, *rest], names=["row", "n_best", "count_sum", "a", "b", "m"])

    return found.select("row", "a", "b", "m").mapInArrow(run, SCORED)


def _stitched(found: DataFrame) -> DataFrame:
    """``row, groups_sha256`` of the documents of several pieces."""
    names = ["closed", "head_a", "head_b", "whole", "tail_a", "tail_b"]

    def run(key, table):
        table = table.sort_by("piece")
        parts = zip(*[table.column(c).to_pylist() for c in names])
        return pa.table({"row": pa.array([key[0].as_py()], pa.int64()), "groups_sha256": [sha256_of(stitch(parts))]})

    return found.where("pieces > 1").select("row", "piece", *names).groupBy("row").applyInArrow(run, "row long, groups_sha256 string")


def align_documents(docs: DataFrame, pair: Pair, text: str = "text", key: str = "doc_id", size: int = PIECE, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum`` (long) and ``groups_sha256``.

    A encodes a space and the text, B the text, which adds the space itself;
    special tokens' strings are plain text. A null or empty text, or one whose
    tokens do not spell its bytes in A or B, has zeros and an empty digest.
    Repeated rows are rows of their own, and each counts in the corpus; equal
    and null ids are not told apart. Texts are tokenized whole, at any length.
    An empty table gives an empty result; other columns are not looked at.
    """
    d = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    d = d.withColumn("row", F.monotonically_increasing_id())
    found = staged(aligned(d, pair, size), "align-pieces")
    pairs = found.select(F.inline(F.arrays_zip("a", "b", "m")))
    counts = staged(pairs.groupBy("a", "b").agg(F.sum("m").alias("n")), "align-counts")
    top = counts.groupBy("b").agg(F.max("n").alias("top"))  # at most B's vocabulary
    counts = counts.join(F.broadcast(top), "b").select("a", "b", "n", (F.col("n") == F.col("top")).cast("long").alias("best"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    common = counts.where(F.col("n") * hot > total).collect()  # fewer than ``hot``
    rare = counts.where(F.col("n") * hot <= total)
    scored = staged(_scored(found, [tuple(r) for r in common]), "align-scores")
    seldom = scored.select("row", F.inline(F.arrays_zip("a", "b", "m"))).join(rare, ["a", "b"])
    seldom = seldom.groupBy("row").agg(F.sum(F.col("m") * F.col("best")).alias("n_best"), F.sum(F.col("m") * F.col("n")).alias("count_sum"))

    zero, none, unnamed = F.lit(0).cast("long"), F.lit(""), F.lit(None).cast("long")
    links = F.aggregate("m", zero, lambda x, y: x + y)
    info = found.select("row", "doc_id", "n_a", "n_b", F.col("closed").alias("n_groups"), links.alias("n_links"), zero.alias("n_best"), zero.alias("count_sum"), "groups_sha256")
    scores = scored.select("row", "n_best", "count_sum").union(seldom).select("row", unnamed, *[zero] * 4, "n_best", "count_sum", none)
    digests = _stitched(found).select("row", unnamed, *[zero] * 6, "groups_sha256")
    longs = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    rows = info.union(scores).union(digests).groupBy("row")
    rows = rows.agg(F.max("doc_id").alias("doc_id"), *[F.sum(c).cast("long").alias(c) for c in longs], F.max("groups_sha256").alias("groups_sha256"))
    return rows.drop("row")
