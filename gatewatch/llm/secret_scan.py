"""Secret scans: fixed patterns, and a character network for everything else.

The patterns (assignments, access keys, long hexadecimal runs) always count.
Every other token that could be a secret is a candidate; a small convolutional
network over its characters and its surroundings decides. It is trained on
labelled findings: pattern matches of the corpus, respelled at random so that
shape and surroundings count rather than one alphabet, against tokens of the
same corpus that are prose, numbers, links, addresses or markup. A token of
mixed shape outside the patterns may be a secret: it has no label and is left
out. Thresholds are calibrated on findings held out from training, under a
recall constraint.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]))
KINDS = ("assign", "access", "hex", "net")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
# Cheap tests that every match of a pattern passes.
_HINT = re.compile(r"passw|secret|token|api_?key", re.I | re.A)
_HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

BEFORE, INSIDE, AFTER = 24, 48, 8
WINDOW = BEFORE + INSIDE + AFTER
CODES, EMBED, WIDTH, FILTERS = 96, 12, 5, 24
AT_ONCE = 4_096  # windows judged together
TRAIN_TEXTS = 6_000  # texts sampled by hash for negatives
TRAIN_FINDINGS = 4_000  # findings of each answer
RECALL = 0.99


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points of all pattern matches; per kind the
    leftmost, non-overlapping, without those that are too short."""
    out = []
    if _HINT.search(text):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _has_mix(token: str) -> bool:
    """Letters and digits, or both cases after the first letter: no plain word."""
    digits = any(c.isdigit() for c in token)
    return (digits and any(c.isalpha() for c in token)) or (token[1:] != token[1:].lower() and token != token.upper())


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Spans of all tokens that could be secrets and touch no pattern match; both
    lists are in order of their starts, so one pass merges them."""
    out, i, reach = [], 0, -1
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        while i < len(taken) and taken[i][1] < b:
            reach = max(reach, taken[i][2])
            i += 1
        # Of all matches that start before b, the one that reaches furthest.
        if reach <= a and _has_mix(m.group()):
            out.append((a, b))
    return out


_PIECE = re.compile(r"[\W_]+")
# A word, also joined CamelCase words, an acronym, or a number; and a word or
# acronym with a short number.
_ORDINARY = re.compile(r"(?:[A-Z]?[a-z]{2,14}){1,3}|[A-Za-z]?[a-z]{0,14}|[A-Z]{1,6}|[0-9]+|[^\x00-\x7f]+")
_NUMBERED = re.compile(r"(?:[A-Z]?[a-z]{1,14}|[A-Z]{1,4})[0-9]{1,3}")


def ordinary(token: str) -> bool:
    """Known non-secret shapes (prose, numbers, links, paths, markup): every
    piece between punctuation is a word or a number, at most one is both."""
    rest = [x for x in _PIECE.split(token) if x and not _ORDINARY.fullmatch(x)]
    return not rest or (len(rest) == 1 and _NUMBERED.fullmatch(rest[0]) is not None)


def encode(text: str, a: int, b: int, at: int | None = None) -> np.ndarray:
    """The candidate's characters (from ``at``, else from its start) between
    those before and after it."""
    at = a if at is None else at
    parts = (text[max(0, a - BEFORE) : a].rjust(BEFORE, "\0"), text[at : min(b, at + INSIDE)].ljust(INSIDE, "\0"), text[b : b + AFTER].ljust(AFTER, "\0"))
    raw = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
    # Printable ASCII has codes 1..95; padding and all other characters 0.
    return np.where((raw >= 32) & (raw < 127), raw - 31, 0).astype(np.uint8)


def places(a: int, b: int) -> list[int]:
    """Where the windows of a candidate start: half overlapping, to its end."""
    return [*range(a, b - INSIDE, INSIDE // 2), max(a, b - INSIDE)]


@dataclass
class Network:
    """Embedding, one convolution, maximum over time for each of the three
    zones (before, inside, after), one linear unit."""

    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    threshold: float = 1.0
    scale: float = 1.0
    shift: float = 0.0

    @classmethod
    def new(cls, seed: int = 5) -> Network:
        r = np.random.default_rng(seed)
        f = np.float32
        return cls(
            r.normal(0, 0.3, (CODES, EMBED)).astype(f),
            r.normal(0, (2 / (WIDTH * EMBED)) ** 0.5, (WIDTH * EMBED, FILTERS)).astype(f),
            np.zeros(FILTERS, f),
            np.append(r.normal(0, 0.1, 3 * FILTERS), 0).astype(f),
        )

    def forward(self, x: np.ndarray):
        e = self.embed[x]
        cols = np.lib.stride_tricks.sliding_window_view(e, WIDTH, axis=1).transpose(0, 1, 3, 2).reshape(len(x), WINDOW - WIDTH + 1, WIDTH * EMBED)
        z = np.maximum(cols @ self.conv + self.bias, 0)
        zones = (z[:, : BEFORE - 2], z[:, BEFORE - 2 : BEFORE + INSIDE - 2], z[:, BEFORE + INSIDE - 2 :])
        top = [q.argmax(axis=1) for q in zones]
        pooled = np.concatenate([np.take_along_axis(q, t[:, None], 1)[:, 0] for q, t in zip(zones, top)], axis=1)
        return cols, top, pooled, pooled @ self.out[:-1] + self.out[-1]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        z = np.concatenate([self.forward(x[i : i + 512])[3] for i in range(0, len(x), 512)])
        return 1 / (1 + np.exp(-(self.scale * z + self.shift)))

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 128, rate: float = 4e-3, seed: int = 5) -> None:
        """Adam on the cross entropy; gradients flow through the maxima."""
        r = np.random.default_rng(seed)
        params = [self.embed, self.conv, self.bias, self.out]
        m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        base = np.array([0, BEFORE - 2, BEFORE + INSIDE - 2])
        for _ in range(epochs):
            order = r.permutation(len(x))
            for lo in range(0, len(x), batch):
                rows = order[lo : lo + batch]
                cols, top, pooled, z = self.forward(x[rows])
                err = ((1 / (1 + np.exp(-z)) - y[rows]) / len(rows)).astype(np.float32)
                grads = [np.zeros_like(p) for p in params]
                grads[3][:-1], grads[3][-1] = pooled.T @ err, err.sum()
                back = err[:, None] * self.out[None, :-1] * (pooled > 0)
                for zone in range(3):
                    g = back[:, zone * FILTERS : (zone + 1) * FILTERS]
                    place = top[zone] + base[zone]
                    picked = np.take_along_axis(cols, place[:, :, None], axis=1)  # text, filter, column
                    grads[1] += np.einsum("nf,nfc->cf", g, picked)
                    grads[2] += g.sum(axis=0)
                    into = (g[:, :, None] * self.conv.T[None]).reshape(len(rows), FILTERS, WIDTH, EMBED)
                    codes = x[rows][np.arange(len(rows))[:, None, None], place[:, :, None] + np.arange(WIDTH)]
                    np.add.at(grads[0], codes.ravel(), into.reshape(-1, EMBED))
                step += 1
                for p, g, a, b in zip(params, grads, m, v):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)).astype(p.dtype)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Platt scaling on held-out findings, then the highest threshold that
        keeps the recall; no higher one is as precise without losing recall."""
        z = np.concatenate([self.forward(x[i : i + 512])[3] for i in range(0, len(x), 512)])
        a, b = 1.0, 0.0
        for _ in range(200):
            p = 1 / (1 + np.exp(-(a * z + b)))
            a, b = a - 0.05 * (((p - y) * z).mean() + 1e-3 * (a - 1)), b - 0.05 * (p - y).mean()
        self.scale, self.shift = float(max(a, 0.05)), float(b)
        p = self.probability(x)
        self.threshold = float(np.quantile(p[y > 0], 1 - RECALL, method="lower"))


# Alphabets in which a finding is respelled for training.
_ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "abcdefghijklmnopqrstuvwxyz0123456789_-")


def respelled(before: str, after: str, seed: int) -> np.ndarray:
    """A labelled secret: a random token in the surroundings of a real one."""
    r = np.random.default_rng(seed)
    alphabet = _ALPHABETS[r.integers(len(_ALPHABETS))]
    token = "".join(alphabet[i] for i in r.integers(len(alphabet), size=r.integers(20, 60)))
    text = before + token + after
    return encode(text, len(before), len(before) + len(token))


SPELLINGS = 4  # of each finding, if there are few


def matches(d: DataFrame, most: int) -> list:
    """The at most ``most`` pattern matches of least hash over all texts, with
    their surroundings; a repeated text counts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, tuple[str, str, str]] = {}
        for batch in batches:
            for t in batch.column("text").to_pylist():
                spans = base_spans(t)
                key = hashlib.md5(t.encode()).digest() if spans else b""
                for i, (kind, a, b) in enumerate(spans):
                    h = int.from_bytes(hashlib.md5(key + i.to_bytes(8, "big")).digest()[:7], "big")
                    value = ASSIGN.match(t, a).start(2) if kind == "assign" else a
                    least[h] = (t[max(0, a - BEFORE) : a], t[max(0, value - BEFORE) : value], t[b : b + AFTER])
                if len(least) > 4 * most:
                    least = {h: least[h] for h in sorted(least)[:most]}
        rows = [(h, *least[h]) for h in sorted(least)[:most]]
        cols = list(zip(*rows)) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array(c, pa.string()) for c in cols[1:])], names=["h", "unnamed", "named", "after"])

    found = d.mapInArrow(run, "h long, unnamed string, named string, after string").dropDuplicates(["h"])
    return found.orderBy("h").limit(most).collect()


def findings(docs: DataFrame, text: str = "text", texts: int = TRAIN_TEXTS, most: int = TRAIN_FINDINGS) -> tuple[np.ndarray, np.ndarray]:
    """(windows, answers), at most ``most`` of each answer: respelled pattern
    matches chosen by hash from all texts, and tokens of non-secret shapes from
    about ``texts`` texts chosen by hash."""
    d = docs.select(F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    chosen = matches(d, most)
    secret: dict[bytes, None] = {}
    for k in range(SPELLINGS):
        for i, r in enumerate(chosen):
            if len(secret) < most:
                # Half of them without the tell-tale name before them.
                secret[respelled(r["named"] if (i + k) % 2 else r["unnamed"], r["after"], r["h"] + k).tobytes()] = None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(r"[^\x20\x09-\x0D]{6,}")
        for batch in batches:
            seen: dict[bytes, None] = {}
            for t in batch.column("text").to_pylist():
                spans = base_spans(t)
                key = int.from_bytes(hashlib.md5(t.encode()).digest()[:6], "big")
                # Candidates, and sparsely everything else of some length.
                some = [m.span() for m in word.finditer(t) if (key + m.start()) % 61 == 0]
                for a, b in candidates(t, spans) + [s for s in some if not any(s[0] < e and x < s[1] for _, x, e in spans)]:
                    if ordinary(t[a:b]):
                        seen[encode(t, a, b).tobytes()] = None
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary())], names=["x"])

    plain = staged_sample(d, texts).mapInArrow(run, "x binary").distinct()
    plain = [bytes(r["x"]) for r in plain.orderBy(F.xxhash64("x"), "x").limit(most).collect()]
    rows = [x for x in plain if x not in secret] + list(secret)
    x = np.stack([np.frombuffer(r, np.uint8) for r in rows]) if rows else np.zeros((0, WINDOW), np.uint8)
    return x, np.repeat([0.0, 1.0], [len(rows) - len(secret), len(secret)])


def staged_sample(d: DataFrame, texts: int) -> DataFrame:
    """About ``texts`` rows chosen by the hash of their text (all if fewer)."""
    n = max(1, d.count())
    return d.where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < F.lit(1_000_003.0 * texts / n))


def fit(docs: DataFrame, text: str = "text", texts: int = TRAIN_TEXTS, most: int = TRAIN_FINDINGS) -> Network | None:
    """The trained and calibrated network; None where all texts together lack
    pattern matches, or the sample lacks tokens of other shapes (then only the
    patterns count)."""
    x, y = findings(docs, text, texts, most)
    if min((y > 0).sum(), (y == 0).sum()) < 20:
        return None
    order = np.random.default_rng(3).permutation(len(x))
    held, rest = order[: len(x) // 4], order[len(x) // 4 :]
    net = Network.new()
    net.train(x[rest], y[rest])
    net.calibrate(x[held], y[held])
    return net


def scan(docs: DataFrame, net: Network | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``spans`` (kind, a, b in code points, in order) for
    every row: all pattern matches, and the candidates the network accepts
    (kind ``net``), each read over its whole length. Null counts as empty; texts are scanned whole; repeated rows
    stay repeated; an empty table gives an empty one; other columns are not
    looked at."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = d.select("row").schema.add("spans", SPANS)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("a", pa.int32()), ("b", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, windows, where = [], [], []

            def decide() -> None:
                """Accept the candidates of which a window is accepted."""
                if windows:
                    for (i, a, b), p in zip(where, net.probability(np.stack(windows))):
                        if p >= net.threshold:
                            spans[i].add(("net", a, b))
                    windows.clear()
                    where.clear()

            for t in batch.column("text"):
                t = t.as_py() or ""
                found = base_spans(t)
                spans.append(set(found))
                if net is not None:
                    for a, b in candidates(t, found):
                        for at in places(a, b):
                            windows.append(encode(t, a, b, at))
                            where.append((len(spans) - 1, a, b))
                            if len(windows) >= AT_ONCE:
                                decide()
            decide()
            spans = [sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2])) for found in spans]
            values = [[{"kind": k, "a": a, "b": b} for k, a, b in s] for s in spans]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(values, kind)], schema=pa.schema([batch.schema.field("row"), pa.field("spans", kind)]))

    return d.mapInArrow(run, schema).select(*[F.col("row").getField(c).alias(c) for c in keep], "spans")


def redact(docs: DataFrame, net: Network | None, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` (overlapping spans by
    one); all other columns unchanged. Texts without findings, and null, stay
    as they are."""
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"))
    found = scan(packed, net, "text", ("row",))
    t = F.col("row").getField(text)
    # Fold the spans from left to right: text so far, place reached.
    parts = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("s"), F.lit(0).alias("at")),
        lambda acc, x: F.when(x["b"] <= acc["at"], acc).otherwise(
            F.struct(
                F.concat(acc["s"], F.substring(t, acc["at"] + 1, F.greatest(x["a"] - acc["at"], F.lit(0))), F.when((x["a"] >= acc["at"]) | (acc["at"] == 0), F.lit(mark)).otherwise(F.lit(""))).alias("s"),
                x["b"].alias("at"),
            )
        ),
    )
    new = F.when(F.size("spans") > 0, F.concat(parts["s"], F.substr(t, parts["at"] + 1))).otherwise(t)
    return found.select(*[(new if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])
