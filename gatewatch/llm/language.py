"""Language identification in two levels.

A linear classifier over hashed byte trigrams names the language family; within
a family of several languages, one-versus-one linear support vector machines
vote. All weights are learned from labelled texts; the only fixed knowledge is
which common codes form a family.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.words import slabs

# Families of common language codes. Any other code is a family
# of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
}
DIMS = 2048
TRAIN_PER_LANGUAGE = 800  # labelled texts per language, a hash sample
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")

# Letters keep a code of their own (A-Z like a-z), all else is one separator.
_CODE = np.zeros(256, np.uint32)
_CODE[128:] = np.arange(128, 256)
_CODE[97:123] = np.arange(97, 123)
_CODE[65:91] = np.arange(97, 123)


def family_of(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), lang)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One unit row of square-rooted trigram counts per text (whole texts)."""
    code = _CODE[data]
    out = np.zeros((len(offsets) - 1, DIMS), np.float32)
    if len(code) >= 3:
        g = code[:-2] * np.uint32(0x9E3779B1) + code[1:-1] * np.uint32(0x85EBCA77) + code[2:] * np.uint32(0xC2B2AE3D)
        g ^= g >> np.uint32(15)
        g = (g * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - DIMS.bit_length() + 1)
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            if b - a >= 3:
                out[i] = np.bincount(g[a : b - 2], minlength=DIMS)
    np.sqrt(out, out=out)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norm, 1e-9)


def svm(x: np.ndarray, y: np.ndarray, decay: float = 1e-3, steps: int = 200) -> np.ndarray:
    """Weights (bias last) of a linear machine with squared hinge loss; ``y`` is
    +1 or -1. Accelerated gradient descent on the classes weighted alike."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(x.dtype)
    w = np.zeros(x.shape[1], x.dtype)
    ahead, rate = w, 1.0 / (4.0 + decay)
    for k in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        grad = decay * ahead - 2 * (x.T @ (share * y * slack))
        new = ahead - rate * grad
        ahead, w = new + k / (k + 3) * (new - w), new
    return w


@dataclass
class LanguageModel:
    """Families with one-versus-rest machines, and the machines of each pair of
    languages within a family."""

    families: list[str]
    family_weights: np.ndarray
    members: dict[str, list[str]]
    pairs: dict[tuple[str, str], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(language, score in 0..1) of each feature row."""
        n = len(x)
        if not self.families:
            return [UNDETERMINED] * n, np.zeros(n)
        bias = lambda w: x @ w[..., :-1].T + w[..., -1]
        share = 1 / (1 + np.exp(-4 * bias(self.family_weights))) if len(self.families) > 1 else np.ones((n, 1))
        share = share / np.maximum(share.sum(axis=1, keepdims=True), 1e-12)
        chosen = share.argmax(axis=1)
        langs, score = np.empty(n, object), share.max(axis=1).astype(np.float64)
        for f, family in enumerate(self.families):
            rows = np.flatnonzero(chosen == f)
            names = self.members[family]
            votes = np.zeros((len(rows), len(names)))
            for (a, b), w in self.pairs.items():
                if a in names:
                    p = 1 / (1 + np.exp(-4 * (x[rows] @ w[:-1] + w[-1])))
                    votes[:, names.index(a)] += (p > 0.5) + 1e-3 * p
                    votes[:, names.index(b)] += (p <= 0.5) + 1e-3 * (1 - p)
            best = votes.argmax(axis=1)
            langs[rows] = np.array(names, object)[best]
            if len(names) > 1:
                worst = np.ones(len(rows))
                for (a, b), w in self.pairs.items():
                    if a in names:
                        p = 1 / (1 + np.exp(-4 * (x[rows] @ w[:-1] + w[-1])))
                        worst = np.where(best == names.index(a), np.minimum(worst, p), worst)
                        worst = np.where(best == names.index(b), np.minimum(worst, 1 - p), worst)
                score[rows] *= worst
        return langs.tolist(), np.clip(score, 0, 1)


def fit(labelled: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> LanguageModel:
    """Learn from ``text`` and ``lang`` (rows with a null or no letters do not
    count). The sample takes about ``per_language`` texts of each language by
    hash of the text, all texts of a rarer one. No usable rows give a model
    that knows no language."""
    lab = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in lab.groupBy("lang").count().collect()}
    if not counts:
        return LanguageModel([], np.zeros((0, DIMS + 1)), {}, {})
    unit = F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    rate = F.element_at(F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, per_language / n))]), F.col("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slabs(batch.column("text")):
                rows = [r.astype(np.float16).tobytes() for r in features(data, offsets)]
                yield pa.RecordBatch.from_arrays([batch.column("lang").slice(lo, hi - lo), pa.array(rows, pa.binary())], names=["lang", "x"])

    rows = lab.where(unit < rate).select("lang", "text").mapInArrow(run, "lang string, x binary").collect()
    rows = sorted((r[0], bytes(r[1])) for r in rows)
    x = np.stack([np.frombuffer(b, np.float16) for _, b in rows]).astype(np.float32)
    lang = np.array([l for l, _ in rows])
    names = sorted(set(lang))
    members: dict[str, list[str]] = {}
    for name in names:
        members.setdefault(family_of(name), []).append(name)
    families = sorted(members)
    family = np.array([family_of(l) for l in lang])
    tops = [svm(x, np.where(family == f, 1, -1).astype(np.float32)) for f in families] if len(families) > 1 else [np.zeros(DIMS + 1)]
    pairs = {}
    for group in members.values():
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                some = (lang == a) | (lang == b)
                pairs[a, b] = svm(x[some], np.where(lang[some] == a, 1, -1).astype(np.float32))
    return LanguageModel(families, np.stack(tops), members, pairs)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``lang_pred`` and ``score`` of every row, from the
    text alone. Null texts and texts without a letter are ``und`` with score 0,
    as is everything if no language was learned. Repeated rows stay repeated,
    an empty table gives an empty one; other columns are not looked at."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = d.select("row").schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for lo, hi, data, offsets in slabs(texts):
                langs, score = model.predict(features(data, offsets))
                lettered = [t is not None and LETTER.search(t) is not None for t in texts.slice(lo, hi - lo).to_pylist()]
                langs = [l if ok else UNDETERMINED for l, ok in zip(langs, lettered)]
                score = np.where(lettered, score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(lo, hi - lo), pa.array(langs, pa.string()), pa.array(score, pa.float64())], names=["row", "lang_pred", "score"]
                )

    return d.mapInArrow(run, schema).select(*[F.col("row").getField(c).alias(c) for c in keep], "lang_pred", "score")
