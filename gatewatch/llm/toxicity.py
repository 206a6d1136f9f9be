"""Toxicity by classifier chains.

Categories are predicted one after the other by sparse logistic regressions
over the words of a text; each later model also sees the probabilities of the
earlier categories. For training those are out-of-fold predictions, so that a
later model meets them as unsure as they will be on new texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.tables import sized, staged

TOKEN = re.compile(r"[^\W\d_]+")
TOKEN_SQL = r"\p{L}+"
# (category, condition on the label columns), in the order of the chain.
CATEGORIES = (("toxic", "toxic = 1"), ("toxic_readable", "toxic = 1 AND quality = 1"), ("toxic_junk", "toxic = 1 AND quality = 0"))
TRAIN_ROWS = 12_000  # labelled texts of each answer to the first category, a hash sample
VOCABULARY = 1_000  # words with the strongest association
LEAST_TEXTS = 5
FOLDS = 4
PRECISION = 0.98  # the out-of-fold precision that a threshold must reach


@dataclass
class ToxicityModel:
    words: dict[str, int]
    names: list[str]
    weights: list[np.ndarray]  # words, earlier probabilities, bias
    thresholds: list[float]

    def predict(self, rows: list[list[int]]) -> np.ndarray:
        """Probabilities, one row per text, one column per category."""
        out = np.zeros((len(rows), len(self.names)))
        v = len(self.words)
        for k, w in enumerate(self.weights):
            score = np.array([w[r].sum() for r in rows]) if rows else np.zeros(0)
            out[:, k] = 1 / (1 + np.exp(-(score + out[:, :k] @ w[v : v + k] + w[-1])))
        return out


def _logistic(rows: list[np.ndarray], more: np.ndarray, y: np.ndarray, v: int, decay: float = 1e-4, steps: int = 400) -> np.ndarray:
    """L2 logistic regression over presence features (index lists) and dense
    columns ``more``; classes weigh alike; accelerated gradient descent."""
    n = len(rows)
    at = np.repeat(np.arange(n), [len(r) for r in rows])
    col = np.concatenate(rows).astype(np.int64) if n else np.zeros(0, np.int64)
    share = np.where(y, 0.5 / max(1, y.sum()), 0.5 / max(1, (~y).sum()))
    w = np.zeros(v + more.shape[1] + 1)
    ahead = w
    rate = 4.0 / (2.0 + more.shape[1] + np.bincount(at, minlength=1).max(initial=0))
    for k in range(steps):
        z = np.bincount(at, ahead[col], minlength=n) + more @ ahead[v:-1] + ahead[-1]
        err = share * (1 / (1 + np.exp(-z)) - y)
        grad = np.concatenate([np.bincount(col, err[at], minlength=v), err @ more, [err.sum()]]) + decay * np.append(ahead[:-1], 0)
        new = ahead - rate * grad
        ahead, w = new + k / (k + 3) * (new - w), new
    return w


def _apply(w: np.ndarray, rows, more: np.ndarray, v: int) -> np.ndarray:
    score = np.array([w[r].sum() for r in rows]) if len(rows) else np.zeros(0)
    return 1 / (1 + np.exp(-(score + more @ w[v:-1] + w[-1])))


def _threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """Least threshold that reaches the precision out of fold, at least 1/2.
    ``weight``: labelled rows that a sampled row stands for."""
    by = np.argsort(-p)
    right = np.cumsum((weight * y)[by]) / np.cumsum(weight[by])
    # Equal probabilities pass together.
    good = np.flatnonzero((right >= PRECISION) & np.append(np.diff(p[by]) != 0, True))
    return float(max(0.5, p[by][good[-1]])) if len(good) else 1.0


def fit(docs: DataFrame, labels: DataFrame, categories: Sequence[tuple[str, str]] = CATEGORIES, rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id and the label
    columns). Labels without a text, or null, do not count; of repeated ids one
    row counts. Without examples of both kinds a category is never predicted.
    """
    names = [c for c, _ in categories]
    flags = [F.expr(c).alias(n) for n, c in categories]
    lab = labels.select("doc_id", *flags).where(F.col("doc_id").isNotNull() & F.col(names[0]).isNotNull()).dropDuplicates(["doc_id"])
    counts = {r[0]: r[1] for r in lab.groupBy(names[0]).count().collect()}
    rates = {k: min(1.0, rows / max(1, counts.get(k, 0))) for k in (True, False)}
    rate = F.when(F.col(names[0]), rates[True]).otherwise(rates[False])
    lab = staged(lab.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003.0 < rate), "toxic-labels")
    text = docs.select("doc_id", "text").join(sized(lab), "doc_id").dropDuplicates(["doc_id"])
    found = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(TOKEN_SQL), F.lit(0)))
    text = staged(text.select("doc_id", *names, found.alias("words")), "toxic-words")

    # Words over-represented in the first category, over all sampled texts. Others
    # would only let long texts outvote a word that matters.
    total = text.agg(F.count("*").alias("n"), F.sum(F.col(names[0]).cast("int")).alias("p")).first()
    n, p = total["n"], total["p"] or 0
    if not n:
        return ToxicityModel({}, names, [np.array([0.0] * k + [-50.0]) for k in range(len(names))], [1.0] * len(names))
    w = text.select(names[0], F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("m"), F.sum(F.col(names[0]).cast("int")).alias("t"))
    lift = (F.col("t") * F.lit(float(n)) - F.col("m") * F.lit(float(p))) / F.sqrt(F.col("m") * F.lit(float(n)))
    top = w.where((F.col("m") >= LEAST_TEXTS) & (lift > 0)).orderBy(lift.desc(), "word").limit(VOCABULARY)
    words = {r[0]: i for i, r in enumerate(top.select("word").collect())}

    known = F.array(*[F.lit(x) for x in words]) if words else F.array().cast("array<string>")
    rows_ = text.select("doc_id", *names, F.array_intersect("words", known).alias("words")).collect()
    rows_ = sorted(rows_, key=lambda r: r["doc_id"])
    x = [np.array([words[t] for t in r["words"]], np.int64) for r in rows_]
    fold = np.arange(len(x)) % FOLDS
    v, earlier = len(words), np.zeros((len(x), 0))
    stands = np.array([1 / rates[r[names[0]]] for r in rows_])
    weights, thresholds = [], []
    for name in names:
        y = np.array([bool(r[name]) for r in rows_])
        if not y.any() or y.all():
            w_ = np.zeros(v + earlier.shape[1] + 1)
            w_[-1] = 50.0 if y.all() else -50.0
            out = np.full(len(y), float(y.all()))
        else:
            out = np.zeros(len(y))
            for f in range(FOLDS):
                fit_, test = np.flatnonzero(fold != f), np.flatnonzero(fold == f)
                wf = _logistic([x[i] for i in fit_], earlier[fit_], y[fit_], v)
                out[test] = _apply(wf, [x[i] for i in test], earlier[test], v)
            w_ = _logistic(x, earlier, y, v)
        weights.append(w_)
        thresholds.append(_threshold(out, y, stands))
        earlier = np.column_stack([earlier, out])
    return ToxicityModel(words, names, weights, thresholds)


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``p_<category>`` and the boolean ``<category>`` for
    every row, over whole texts. Null counts as empty; repeated rows stay
    repeated; an empty table gives an empty one; other columns are not looked
    at."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = d.select("row").schema
    for name in model.names:
        schema = schema.add(f"p_{name}", "double").add(name, "boolean")
    known = frozenset(model.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column("text"):
                found = known.intersection(TOKEN.findall((t.as_py() or "").lower()))
                rows.append(sorted(model.words[w] for w in found))
            p = model.predict(rows)
            cols = [batch.column("row")]
            for k, limit in enumerate(model.thresholds):
                cols += [pa.array(p[:, k]), pa.array(p[:, k] >= limit)]
            yield pa.RecordBatch.from_arrays(cols, schema=pa.schema([batch.schema.field("row"), *(pa.field(f.name, c.type) for f, c in zip(schema.fields[1:], cols[1:]))]))

    out = d.mapInArrow(run, schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], *schema.names[1:])
