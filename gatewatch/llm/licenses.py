"""Licence scans: a trained paragraph classifier confirmed by templates.

Paragraphs (lines up to one without words, read on over line ends) are
classified into licence families by a sparse logistic regression over word
n-grams; a class ``none`` and a calibrated threshold make unknown paragraphs
unknown. Only statements with which a template of their family agrees are
reported: enough of a template's words must occur in order. Each statement
takes its words; the rest is classified again, so that all families come out.

Training texts are the templates, altered at random (dropped and foreign words,
other versions, joined to ordinary prose), against ordinary lines of the corpus.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Customary statements of each family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-only",
    ),
    "cc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under CC BY-SA 4.0.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}
TOKEN = re.compile(r"[^\W_]+")
DIMS = 1 << 16
PROSE = 2_000  # ordinary lines sampled by hash for the class none
VARIANTS = 40  # altered copies of each template
KNOWN = 0.99  # share of held-out true paragraphs that the threshold keeps
AGREE = 0.6  # share of a template's words that must occur in order
# A paragraph is read through windows of this many words, so that a statement
# inside a long line is seen; every word lies in a window.
SPAN, STEP = 48, 24


def grams(words: list[str]) -> np.ndarray:
    """Hashed word one- to three-grams, each once."""
    n = len(words)
    terms = {" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(n - k + 1)}
    return np.fromiter({zlib.crc32(t.encode()) % DIMS for t in terms}, np.int64)


def aligned(words: list[str], template: list[str]) -> list[int]:
    """Places of the template's words found in order (longest common
    subsequence, the latest one)."""
    table = [[0] * (len(template) + 1)]
    for w in words:
        prev, row = table[-1], [0]
        for k, t in enumerate(template):
            row.append(prev[k] + 1 if w == t else max(prev[k + 1], row[k]))
        table.append(row)
    i, k, out = len(words), len(template), []
    while i and k:
        if words[i - 1] == template[k - 1]:
            i, k = i - 1, k - 1
            out.append(i)
        elif table[i][k - 1] >= table[i - 1][k]:
            k -= 1
        else:
            i -= 1
    return out[::-1]


_WORDS = {family: [TOKEN.findall(t.lower()) for t in ts] for family, ts in TEMPLATES.items()}
# Words of a family that no other has.
_OWN = {f: {w for t in ts for w in t} - {w for g, us in _WORDS.items() if g != f for u in us for w in u} for f, ts in _WORDS.items()}


def possible(words: list[str]) -> bool:
    """Whether any template can agree at all: enough of its words are there."""
    there = set(words)
    return any(sum(w in there for w in t) >= AGREE * len(t) for ts in _WORDS.values() for t in ts)


@dataclass
class LicenseModel:
    families: list[str]
    weights: np.ndarray  # (family + none, DIMS + bias)
    threshold: float
    hints: frozenset[str]

    def probabilities(self, rows: list[np.ndarray]) -> np.ndarray:
        z = np.stack([self.weights[:, r].sum(axis=1) / np.sqrt(max(1, len(r))) + self.weights[:, -1] for r in rows])
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def statements(self, window: list[str]) -> list[tuple[list[int], str, float, float]]:
        """(places of its words, family, probability, template agreement) of
        every statement in the window."""
        out, left, spent = [], list(range(len(window))), set()
        while left and possible(words := [window[i] for i in left]):
            p = self.probabilities([grams(words)])[0]
            known = 1 - p[-1]
            if known < self.threshold:
                break
            best = None
            for k in np.argsort(-p[:-1]):
                if (family := self.families[k]) in spent:
                    continue
                agree = [(len(at) / len(t), at) for t in _WORDS[family] for at in [aligned(words, t)] if len(at) >= AGREE * len(t)]
                # After the first, words that all families share do not make another.
                agree = [x for x in agree if not out or any(words[i] in _OWN[family] for i in x[1])]
                if agree:
                    best = family, max(a for a, _ in agree), max((at for _, at in agree), key=len)
                    break
                if not out:
                    break
                spent.add(family)
            if best is None:
                break
            family, share, at = best
            out.append(([left[i] for i in at], family, float(known), float(share)))
            left = [x for i, x in enumerate(left) if i not in set(at)]
        return out

    def classify(self, paragraph: str) -> list[tuple[int, str, float, float]]:
        """(line, family, probability, template agreement) of every statement
        in a paragraph, in order; a statement has the line that it starts on."""
        words, line = [], []
        for i, text in enumerate(paragraph.split("\n")):
            found_ = TOKEN.findall(text.lower())
            words += found_
            line += [i] * len(found_)
        # Windows over the whole paragraph, and over each line by itself.
        bounds = {(0, len(words))}
        if line and line[0] != line[-1]:
            starts = [k for k in range(len(line)) if not k or line[k] != line[k - 1]] + [len(line)]
            bounds |= set(zip(starts, starts[1:]))
        found = []
        for a, b in sorted(bounds):
            # No template can agree without its words: such windows need no look.
            at = [i - a for i in range(a, b) if words[i] in self.hints]
            for lo in sorted({a + k * STEP for i in at for k in (i // STEP, i // STEP - 1) if k >= 0}):
                for places, *rest in self.statements(words[lo : min(b, lo + SPAN)]):
                    found.append((lo + places[0], lo + places[-1], *rest))
        # A statement is seen in several windows: the best view of it counts.
        out = []
        for x in sorted(found, key=lambda x: (-x[4], -x[3], x[0])):
            if not any(x[2] == y[2] and x[0] <= y[1] and y[0] <= x[1] for y in out):
                out.append(x)
        best: dict[tuple[int, str], tuple[float, float]] = {}
        for a, _, family, known, agree in out:
            best[line[a], family] = max(best.get((line[a], family), (0.0, 0.0)), (known, agree))
        return [(*k, *v) for k, v in sorted(best.items())]


def _softmax_fit(rows: list[np.ndarray], y: np.ndarray, k: int, decay: float = 1e-4, steps: int = 150) -> np.ndarray:
    """Multinomial logistic regression on sparse rows scaled to unit length;
    only columns that occur are trained. Classes weigh alike."""
    cols, inverse = np.unique(np.concatenate(rows), return_inverse=True)
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    value = 1 / np.sqrt(np.maximum(1, np.bincount(at, minlength=len(rows))))[at]
    share = (1 / (k * np.maximum(1, np.bincount(y, minlength=k))))[y][:, None]
    goal = np.eye(k)[y]
    w = np.zeros((len(cols) + 1, k))
    ahead = w
    for step in range(steps):
        z = np.zeros((len(rows), k))
        for c in range(k):
            z[:, c] = np.bincount(at, value * ahead[inverse, c], minlength=len(rows)) + ahead[-1, c]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        err = share * (z / z.sum(axis=1, keepdims=True) - goal)
        grad = decay * ahead
        for c in range(k):
            grad[:-1, c] += np.bincount(inverse, value * err[at, c], minlength=len(cols))
        grad[-1] = err.sum(axis=0)
        new = ahead - 2.0 * grad
        ahead, w = new + step / (step + 3) * (new - w), new
    full = np.zeros((k, DIMS + 1))
    full[:, cols], full[:, -1] = w[:-1].T, w[-1]
    return full


def fit(docs: DataFrame, text: str = "text", prose: int = PROSE, seed: int = 11) -> LicenseModel:
    """Train on altered templates against ``prose`` lines of ``docs`` chosen by
    hash (lines that hold no template word count as ordinary). An empty table
    trains on the templates alone."""
    families = sorted(TEMPLATES)
    hints = frozenset(w for ts in TEMPLATES.values() for t in ts for w in TOKEN.findall(t.lower()) if len(w) > 2)
    rare = sorted(w for w in hints if re.search("licens|spdx|redistribut|permission|copyright", w))
    lines = docs.select(F.explode(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n", -1)).alias("line"))
    lines = lines.where((F.length("line") > 20) & ~F.lower("line").rlike("|".join(rare)))
    tokens = F.regexp_extract_all(F.lower("line"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    lines = lines.withColumn("h", F.xxhash64("line")).orderBy("h", "line").limit(prose).select("h", tokens.alias("w")).where(F.size("w") > 0)
    # One window of each line, anywhere in it.
    start = F.pmod("h", F.greatest(F.size("w") - SPAN + 1, F.lit(1)).cast("long")).cast("int") + 1
    plain = [list(x[0]) for x in lines.select(F.slice("w", start, SPAN)).collect()] or [["text"]]

    r = np.random.default_rng(seed)
    rows, y = [], []
    for k, family in enumerate(families):
        for template in TEMPLATES[family]:
            words = TOKEN.findall(template.lower())
            for _ in range(VARIANTS):
                kept = [w for w in words if r.random() > 0.1] or words
                around = plain[r.integers(len(plain))]
                a, b = sorted(r.integers(0, len(around) + 1, 2))
                lead, tail = (around[a:b], around[b:]) if r.random() < 0.6 else ([], [])
                rows.append(grams((lead + kept + tail)[:SPAN] if len(lead) + len(kept) <= SPAN else kept[:SPAN]))
                y.append(k)
    rows += [grams(w) for w in plain]
    y = np.array(y + [len(families)] * len(plain))
    order = r.permutation(len(rows))
    held, rest = order[: len(order) // 4], order[len(order) // 4 :]
    w = _softmax_fit([rows[i] for i in rest], y[rest], len(families) + 1)
    model = LicenseModel(families, w, 0.5, hints)
    known = 1 - model.probabilities([rows[i] for i in held])[:, -1]
    true, none = known[y[held] < len(families)], known[y[held] == len(families)]
    model.threshold = float(max(np.quantile(true, 1 - KNOWN), none.max(initial=0.0) if len(none) else 0.0, 0.05)) if len(true) else 0.5
    model.threshold = min(model.threshold, 0.9)
    return model


FOUND = T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()), T.StructField("family", T.StringType()), T.StructField("probability", T.DoubleType()), T.StructField("agreement", T.DoubleType())]))


def scan(docs: DataFrame, model: LicenseModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus ``found`` (line number, family, probability,
    template agreement) for every row, in line order, over whole texts. Null
    counts as empty; repeated rows stay repeated; an empty table gives an empty
    one; other columns are not looked at."""
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text}`").alias("text"))
    schema = d.select("row").schema.add("found", FOUND)
    kind = pa.list_(pa.struct([("line", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("agreement", pa.float64())]))
    # Paragraphs without any such stem count as ordinary.
    need = re.compile("|".join(sorted({_marker(t) for ts in TEMPLATES.values() for t in ts})), re.I)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}
        for batch in batches:
            out = []
            for t in batch.column("text"):
                t, found = t.as_py() or "", []
                if need.search(t):
                    for start, paragraph in paragraphs(t):
                        if need.search(paragraph):
                            hits = seen.get(paragraph)
                            if hits is None:
                                hits = model.classify(paragraph)
                                if len(seen) >= 10_000:
                                    seen.clear()
                                if len(paragraph) <= 2_000:  # long ones rarely repeat
                                    seen[paragraph] = hits
                            for at, *rest in hits:
                                found.append({"line": start + at, **dict(zip(("family", "probability", "agreement"), rest))})
                out.append(found)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, kind)], schema=pa.schema([batch.schema.field("row"), pa.field("found", kind)]))

    return d.mapInArrow(run, schema).select(*[F.col("row").getField(c).alias(c) for c in keep], "found")


def paragraphs(text: str) -> Iterator[tuple[int, str]]:
    """(number of the first line, text) of every run of lines with words."""
    start, held = 0, []
    for i, line in enumerate(text.split("\n")):
        if TOKEN.search(line):
            if not held:
                start = i
            held.append(line)
        elif held:
            yield start, "\n".join(held)
            held = []
    if held:
        yield start, "\n".join(held)


def _marker(template: str) -> str:
    """The stem of a statement by which its paragraphs are looked up."""
    low = template.lower()
    return next(s for s in ("licens", "redistribut", "permission") if s in low)
