"""Tokenizer alignment against a byte-by-byte brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import SF001
from tokenizers import Tokenizer

from gatewatch.llm import alignment, queries


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair.load(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def brute_force(pair, rows):
    whole = Tokenizer.from_str(pair.a)
    whole.encode_special_tokens = True
    _, encode_b, a_bytes, b_bytes = pair.ready()
    counts, found = Counter(), []
    for i, text in rows:
        text = text or ""
        a, b = whole.encode(" " + text, add_special_tokens=False).ids, encode_b([text])[0]
        spelled = [b"".join(t[x] for x in ids) for t, ids in ((a_bytes, a), (b_bytes, b))]
        if not text or spelled != [(" " + text).encode()] * 2:
            found.append((i, 0, 0, 0, [], ""))
            continue
        of_a = [k for k, x in enumerate(a) for _ in a_bytes[x]]
        of_b = [k for k, x in enumerate(b) for _ in b_bytes[x]]
        links = [(a[x], b[y]) for x, y in sorted(set(zip(of_a, of_b)))]
        counts.update(links)
        groups, last = [], (0, 0)
        for p in range(1, len(of_a) + 1):
            here = (of_a[p] if p < len(of_a) else len(a), of_b[p] if p < len(of_b) else len(b))
            if p == len(of_a) or (of_a[p] != of_a[p - 1] and of_b[p] != of_b[p - 1]):
                groups.append(",".join(map(str, a[last[0] : here[0]])) + "|" + ",".join(map(str, b[last[1] : here[1]])))
                last = here
        found.append((i, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top: dict[int, int] = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    return sorted(
        ((i, n_a, n_b, g, len(l), sum(counts[p] == top[p[1]] for p in l), sum(counts[p] for p in l), h) for i, n_a, n_b, g, l, h in found), key=str
    )


ROWS = [
    (1, None), (2, ""), (3, " "), (4, "x"), (5, "  two  spaces \n\n\tx"), (6, "héllo <|endoftext|> <s> 日本語 🎉🎉"), (7, "a▁b"), (8, "x\x00y"), (9, "a" * 5000),
    (9, "a" * 5000), (None, "null id"), (10, "  x\x85y\x1cz  　q"), (11, "don't WE'LL  é½²\t\t x"), (12, "word " * 3000), (13, "﻿​ á"), (12, "another text of id 12"),
]


@pytest.mark.parametrize("size, hot", [(1 << 15, 200_000), (5, 20), (1, 1)])
def test_equals_brute_force(spark, pair, size, hot):
    rows = [(i, t if size > 1 or len(t or "") < 1000 else t[:300]) for i, t in ROWS]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "'x' AS a", "2 AS m")
    found = alignment.align_documents(docs, pair, size=size, hot=hot)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute_force(pair, rows)


def test_empty_table(spark, pair):
    assert alignment.align_documents(spark.createDataFrame([], "doc_id long, text string"), pair).collect() == []


def test_query_on_all_documents(spark, pair):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in queries.op13_tokenizer_alignment(spark, SF001).collect()), key=str) == brute_force(pair, rows)


@pytest.mark.parametrize("seed", range(5))
def test_merge_path_splits_the_merge(seed):
    g = np.random.default_rng(seed)
    a, b = (np.unique(g.integers(0, 300, n)) for n in g.integers(1, 200, 2))
    merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
    diagonals = np.arange(len(merged) + 1)
    want = np.concatenate([[0], np.cumsum([side == 0 for _, side in merged])])
    assert (alignment.merge_path(a, b, diagonals) == want).all()


def test_fast_encoder_is_the_slow_one(pair):
    """tiktoken only where it is the same: texts of plain characters."""
    whole = Tokenizer.from_str(pair.a)
    whole.encode_special_tokens = True
    encode = pair.ready()[0]
    assert encode.__name__ == "encode"  # this vocabulary allows it
    every = "".join(map(chr, [9, 10, 13, *range(32, 127), *range(0xA1, 0x250)]))
    for text in (every, " ".join(every), every[::-1], "  a\r\n\r\n  b'S 'll", "x" * 3000, "\x0b\x0c\x85 ", "<|endoftext|>"):
        assert encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids
