"""Byte-level BPE against tiktoken, and the round trip."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from conftest import SF001
from pyspark.sql import functions as F

from gatewatch.llm import byte_bpe, queries


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.ranks, special_tokens={})


r = random.Random(5)
TEXTS = [
    None, "", " ", "   \n\n\t x", "don't we'll I'm THEY'RE 'tis 's", "héllo wörld — ñandú", "日本語のテキスト 한국어", "👩‍👩‍👧‍👦🏳️‍🌈", "<|endoftext|> <s>",
    "a b c　d\x85e f", "x\x1cy\x1dz\x0bq\x0cw\x00v", "1234567890 ½²٣४", "tab\tline\r\nline\n", "﻿bom ​zero", "ÀÉ̀ combining é",
    "a" * 255, "a" * 256, "a" * 257, "ab" * 3000, "x" * 20_000, "é" * 200, " " * 3000 + "x", "=" * 700, "".join(r.choice("abcdefghij") for _ in range(5000)),
    " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(1, 14))) for _ in range(2000)), "repeat " * 5000, "repeat " * 5000,
]


@pytest.mark.parametrize("share", [1, 1 << 22])
def test_ids_equal_tiktoken_and_decode_to_the_text(spark, vocabulary, reference, share):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "doc_id AS ids", "'w' AS w", "1 AS n")
    out = byte_bpe.decode(byte_bpe.encode(docs, vocabulary, share=share), vocabulary)
    assert out.columns == ["doc_id", "text", "ids", "w", "n", "bytes"]
    for row in out.collect():
        text = TEXTS[row.doc_id] or ""
        assert row.ids == reference.encode_ordinary(text), text[:50]
        assert bytes(row.bytes) == text.encode()
        assert (row.w, row.n) == ("w", 1)


def test_rare_words_are_merged_once_in_a_task_and_not_folded_in_place(spark, vocabulary, reference):
    rare = random.Random(6)
    texts = [" ".join("".join(rare.choice("éabcdefgh'1 ") for _ in range(rare.randrange(1, 12))) for _ in range(300)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 2)], "doc_id long, text string")
    out = byte_bpe.encode(docs, vocabulary, share=1)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan
    assert all(x.ids == reference.encode_ordinary(x.text) for x in out.collect())


def test_long_words_by_heap(vocabulary, reference):
    for text in ("a" * 5000, "".join(r.choice("ab") for _ in range(3000)), "é" * 999, "".join(chr(r.randrange(97, 123)) for _ in range(4000))):
        assert byte_bpe.merge_long(text.encode(), vocabulary.ranks) == reference.encode_ordinary(text)


def test_empty_table_and_unknown_ids(spark, vocabulary):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decode(byte_bpe.encode(empty, vocabulary), vocabulary).collect() == []
    ids = spark.createDataFrame([(None,), ([],), ([0, 256],)], "ids array<int>")
    assert [x.bytes and bytes(x.bytes) for x in byte_bpe.decode(ids, vocabulary).collect()] == [None, bytearray(), b"! t"]
    with pytest.raises(Exception, match="no token has the id 70000"):
        byte_bpe.decode(ids.select(F.array(F.lit(70_000)).alias("ids")), vocabulary).collect()


def test_query_equals_tiktoken_on_all_documents(spark, reference):
    found = queries.op12_byte_bpe(spark, SF001)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    texts = {x.doc_id: x.text or "" for x in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(texts)
    for x in rows:
        ids = reference.encode_ordinary(texts[x.doc_id])
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[x.doc_id].encode()).hexdigest())
        assert tuple(x)[1:] == want
