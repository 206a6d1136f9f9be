"""Columns of the registered queries, and edges of their contracts."""

from __future__ import annotations

import re
import time
from collections import Counter

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from gatewatch.llm import jaccard, language, mixing, quality, queries, secret_scan

WORDS = [f"w{i}" for i in range(60)]
TEXT, OTHER = " ".join(WORDS), " ".join(reversed(WORDS))

COLUMNS = {
    "op1_url_filters": ["page_id", "host", "path", "rule", "verdict"],
    "op2_source_mix": ["doc_id", "size", "source_size", "target", "taken"],
    "op3_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op5_ngram_jaccard": ["doc_id", "n_shingles", "component_id"],
    "op6_substring_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op7_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op10_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op11_filter_interactions": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns_come_first(spark, name):
    found = queries.QUERIES[name](spark, SF001)
    assert found.columns[: len(COLUMNS[name])] == COLUMNS[name]


def near(text):
    return text + " more"


def test_near_duplicates_are_decided_by_row(spark):
    rows = [
        (1, TEXT), (4, " ".join(f"a{i}" for i in range(40))), (4, " ".join(f"b{i}" for i in range(40))),  # one id, two texts
        (5, near(TEXT)), (5, OTHER),  # a copy and a text of its own
        (None, " ".join(f"c{i}" for i in range(40))), (None, " ".join(f"c{i}" for i in range(40))), (None, TEXT),
        (6, OTHER), (6, OTHER), (7, None), (7, " "), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1))
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    want = [rows[0], rows[1], rows[2], rows[4], rows[5], rows[10], rows[11], rows[12]]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(want)


def test_rows_without_an_id_draw_for_themselves(spark):
    rows = [(None, f"one two {i}", "a") for i in range(600)] + [(i, "x " * 30, "b") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = mixing.mix_plan(docs).where("source = 'a'").collect()
    taken, target = sum(r["size"] * r["copies"] for r in plan), plan[0].target
    assert target % 1800 and abs(taken - target) < 0.1 * target
    assert mixing.mix(docs).where("source = 'a'").count() * 3 == taken


def test_long_and_foreign_texts_are_not_rejected_for_it(spark):
    long = " ".join(f"the word{i} item{i}" for i in range(40_000))  # 120,000 words
    greek = " ".join(f"λόγος{i}" for i in range(80))
    rows = [(1, long, "en"), (2, greek, "el"), (3, greek, None), (4, " ".join(f"lorem{i}" for i in range(80)), "en"), (5, " ".join(f"lorem{i}" for i in range(80)), "it")]
    found = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"), lang="lang")
    assert {r.doc_id: r.kept for r in found.collect()} == {1: True, 2: True, 3: True, 4: False, 5: True}


def test_only_letters_make_a_language():
    assert not any(language.LETTER.search(t) for t in ("½ ² ٣ ५ _ 12", "😀 — …"))
    assert all(language.LETTER.search(t) for t in ("a", "½ é", "語", "ª"))


def test_candidates_beside_matches_in_one_pass():
    text = "".join(f"password=abcdef{i} zz{i}yX9QwErTy12345AaBb\n" for i in range(200))
    taken = secret_scan.patterns(text) if hasattr(secret_scan, "patterns") else None
    taken = taken or sorted(("assign", m.start(), m.end()) for m in re.finditer(r"password=\S+", text))
    taken = sorted(taken, key=lambda s: s[1])
    slow = [m.span() for m in secret_scan.CANDIDATE.finditer(text) if secret_scan._has_mix(m.group()) and not any(m.start() < e and s < m.end() for _, s, e in taken)]
    assert secret_scan.candidates(text, taken) == slow and slow
    spans = [("hex", 3 * i, 3 * i + 2 + (i % 7 == 0) * 40) for i in range(100)]
    body = "a1" * 5 + " b2c3D4e5F6g7H8i9J0k1 " * 30
    slow = [m.span() for m in secret_scan.CANDIDATE.finditer(body) if secret_scan._has_mix(m.group()) and not any(m.start() < e and s < m.end() for _, s, e in spans)]
    assert secret_scan.candidates(body, spans) == slow
    many = "\n".join(f"k{i}Abc9XyZ{i}qWeRt12345" for i in range(100_000))
    matches = [("hex", a, a + 3) for a in range(0, len(many), 16)]
    start = time.time()
    secret_scan.candidates(many, matches)
    assert time.time() - start < 10


BASE = [
    ("assign", r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 0, 20),
    ("hex", r"[0-9a-f]+", 0, 0, 24),
]


def test_base_secrets_equal_brute_force(spark):
    """Every base column of op10 on all documents, by the contract's patterns."""
    import hashlib

    found = {r.doc_id: r for r in queries.op10_secret_scan(spark, SF001).collect()}
    for doc in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect():
        text, spans, counts = doc.text or "", [], []
        for k, (kind, pattern, flags, group, least) in enumerate(BASE):
            # Letters of the pattern in either case means ASCII letters only.
            own = [m.span() for m in re.finditer(pattern, text, flags | (re.A if flags else 0)) if len(m.group(group)) >= least]
            counts.append(len(own))
            spans += [(a, k, f"{kind}:{a}:{b}") for a, b in own]
        digest = hashlib.sha256(",".join(s for *_, s in sorted(spans)).encode()).hexdigest()
        row = found[doc.doc_id]
        assert (row.n_assign, row.n_access, row.n_hex, row.base_sha256) == (*counts, digest), doc.doc_id


RULES = [("net/", False), ("example.net/en/", True), ("example.com/de/", False), ("org/fr/", True)]


def test_url_rules_equal_brute_force(spark):
    for row, page in zip(queries.op1_url_filters(spark, SF001).orderBy("page_id").collect(), spark.read.parquet(f"{SF001}/pages.parquet").orderBy("page_id").collect()):
        url, host, path = page.url, "", ""
        if url is not None and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest).group()
            path = re.match(r"[^?#]*", rest[len(host) :]).group()
            host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fit = []
        for rule, allow in RULES:
            h, _, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fit.append((len(rule), rule, allow))
        best = max(fit) if fit else None
        assert (row.page_id, row.host, row.path, row.rule) == (page.page_id, host, path, best and best[1])
        assert row.verdict in ("allow", "block") and (best is None or row.verdict == ("allow" if best[2] else "block"))
