"""The filter audit against running every order step by step."""

from __future__ import annotations

from itertools import permutations

import pytest

from gatewatch.llm import interactions

WORD = " \t\n\x0b\x0c\r"


def fails(rows):
    """Per row the set of failing filters, by their plain definitions."""
    texts: dict[str, list] = {}
    for i, text, _ in rows:
        if i is not None:
            texts.setdefault(text or "", []).append(i)
    out = []
    for i, text, part in rows:
        text = text or ""
        words = [w for w in text.translate(str.maketrans(dict.fromkeys(WORD, " "))).split(" ") if w]
        f = set()
        if len(words) < 200:
            f.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            f.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text):
            f.add("C")
        if set(text) & set("#$%&*|"):
            f.add("D")
        if i is not None and any(j < i for j in texts.get(text, [])):
            f.add("E")
        out.append((part or "", i, f))
    return out


def brute_force(rows, labels):
    docs = fails(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    out = []
    for part in {p for p, _, _ in docs}:
        own = [(i, f) for p, i, f in docs if p == part]
        shares = dict.fromkeys("ABCDE", 0)
        found = []
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                failing = [d for d in own if x in d[1]]
                shares[x] += len(gone)
                found.append([part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), sum(f == {x} for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), x])
        out += [(*r[:-1], shares[r[-1]]) for r in found]
    return sorted(out)


def run(spark, rows, labels, columns="doc_id long, text string, lang string"):
    docs = spark.createDataFrame(rows, columns)
    return interactions.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def words(n, step=1):
    return " ".join(f"w{i // step}" for i in range(n))


ROWS = [
    (1, words(200), "en"),
    (2, words(199), "en"),
    (3, words(200), "de"),  # a copy in another part
    (9, words(200), "en"),
    (9, words(200), "en"),  # a repeated row
    (4, words(400, 3), "en"),
    (5, words(400, 2), "en"),  # distinct words exactly half
    (6, "A" * 3 + "b" * 97, "fr"),
    (7, "A" * 4 + "b" * 96, "fr"),
    (8, words(300) + " |", "fr"),
    (10, None, None),
    (11, "", ""),
    (12, None, "en"),
    (None, words(200), "en"),
    (None, words(200), "de"),
    (13, "É" * 100 + "A B", "en"),
    (14, "x y\x1cz " * 300, "en"),  # neither is a blank
    (15, "# " * 100_000, "en"),
]
LABELS = [(1, 1, 0), (3, 1, 1), (9, 1, None), (2, 0, 1), (2, 1, 0), (10, 1, 1), (None, 1, 1), (99, 1, 1)]


def test_every_step_equals_brute_force(spark):
    found = run(spark, ROWS, LABELS)
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in found.collect()) == brute_force(ROWS, LABELS)


def test_hot_text_and_extra_columns(spark):
    rows = [(i, words(10), "en") for i in range(300)] + [(1000 + i, words(250) + f" {i}", "en") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS own", "'x' AS digest", "2 AS mask", "3 AS good", "4 AS part")
    found = interactions.audit(docs, spark.createDataFrame([(0, 1, 1)], "doc_id long, quality int, toxic int"))
    assert sorted(tuple(r) for r in found.collect()) == brute_force(rows, [(0, 1, 1)])


@pytest.mark.parametrize("labels", [[], LABELS])
def test_empty_tables(spark, labels):
    assert run(spark, [], labels).collect() == []
    assert run(spark, ROWS[:3], []).count() == 2 * 600
