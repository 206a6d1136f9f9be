"""Quality rules: a threshold table compiled into one projection.

``measures`` adds the per-text measures with built-in functions only, and
``verdict`` turns the rows of a threshold table into one boolean column. No
user functions, no shuffle: each text is judged on its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.words import WORD, words

SYMBOLS = "#*$%&|<>"

# Frequent function words of the supported languages.
STOP_WORDS = {
    "en": ("the", "be", "to", "of", "and", "that", "have", "with", "in", "is", "it", "for", "on", "was", "as", "by"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "ein", "eine"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una"),
}


@dataclass(frozen=True)
class Rule:
    """``measure`` (an SQL expression over the measures) must lie in
    [lo, hi]; a missing bound does not bind."""

    name: str
    measure: str
    lo: float | None = None
    hi: float | None = None


# Ratios are integer comparisons scaled by 100 or 1000, so both engines agree. No
# text is too long, and stop words decide only on texts that they cover.
RULES: tuple[Rule, ...] = (
    Rule("words", "n_words", lo=50),
    Rule("repeated_windows", "100 * n_repeat_words - 50 * n_words", hi=0),
    Rule("mean_word_low", "word_chars - 2 * n_words", lo=0),
    Rule("mean_word_high", "word_chars - 12 * n_words", hi=0),
    Rule("symbols", "10 * n_symbols - n_words", hi=0),
    Rule("stop_words", "CASE WHEN covered THEN 100 * n_stop_words - 2 * n_words ELSE 0 END", lo=0),
    Rule("duplicate_lines", "100 * n_dup_lines - 50 * n_lines", hi=0),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words")


def measures(docs: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """The ``keep`` columns plus ``MEASURES`` (long) of every row.

    Null text counts as empty: all measures are 0. Repeated rows give repeated
    rows, an empty table an empty one. Columns of ``docs`` other than ``keep``
    and ``text`` are not looked at, so their names cannot clash; a ``keep``
    column named like a measure is an error.

    Repeated windows are found by sorting a text's three-word windows with
    their positions and comparing neighbours: n log n for long texts, too.
    """
    if clash := set(keep) & set(MEASURES):
        raise ValueError(f"columns named like measures: {sorted(clash)}")
    kept = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(1)
    d = docs.select(kept.alias("__k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__t"))
    d = d.select("__k", "__t", words("__t").alias("__w"))
    stop = sorted({s for listed in STOP_WORDS.values() for s in listed})
    n = F.size("__w")
    word = lambda i: F.get("__w", i)
    d = d.withColumn(
        "__h",
        F.when(n > 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))),
    )
    # Distinct hashes prove that no window repeats; only other texts are sorted.
    windows = F.arrays_zip("__w", F.slice("__w", 2, n), F.slice("__w", 3, n), F.sequence(F.lit(0), n - 1))
    d = d.select(
        "__k",
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.regexp_count("__t", F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        F.filter(F.split("__t", "\n", -1), lambda x: x.rlike(WORD)).alias("__l"),
        F.size(F.filter("__w", lambda x: F.lower(x).isin(*stop))).cast("long").alias("n_stop_words"),
        F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.sort_array(windows))
        .cast("array<struct<a:string,b:string,c:string,i:int>>")
        .alias("__g"),
    )
    same = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    again = F.filter("__g", lambda x, i: same(x, F.get("__g", i - 1)) | same(x, F.get("__g", i + 1)))
    d = d.withColumn("__p", F.transform(again, lambda x: x["i"]))
    covered = F.concat("__p", F.transform("__p", lambda p: p + 1), F.transform("__p", lambda p: p + 2))
    # The measures leave through a generator: a filter on them must not be
    # pushed into the projections above, where every step would be repeated.
    measured = F.struct(
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("__p").isNull(), 0).otherwise(F.size(F.array_distinct(covered))).cast("long").alias("n_repeat_words"),
        "n_stop_words",
    )
    d = d.select("__k", F.inline(F.array(measured)))
    return d.select(*([f"__k.`{c}`" for c in keep]), *MEASURES)


def verdict(rules: Sequence[Rule] = RULES) -> Column:
    """One boolean expression over the measures: every rule of the table holds."""
    ok = F.lit(True)
    for r in rules:
        value = F.expr(r.measure)
        if r.lo is not None:
            ok = ok & (value >= r.lo)
        if r.hi is not None:
            ok = ok & (value <= r.hi)
    return ok


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def covered(text: Column, lang: Column | None = None) -> Column:
    """Whether the stop words cover a text: half of its letters at least are
    Latin, and its language, where one is given, is listed."""
    t = F.coalesce(text, F.lit(""))
    latin = 2 * F.regexp_count(t, F.lit(r"\p{IsLatin}")) >= F.regexp_count(t, F.lit(r"\p{L}"))
    if lang is None:
        return latin
    code = F.lower(F.regexp_extract(F.coalesce(lang, F.lit("")), "^[A-Za-z]*", 0))
    return latin & code.isin("", "und", *STOP_WORDS)


def judge(
    docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", keep: Sequence[str] = ("doc_id",), lang: str | None = None
) -> DataFrame:
    """``keep``, then ``n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept`` (never true where the base fails),
    ``n_lines`` and ``n_stop_words``. ``lang`` names a column with the language."""
    over = covered(F.col(f"`{text}`"), F.col(f"`{lang}`") if lang else None)
    kept = F.struct(*[F.col(f"`{c}`") for c in keep])
    packed = docs.select(kept.alias("row"), F.col(f"`{text}`").alias("text"), over.alias("covered"))
    m = measures(packed, "text", ("row", "covered"))
    m = m.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & verdict(rules)})
    order = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_stop_words")
    return m.select(*[F.col("row").getField(c).alias(c) for c in keep], *order)


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", lang: str | None = None) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that ``judge`` keeps."""
    packed = docs.select(F.struct("*").alias("row"), F.col(f"`{text}`").alias("text"), *([F.col(f"`{lang}`").alias("lang")] if lang else []))
    good = judge(packed, rules, "text", ("row",), "lang" if lang else None).where("kept")
    return good.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
