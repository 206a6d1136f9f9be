"""DuckDB SQL for the queries that SQL can express, on whole tables."""

from __future__ import annotations

_W = "[^\\x20\\x09-\\x0D]+"

MIX = f"""
WITH d AS (
  SELECT doc_id, source, md5(text) AS digest, CAST(len(regexp_extract_all(coalesce(text, ''), '{_W}')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 3 * source_size AS cap, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s
), fill AS (
  -- A level is right if what the sources take at it is the whole.
  SELECT a.source, (sum(b.source_size) - sum(CASE WHEN b.cap * a.weight < a.cap * b.weight THEN b.cap ELSE 0 END))
      / CAST(sum(CASE WHEN b.cap * a.weight < a.cap * b.weight THEN 0 ELSE b.weight END) AS DOUBLE) AS level
  FROM w a, w b GROUP BY a.source
), level AS (
  SELECT max(level) AS level FROM fill JOIN w ON fill.source IS NOT DISTINCT FROM w.source WHERE level * weight <= cap
), t AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), level * weight) AS target FROM w, level
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
    CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || coalesce(digest, '')), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""

_STOP = (
    "the be to of and that have with in is it for on was as by der die und den von zu das mit sich des auf ist im ein eine "
    "de la le et les en un du une que est pour qui dans par el y a los se del las por con no una"
)

QUALITY = f"""
WITH t AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_W}') AS w,
    2 * len(regexp_extract_all(coalesce(text, ''), '\\p{{Latin}}')) >= len(regexp_extract_all(coalesce(text, ''), '\\p{{L}}'))
      AND lower(regexp_extract(coalesce(lang, ''), '^[A-Za-z]*')) IN ('', 'und', 'de', 'en', 'es', 'fr') AS covered FROM documents
), windows AS (
  SELECT k, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM t)
), twice AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, a, b, c) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT k, CAST(count(DISTINCT i + j) AS BIGINT) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS j) GROUP BY k
), m AS (
  SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_W}')) AS l,
    coalesce(covered.n, 0) AS n_repeat_words,
    CAST(len(list_filter(w, lambda x: list_contains(string_split('{_STOP}', ' '), lower(x)))) AS BIGINT) AS n_stop_words, covered
  FROM t LEFT JOIN covered USING (k)
), n AS (
  SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, n_repeat_words, n_stop_words, covered,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM m
)
SELECT * EXCLUDE covered, NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 12 * n_words
  AND 10 * n_symbols <= n_words AND (NOT covered OR 100 * n_stop_words >= 2 * n_words) AND 100 * n_dup_lines <= 50 * n_lines AS kept
FROM n
"""


def _shingles(table: str, key: str) -> str:
    return f"""SELECT DISTINCT {key}, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS s
  FROM (SELECT {key}, w, unnest(range(1, len(w) - 3)) AS i FROM (
    SELECT {key}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') AS w FROM {table}))"""


LEAKS = f"""
WITH q AS ({_shingles("benchmark", "item_id")}), n AS (SELECT item_id, count(*) AS n_item FROM q GROUP BY item_id),
x AS (SELECT * FROM ({_shingles("documents", "doc_id")}) WHERE s IN (SELECT s FROM q)),
c AS (SELECT doc_id, item_id, count(*) AS n_shared FROM x JOIN q USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared FROM c JOIN n USING (item_id) WHERE 100 * n_shared >= 75 * n_item
"""

# Every order is applied step by step: a document goes at the first filter of
# the order that it fails. Documents that fail the same filters go together.
INTERACTIONS = f"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_W}') AS w FROM documents
), l AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id
), o AS (
  SELECT text, min(doc_id) AS first FROM d GROUP BY text
), v AS (
  SELECT part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text) AS c, regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(doc_id > first, false) AS e, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM d JOIN o USING (text) LEFT JOIN l USING (doc_id)
), g AS (
  SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
      || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS failed,
    count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM v GROUP BY ALL
), f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), p AS (
  SELECT f1.x || f2.x || f3.x || f4.x || f5.x AS filter_order FROM f f1, f f2, f f3, f f4, f f5
  WHERE len(list_distinct([f1.x, f2.x, f3.x, f4.x, f5.x])) = 5
), s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, filter_order[step] AS x FROM p, range(1, 6) t(step)
), h AS (
  SELECT part, failed, n, good, toxic, filter_order,
    (SELECT min(strpos(filter_order, y)) FROM (SELECT unnest(string_split(failed, '')) AS y) WHERE failed <> '') AS gone
  FROM g, p
), r AS (
  SELECT part, s.filter_order, step, x,
    coalesce(sum(n) FILTER (WHERE gone IS NULL OR gone > step), 0) AS kept, coalesce(sum(n) FILTER (WHERE gone = step), 0) AS removed,
    coalesce(sum(n) FILTER (WHERE strpos(failed, x) > 0 AND gone < step), 0) AS redundant,
    coalesce(sum(n) FILTER (WHERE failed = x), 0) AS unique_fails,
    coalesce(sum(good) FILTER (WHERE gone = step), 0) AS good_lost, coalesce(sum(toxic) FILTER (WHERE gone = step), 0) AS toxic_lost
  FROM h JOIN s USING (filter_order) GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM r
"""

ORACLE = {"op2_source_mix": MIX, "op3_quality_rules": QUALITY, "op8_benchmark_leaks": LEAKS, "op11_filter_interactions": INTERACTIONS}
