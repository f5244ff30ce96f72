"""DuckDB SQL for the bound queries, where SQL can express them."""

from __future__ import annotations

#: A word, as a DuckDB pattern, and the words of a text.
WORD = "[^\\x20\\x09-\\x0D]+"
WORDS = f"coalesce(regexp_extract_all(text, '{WORD}'), [])"

OP1 = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents
), wins AS (
  SELECT doc_id, i, list_slice(w, i, i + 4) AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
), twice AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM wins) WHERE n > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM twice, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM d
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         len(l) AS n_lines
  FROM d JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), f AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END)
          + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
          + (CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END)
          + (CASE WHEN word_chars > 15 * n_words THEN 8 ELSE 0 END)
          + (CASE WHEN 100 * n_symbols > 10 * n_words THEN 16 ELSE 0 END)
          + (CASE WHEN n_lines >= 5 AND 100 * n_dup_lines > 30 * n_lines THEN 32 ELSE 0 END) AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, CAST(failed AS BIGINT) AS failed
FROM f
"""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
LOWER_WORDS = f"coalesce(regexp_extract_all({LOWER}, '{WORD}'), [])"

OP10 = f"""
WITH i AS (
  SELECT item_id, {LOWER_WORDS} AS w FROM benchmark
), item_shingles AS (
  SELECT DISTINCT item_id, array_to_string(list_slice(w, k, k + 4), ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS k FROM i)
), d AS (
  SELECT doc_id, {LOWER_WORDS} AS w FROM documents
), doc_shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, k, k + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM d)
), sizes AS (SELECT item_id, count(*) AS n FROM item_shingles GROUP BY item_id)
SELECT doc_id, item_id, n AS n_item_shingles, count(*) AS n_shared
FROM doc_shingles JOIN item_shingles USING (s) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id, n HAVING 5 * count(*) >= 4 * n
"""

OP12 = f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, {WORDS} AS w FROM documents
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (CASE WHEN len(w) < 50 THEN 1 ELSE 0 END)
       + (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END)
       + (CASE WHEN 100 * (length(text) - length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(text) THEN 4 ELSE 0 END)
       + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
       + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END) AS failed
  FROM d LEFT JOIN l USING (doc_id)
), cells AS (
  SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, failed
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(f, b)
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.b + b.b + c.b + d.b + e.b = 31 AND (a.b | b.b | c.b | d.b | e.b) = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS own, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), r AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN failed & (own | before) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN failed & own <> 0 AND failed & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN failed & own <> 0 AND failed & before <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN failed & own <> 0 AND failed & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN failed & own <> 0 AND failed & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""

ORACLE: dict[str, str] = {"op1_quality_rules": OP1, "op10_decontaminate": OP10, "op12_filter_audit": OP12}
