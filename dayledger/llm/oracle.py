"""Comparison SQL for DuckDB, where SQL can express an operator."""

from __future__ import annotations

from dayledger.llm.quality_rules import STOP_WORDS

ORACLES: dict[str, str] = {}

#: White space of the word rules as an SQL string.
SPACES = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"

ORACLES["op5_line_dedup"] = f"""
WITH lines AS (
    SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
    SELECT *, translate(trim(line, {SPACES}), {CAPITALS}, lower({CAPITALS})) AS key FROM lines
), shared AS (
    SELECT key, max(doc_id) AS holder FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT k.*, s.holder IS NOT NULL AND k.doc_id <> s.holder AS gone FROM keyed k LEFT JOIN shared s USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

ORACLES["op1_quality_rules"] = f"""
WITH split AS (
    SELECT doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(trim(x, {SPACES})) > 0) AS l
    FROM documents
), windows AS (
    SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)
), twice AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM windows) WHERE n > 1
), repeated AS (
    SELECT doc_id, count(DISTINCT i + s) AS n FROM twice, (VALUES (0), (1), (2)) v(s) GROUP BY doc_id
), measured AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
           len(l) - len(list_distinct(l)) AS n_dup_lines,
           coalesce(r.n, 0) AS n_repeat_words, len(l) AS n_lines,
           len(regexp_extract_all(t, '[!?]')) AS exclamations,
           len(regexp_extract_all(t, '\\p{{Lu}}')) AS capitals,
           len(regexp_extract_all(t, '\\p{{L}}')) AS letters,
           len(list_filter(w, lambda x: regexp_matches(x, '\\p{{L}}'))) AS letter_words,
           len(list_intersect(list_distinct(w), [{_STOP}])) AS stops,
           len(list_filter(l, lambda x: regexp_matches(x, '^[\\x20\\x09-\\x0D]*[-*•]'))) AS bullets,
           len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[\\x20\\x09-\\x0D]*$'))) AS ellipses
    FROM split LEFT JOIN repeated r USING (doc_id)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2 AND 14 AND n_symbols / n_words <= 0.10
       AND exclamations / n_words <= 0.20 AND (letters = 0 OR capitals / letters <= 0.50)
       AND letter_words / n_words >= 0.70 AND stops >= 2 AND n_dup_lines / n_lines <= 0.50
       AND bullets / n_lines <= 0.90 AND ellipses / n_lines <= 0.50 AS kept
FROM judged
"""
