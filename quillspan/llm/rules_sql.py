"""The quality rules in SQL, with the defaults of quality_rules()."""

from __future__ import annotations

from .quality_rules import CLASSES, VOCABULARY


def _distance(a: str, b: str) -> str:
    """Jensen-Shannon distance of two lists of counts."""
    p, q = f"{a}[i] / list_sum({a})", f"{b}[i] / list_sum({b})"
    term = " + ".join(f"CASE WHEN {x} > 0 THEN {x} * log2(2 * {x} / ({p} + {q})) ELSE 0 END" for x in (p, q))
    return f"sqrt(greatest(list_sum(list_transform(range(1, len({a}) + 1), lambda i: {term})) / 2, 0))"


def rules_sql(least_chars: int = 200, least_words: int = 50, most_class_distance: float = 0.30, most_word_distance: float = 0.36, least_docs: int = 20, least_share: float = 0.001) -> str:
    blanks = " || ".join(["' '", *[f"chr({c})" for c in range(9, 14)]])
    vocabulary = "[" + ", ".join(f"'{w}'" for w in VOCABULARY) + "]"

    def kept(pattern: str) -> str:
        return f"length(regexp_replace(rest, '{pattern}', '', 'g'))"

    upper, digit, mark = kept("[^A-Z]"), kept("[^0-9]"), kept("[^.,;:!?''\"()-]")
    sums = lambda name, n: "[" + ", ".join(f"sum({name}[{i}])" for i in range(1, n + 1)) + "]"
    return rf"""
WITH texts AS (SELECT doc_id, lang, coalesce(text, '') AS x FROM documents),
words AS (
  SELECT doc_id, lang, x, list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda v: v <> '') AS ws,
         list_filter(string_split(x, chr(10)), lambda v: trim(v, {blanks}) <> '') AS lines,
         regexp_replace(x, '[a-z\x20\x09-\x0D\x{{80}}-\x{{10FFFF}}]+', '', 'g') AS rest,
         string_split_regex(lower(x), '[^\p{{L}}\p{{M}}]+') AS tokens FROM texts),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4]) AS n
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM words)),
repeated AS (
  SELECT doc_id, CAST(sum(least(5, coalesce(after - i, 5))) AS BIGINT) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM windows WHERE n > 1) GROUP BY 1),
counted AS (
  SELECT doc_id, lang, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(rest, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, {upper} AS upper_, {digit} AS digit_, {mark} AS mark_, length(rest) AS rest_, strlen(x) - length(x) AS beyond_,
         CASE WHEN len(ws) >= {least_words} THEN list_transform({vocabulary}, lambda v: len(list_filter(tokens, lambda u: u = v))) ELSE [] END AS found
  FROM words LEFT JOIN repeated USING (doc_id)),
measured AS (
  SELECT doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         [upper_, digit_, mark_, rest_ - upper_ - digit_ - mark_, beyond_, greatest(0, word_chars - rest_ - beyond_)] AS classes,
         CASE WHEN len(found) > 0 THEN list_append(found, greatest(0, n_words - CAST(list_sum(found) AS BIGINT))) ELSE [] END AS common
  FROM counted),
good AS (
  SELECT lang, classes, common, count(*) OVER (PARTITION BY lang) >= greatest({least_docs}, {least_share} * count(*) OVER ()) AS own
  FROM measured WHERE NOT base_failed AND len(common) > 0),
refs AS (
  SELECT {sums("classes", len(CLASSES))} AS ref_classes, {sums("common", len(VOCABULARY) + 1)} AS ref_common
  FROM good GROUP BY own, CASE WHEN own THEN lang END),
near AS (
  SELECT m.doc_id, min(CASE WHEN list_sum(classes) >= {least_chars} THEN {_distance("classes", "ref_classes")} END) AS class_distance,
         min(CASE WHEN len(common) > 0 THEN {_distance("common", "ref_common")} END) AS word_distance
  FROM measured m, refs GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (coalesce(class_distance, 0) > {most_class_distance} OR coalesce(word_distance, 0) > {most_word_distance}) AS kept,
       round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance
FROM measured LEFT JOIN near USING (doc_id)
"""
