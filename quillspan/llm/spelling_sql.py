"""The spelling variants in SQL: checksums bit by bit from a table, near words by their texts with one character left out."""

from __future__ import annotations


def _crc_entry(i: int) -> int:
    for _ in range(8):
        i = (i >> 1) ^ 0xEDB88320 if i & 1 else i >> 1
    return i


def spelling_sql() -> str:
    table = ", ".join(str(_crc_entry(i)) for i in range(256))
    bytes_of = "flatten(list_transform(string_split(s, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) AS BIGINT) - 64] END))"
    return rf"""
WITH RECURSIVE crc AS (SELECT [{table}]::BIGINT[] AS t),
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
each AS (SELECT doc_id, run, count(*) AS n, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s FROM runs WHERE length(run) >= 5 GROUP BY ALL),
summed AS (
  SELECT run, n, xor(list_reduce({bytes_of}, lambda r, b: xor(t[xor(r & 255, b) + 1], r >> 8), 4294967295::BIGINT), 4294967295::BIGINT) AS h
  FROM each, crc),
w AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word FROM summed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
less AS (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM less a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM less a JOIN w b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM w LEFT JOIN best USING (word)),
way AS (SELECT word, word AS root, 0 AS step FROM forms UNION ALL SELECT way.word, forms.form, step + 1 FROM way JOIN forms ON forms.word = way.root WHERE forms.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(root, step) AS root FROM way GROUP BY word) USING (word)
"""
