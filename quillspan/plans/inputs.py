"""The driver tables in the roles of articles, extractions, ontologies and gold files, for both engines.

Documents are articles whose lines are passages; a lexicon stands in for the extractor.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let, running_starts
from ..operators import mentions, passages, ranking
from ..schemas import ENTITY_POLICY
from ..session import materialise, spread, written

# The names that are looked for.
LEXICON = [
    ("compounds", "the"),
    ("compounds", "de la"),
    ("species", "of the"),
    ("species", "und"),
    ("genes", "que"),
    ("pathways", "is"),
    ("anatomical_structures", "an"),
    ("human_traits", "not (there)"),
]
# Ids that linking would give some of the names.
IDS = {"the": "X:1", "de la": "X:1", "is": "P:7"}
SHORT, LONG = "und", "Of The"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, n) for t, n in LEXICON], "entity_type string, name string")


def article_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.split_passages(table(spark, sf_dir, "documents"))


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.drop_unfound(mentions.locate_all(article_passages(spark, sf_dir), lexicon(spark)))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once: every later step starts from this small table, not from the texts."""
    return materialise(mentions.spans_of(located(spark, sf_dir)))


# What is annotated in the documents, and how it is told from other text.
ANNOTATED = {
    "address": r"[A-Za-z0-9]+(\.[A-Za-z0-9]+)*@[A-Za-z0-9]+(\.[A-Za-z0-9]+)+",
    "host": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}",
    "telephone": r"\+[0-9]{1,2} \([0-9]{3}\) [0-9]{3}-[0-9]{4}",
}
_NAMED = "|".join(ANNOTATED.values())


def annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold names: addresses, hosts and telephone numbers of the documents that were labelled; doc_id, passage_idx, entity_type, name, s, e."""
    p = article_passages(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    cut = p.select("doc_id", "passage_idx", "u_start", F.split("text", _NAMED, -1).alias("parts"), F.regexp_extract_all("text", F.lit(_NAMED), F.lit(0)).alias("names")).where(F.size("names") > 0)
    begin = running_starts(F.zip_with(F.slice("parts", 1, F.size("names")), "names", lambda x, y: F.char_length(x) + F.char_length(y)))
    places = let(begin, lambda at: F.transform("names", lambda x, i: F.struct(x.alias("name"), (F.get(at, i) + F.char_length(F.get("parts", i))).alias("at"))))
    x = cut.select("doc_id", "passage_idx", "u_start", F.explode(places).alias("x")).select("doc_id", "passage_idx", "u_start", "x.*")
    kind = reduce(lambda other, k: F.when(F.col("name").rlike(f"^({ANNOTATED[k]})$"), k).otherwise(other), reversed(ANNOTATED), F.lit(None).cast("string"))
    s = F.col("u_start") + F.col("at")
    return x.select("doc_id", "passage_idx", kind.alias("entity_type"), "name", s.cast("int").alias("s"), (s + F.char_length("name")).cast("int").alias("e"))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages as units: doc_id, unit_idx, u_start, u_end, text."""
    p = article_passages(spark, sf_dir)
    return p.select("doc_id", F.col("passage_idx").alias("unit_idx"), "u_start", (F.col("u_start") + F.char_length("text")).cast("int").alias("u_end"), "text")


def sentence_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences as units, numbered over the document."""
    return passages.number_sentences(table(spark, sf_dir, "documents")).drop("passage_idx")


def linked_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of the lexicon with the ids that linking gave them."""
    ids = F.lit(None).cast("string")
    for name, value in IDS.items():
        ids = F.when(F.col("name") == name, value).otherwise(ids)
    none = F.lit(None).cast("long")
    return located(spark, sf_dir).withColumns({"ontology_id": ids, "CID": none, "taxonomy_id": none.cast("int")})


def weighed(found: DataFrame, u: DataFrame) -> DataFrame:
    return ranking.inverse_frequency(ranking.unit_counts(found, u), u)


def scored(found: DataFrame, u: DataFrame) -> DataFrame:
    """Pairs with their score in each unit."""
    return ranking.passage_scores(ranking.pair_units(ranking.sentence_indices(weighed(found, u), u)))


def chosen(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Units, sentences and their places (written once, without the texts), the top passages of each pair and the best sentences in them."""
    found, u, s = spans(spark, sf_dir), units(spark, sf_dir), sentence_units(spark, sf_dir)
    places = written(s.drop("text"))
    top = materialise(ranking.top_units(scored(found, u), 2))
    return {"units": u, "sentences": s, "places": places, "top": top, "best": materialise(ranking.best_sentences(top, weighed(found, places), 2))}


# ---------- the same in SQL ----------


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


LEXICON_SQL = f"lexicon(entity_idx, entity_type, name) AS (VALUES {', '.join(f'({i}, {quoted(t)}, {quoted(n)})' for i, (t, n) in enumerate(LEXICON))})"
PASSAGES_SQL = r"""
passages AS (
  SELECT doc_id, CAST(i - 1 AS INT) AS passage_idx, parts[i] AS text,
         CAST(coalesce(sum(length(parts[i]) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS u_start
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)))"""
_EDGE = r"'[\p{L}\p{M}\p{N}_]'"
SPANS_SQL = rf"""
hits AS (
  SELECT doc_id, passage_idx, u_start, text, entity_type, entity_idx, name, string_split(lower(text), lower(name)) AS parts
  FROM passages, lexicon WHERE contains(lower(text), lower(name))),
places AS (
  SELECT *, CAST(sum(length(parts[i])) OVER (PARTITION BY doc_id, passage_idx, entity_idx ORDER BY i) + (i - 1) * length(name) AS INT) AS p
  FROM (SELECT *, unnest(range(1, len(parts))) AS i FROM hits)),
spans AS (
  SELECT doc_id, passage_idx, entity_type, entity_idx, name, CAST(u_start + p AS INT) AS s, CAST(u_start + p + length(name) AS INT) AS e
  FROM places
  WHERE contains(name, ' ') OR contains(name, '(')
     OR NOT (regexp_matches(CASE WHEN p = 0 THEN ' ' ELSE substring(text, p, 1) END, {_EDGE})
             OR regexp_matches(substring(text, p + length(name) + 1, 1), {_EDGE})))"""
_KIND_SQL = "CASE " + " ".join(f"WHEN regexp_full_match(name, {quoted(x)}) THEN {quoted(k)}" for k, x in ANNOTATED.items()) + " END"
ANNOTATED_SQL = f"""
cut AS (SELECT doc_id, passage_idx, u_start, regexp_extract_all(text, {quoted(_NAMED)}) AS names, string_split_regex(text, {quoted(_NAMED)}) AS parts
        FROM passages WHERE doc_id IN (SELECT doc_id FROM labels)),
laid AS (SELECT doc_id, passage_idx, name, u_start + n + coalesce(sum(n + length(name)) OVER (PARTITION BY doc_id, passage_idx ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
         FROM (SELECT doc_id, passage_idx, u_start, i, names[i] AS name, length(parts[i]) AS n FROM (SELECT *, unnest(range(1, len(names) + 1)) AS i FROM cut))),
annotated AS (SELECT doc_id, passage_idx, {_KIND_SQL} AS entity_type, name, CAST(s AS INT) AS s, CAST(s + length(name) AS INT) AS e FROM laid)"""
TOKENS_SQL = r"""
pieces AS (SELECT doc_id, passage_idx, u_start, regexp_extract_all(text, '\p{L}+|\p{N}+|[^\p{L}\p{N}]') AS w FROM passages),
tokens AS (SELECT doc_id, passage_idx, i, x, u_start + coalesce(sum(length(x)) OVER (PARTITION BY doc_id, passage_idx ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
           FROM (SELECT doc_id, passage_idx, u_start, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM pieces)),
told AS (SELECT t.doc_id, t.passage_idx, t.i, t.s, CASE WHEN a.name IS NULL THEN 'O' WHEN t.s = a.s THEN 'B-' || a.entity_type ELSE 'I-' || a.entity_type END AS tag
         FROM tokens t LEFT JOIN annotated a
           ON t.doc_id = a.doc_id AND t.passage_idx = a.passage_idx AND t.s >= a.s AND t.s + length(t.x) <= a.e
         WHERE NOT regexp_matches(t.x, '^[ \t\n\v\f\r]$'))"""
UNITS_SQL = "units AS (SELECT doc_id, passage_idx AS unit_idx, u_start, CAST(u_start + length(text) AS INT) AS u_end, text FROM passages)"
SENTENCES_SQL = r"""
pieces AS (
  SELECT doc_id, passage_idx, u_start, parts, unnest(range(1, len(parts) + 1)) AS i
  FROM (SELECT doc_id, passage_idx, u_start, string_split(regexp_replace(text, '([.!?])(\s+)([A-Z(])', '\1\2' || chr(1) || '\3', 'g'), chr(1)) AS parts FROM passages)),
sentences AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY passage_idx, i) - 1 AS INT) AS unit_idx, passage_idx, i, beg AS u_start,
         CAST(beg + length(text) AS INT) AS u_end, text
  FROM (SELECT doc_id, passage_idx, i, regexp_replace(parts[i], '\s+$', '') AS text,
               CAST(u_start + coalesce(sum(length(parts[i])) OVER (PARTITION BY doc_id, passage_idx ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS beg
        FROM pieces)
  WHERE length(text) > 0)"""


def counts_sql(name: str, units: str) -> str:
    """Mentions of each entity in each unit, with their centres."""
    return f"""
{name} AS (
  SELECT x.doc_id, x.entity_type, x.name, u.unit_idx, u.u_start, u.u_end, count(*) AS n, list((x.s + x.e) // 2 ORDER BY (x.s + x.e) // 2) AS pos
  FROM spans x JOIN {units} u ON x.doc_id = u.doc_id AND x.e > u.u_start AND x.s < u.u_end
  GROUP BY ALL)"""


def idf_sql(name: str, counts: str, units: str) -> str:
    return f"""
{name} AS (
  SELECT doc_id, entity_type, name, df, n_units, ln(1 + n_units / greatest(df, 1)) AS idf
  FROM (SELECT doc_id, entity_type, name, count(DISTINCT unit_idx) AS df FROM {counts} GROUP BY ALL)
  JOIN (SELECT doc_id, count(*) AS n_units FROM {units} GROUP BY ALL) USING (doc_id))"""


RANKED_SQL = rf"""
chunks AS (
  SELECT doc_id, unit_idx, u_start, parts, unnest(range(1, len(parts) + 1)) AS i
  FROM (SELECT doc_id, unit_idx, u_start, string_split(regexp_replace(text, '([.!?])\s+([A-Z(])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS parts FROM units)),
inner_sentences AS (
  SELECT doc_id, unit_idx, i - 1 AS k, beg AS s, beg + length(parts[i]) AS e, count(*) OVER (PARTITION BY doc_id, unit_idx) AS n
  FROM (SELECT *, u_start + coalesce(sum(length(parts[i]) + 1) OVER (PARTITION BY doc_id, unit_idx ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS beg FROM chunks)),
placed AS (
  SELECT c.doc_id, c.entity_type, c.name, c.unit_idx, p, min(CASE WHEN x.s <= p AND p < x.e THEN k END) AS inside, any_value(x.n) - 1 AS last, j
  FROM (SELECT *, unnest(pos) AS p, unnest(range(1, len(pos) + 1)) AS j FROM counts) c JOIN inner_sentences x USING (doc_id, unit_idx)
  GROUP BY ALL),
sent AS (SELECT doc_id, entity_type, name, unit_idx, j, coalesce(inside, last) AS k FROM placed),
pairs AS (
  SELECT a.doc_id, a.unit_idx, a.u_start, a.u_end, a.name AS subj, b.entity_type AS category, b.name AS obj, a.n AS n_a, b.n AS n_b, ia.idf AS idf_a, ib.idf AS idf_b
  FROM counts a JOIN counts b ON a.doc_id = b.doc_id AND a.unit_idx = b.unit_idx AND a.entity_type = 'compounds' AND b.entity_type <> 'compounds'
  JOIN idf ia ON ia.doc_id = a.doc_id AND ia.entity_type = a.entity_type AND ia.name = a.name
  JOIN idf ib ON ib.doc_id = b.doc_id AND ib.entity_type = b.entity_type AND ib.name = b.name),
nearest AS (
  SELECT a.doc_id, a.unit_idx, a.name AS subj, b.entity_type AS category, b.name AS obj, a.j, min(abs(a.k - b.k)) AS d
  FROM sent a JOIN sent b ON a.doc_id = b.doc_id AND a.unit_idx = b.unit_idx AND a.entity_type = 'compounds' AND b.entity_type <> 'compounds'
  GROUP BY ALL),
prox AS (SELECT doc_id, unit_idx, subj, category, obj, sum(1.0 / (1.0 + d)) AS prox, min(d) = 0 AS same FROM nearest GROUP BY ALL),
scored AS (
  SELECT *, co * (1 + prox) * idf_a * idf_b * CASE WHEN same THEN {ranking.BOOST} ELSE 1.0 END AS score
  FROM (SELECT *, ln(1 + 2.0 * n_a * n_b / (n_a + n_b + {ranking.EPSILON!r})) AS co FROM pairs JOIN prox USING (doc_id, unit_idx, subj, category, obj))),
top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, subj, category, obj ORDER BY round(score, 9) DESC, unit_idx) AS rank FROM scored) WHERE rank <= 2)"""
BEST_SQL = rf"""
sent_pairs AS (
  SELECT a.doc_id, a.name AS subj, b.entity_type AS category, b.name AS obj, a.unit_idx AS sent_idx, a.u_start AS s_start, a.u_end AS s_end,
         ln(1 + 2.0 * a.n * b.n / (a.n + b.n + {ranking.EPSILON!r})) * 2.0 * ia.idf * ib.idf * {ranking.BOOST} AS sent_score
  FROM sent_counts a JOIN sent_counts b ON a.doc_id = b.doc_id AND a.unit_idx = b.unit_idx AND a.entity_type = 'compounds' AND b.entity_type <> 'compounds'
  JOIN sent_idf ia ON ia.doc_id = a.doc_id AND ia.entity_type = a.entity_type AND ia.name = a.name
  JOIN sent_idf ib ON ib.doc_id = b.doc_id AND ib.entity_type = b.entity_type AND ib.name = b.name),
inside AS (
  SELECT t.doc_id, t.subj, t.category, t.obj, t.rank, t.u_start, t.u_end, p.sent_idx, p.s_start, p.s_end, p.sent_score,
         row_number() OVER (PARTITION BY t.doc_id, t.subj, t.category, t.obj, p.sent_idx ORDER BY t.rank) AS home
  FROM top t JOIN sent_pairs p USING (doc_id, subj, category, obj) WHERE p.s_start >= t.u_start AND p.s_end <= t.u_end),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, subj, category, obj, rank ORDER BY round(sent_score, 9) DESC, sent_idx) AS turn FROM inside WHERE home = 1) WHERE turn <= 2)"""


def with_sql(select: str, *parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n" + select


TO_SPANS = [LEXICON_SQL, PASSAGES_SQL, SPANS_SQL]
TO_RANKED = [*TO_SPANS, UNITS_SQL, counts_sql("counts", "units"), idf_sql("idf", "counts", "units"), RANKED_SQL]
TO_BEST = [*TO_RANKED, SENTENCES_SQL, counts_sql("sent_counts", "sentences"), idf_sql("sent_idf", "sent_counts", "sentences"), BEST_SQL]
IDS_SQL = "CASE name " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in IDS.items()) + " END"
KEYED_TYPES = [t for t, *_, order in ENTITY_POLICY if "ontology_id" in order]
MERGED_SQL = f"""
mentions AS (
  SELECT *, CASE WHEN entity_type IN ({', '.join(map(quoted, KEYED_TYPES))}) THEN coalesce({IDS_SQL}, lower(name)) ELSE lower(name) END AS merge_key FROM spans),
merged AS (
  SELECT doc_id, entity_type, merge_key, arg_min(name, (passage_idx, entity_idx)) AS name, min((passage_idx, entity_idx)) AS turn,
         list(DISTINCT (s, e)) AS spans, list(DISTINCT name) AS names
  FROM mentions GROUP BY ALL)"""


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
