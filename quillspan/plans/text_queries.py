"""Queries over documents as articles, each beside its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import annotations, boundaries, evaluation, mentions, merging, passages, prompts, ranking, relation_model, tagging
from ..session import materialise, shared_dir, ship
from . import inputs as I
from .inputs import with_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def pairs_text(column: str):
    """Spans as text."""
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["s"].cast("string"), x["e"].cast("string"))), ";")


SPANS_TEXT = "array_to_string(list_transform(list_sort(spans), lambda x: CAST(x[1] AS VARCHAR) || ':' || CAST(x[2] AS VARCHAR)), ';')"


@query("SELECT doc_id, lang FROM documents WHERE (lang IS NULL OR upper(lang) IN ('EN', 'FR')) AND text IS NOT NULL")
def section_filter(spark: SparkSession, d: str) -> DataFrame:
    docs = I.table(spark, d, "documents")
    return docs.where(passages.in_or_absent(F.col("lang"), ["EN", "FR"]) & F.col("text").isNotNull()).select("doc_id", "lang")


@query(with_sql("SELECT doc_id, passage_idx, u_start, CAST(length(text) AS INT) AS n_chars FROM passages", I.PASSAGES_SQL))
def passage_explode(spark: SparkSession, d: str) -> DataFrame:
    return I.article_passages(spark, d).select("doc_id", "passage_idx", "u_start", F.char_length("text").alias("n_chars"))


@query(
    with_sql(
        """SELECT doc_id, passage_idx, entity_type, entity_idx, name FROM found
           WHERE NOT (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AND entity_type IN ('compounds', 'genes', 'species'))
           UNION ALL SELECT doc_id, 0, 'species', 0, 'labelled' FROM labels WHERE toxic = 1""",
        *I.TO_SPANS,
        "found AS (SELECT DISTINCT doc_id, passage_idx, entity_type, entity_idx, name FROM spans)",
    )
)
def pre_annotation_override(spark: SparkSession, d: str) -> DataFrame:
    annotated = I.table(spark, d, "labels").where("toxic = 1").select(
        "doc_id", F.lit(0).alias("passage_idx"), F.lit("species").alias("entity_type"), F.lit(0).alias("entity_idx"), F.lit("labelled").alias("name")
    )
    return passages.override(I.located(spark, d), annotated)


@query(with_sql("SELECT doc_id, passage_idx, entity_type, name, s, e FROM spans", *I.TO_SPANS))
def find_spans(spark: SparkSession, d: str) -> DataFrame:
    return I.spans(spark, d)


@query(with_sql("SELECT doc_id, passage_idx, entity_type, name, CAST(count(*) AS INT) AS n_spans FROM spans GROUP BY ALL", *I.TO_SPANS))
def hallucination_filter(spark: SparkSession, d: str) -> DataFrame:
    return I.located(spark, d).select("doc_id", "passage_idx", "entity_type", "name", F.size("spans").alias("n_spans"))


@query(
    with_sql(
        f"SELECT doc_id, entity_type, merge_key, name, {SPANS_TEXT} AS spans, array_to_string(list_sort(list_filter(names, lambda x: lower(x) <> lower(name))), ';') AS alt_names FROM merged",
        *I.TO_SPANS,
        I.MERGED_SQL,
    )
)
def merge_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = merging.merge_duplicates(I.linked_mentions(spark, d))
    return out.select("doc_id", "entity_type", "merge_key", "name", pairs_text("spans").alias("spans"), F.array_join("alt_names", ";").alias("alt_names"))


@query(
    with_sql(
        f"""SELECT doc_id, entity_type, name, {SPANS_TEXT} AS spans, alt_names FROM (
              SELECT m.doc_id, m.entity_type, coalesce(t.name, m.name) AS name, list_distinct(flatten(list(m.spans))) AS spans,
                     array_to_string(list_sort(list_distinct(list_concat(flatten(list(list_filter(m.names, lambda x: lower(x) <> lower(m.name)))), list(m.name) FILTER (t.name IS NOT NULL)))), ';') AS alt_names
              FROM merged m LEFT JOIN merged t
                ON t.doc_id = m.doc_id AND t.entity_type = m.entity_type AND m.name = {I.quoted(I.SHORT)} AND lower(t.name) = lower({I.quoted(I.LONG)})
              GROUP BY ALL)""",
        *I.TO_SPANS,
        I.MERGED_SQL,
    )
)
def abbrev_merge(spark: SparkSession, d: str) -> DataFrame:
    entities = merging.merge_duplicates(I.linked_mentions(spark, d))
    short = I.table(spark, d, "documents").select("doc_id", F.lit(I.SHORT).alias("short"), F.lit(I.LONG).alias("long"))
    out = merging.merge_abbreviations(entities.drop("merge_key"), short)
    return out.select("doc_id", "entity_type", "name", pairs_text("spans").alias("spans"), F.array_join("alt_names", ";").alias("alt_names"))


@query(
    with_sql(
        "SELECT a.doc_id, a.name AS subj, b.name AS obj, b.entity_type AS category FROM e a JOIN e b ON a.doc_id = b.doc_id AND a.entity_type = 'compounds' AND b.entity_type <> 'compounds'",
        *I.TO_SPANS,
        "e AS (SELECT DISTINCT doc_id, entity_type, name FROM spans)",
    )
)
def entity_pairs(spark: SparkSession, d: str) -> DataFrame:
    return ranking.entity_pairs(I.located(spark, d).select("doc_id", "entity_type", "name").distinct())


@query(
    with_sql(
        "SELECT x.doc_id, x.entity_type, x.name, u.unit_idx, count(*) AS n FROM spans x JOIN w u ON x.doc_id = u.doc_id AND x.e > u.u_start AND x.s < u.u_end GROUP BY ALL",
        *I.TO_SPANS,
        "w AS (SELECT doc_id, unit_idx, 500 * unit_idx AS u_start, 500 * unit_idx + 500 AS u_end FROM (SELECT doc_id, unnest(range(0, length(text) // 500 + 1)) AS unit_idx FROM documents))",
    )
)
def span_unit_overlap(spark: SparkSession, d: str) -> DataFrame:
    docs = I.table(spark, d, "documents")
    windows = docs.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.char_length("text") / 500))).alias("unit_idx"))
    windows = windows.withColumns({"u_start": F.col("unit_idx") * 500, "u_end": F.col("unit_idx") * 500 + 500})
    return ranking.unit_counts(I.spans(spark, d), windows).select("doc_id", "entity_type", "name", "unit_idx", "n")


@query(with_sql("SELECT doc_id, entity_type, name, df, n_units, round(idf, 6) AS idf FROM idf", *I.TO_RANKED))
def idf(spark: SparkSession, d: str) -> DataFrame:
    out = I.weighed(I.spans(spark, d), I.units(spark, d))
    return out.select("doc_id", "entity_type", "name", "df", "n_units", F.round("idf", 6).alias("idf")).distinct()


@query(with_sql("SELECT doc_id, unit_idx, subj, category, obj, n_a, n_b, round(co, 6) AS co FROM scored", *I.TO_RANKED))
def pair_cooccurrence_score(spark: SparkSession, d: str) -> DataFrame:
    pairs = ranking.pair_units(I.weighed(I.spans(spark, d), I.units(spark, d)))
    return pairs.select("doc_id", "unit_idx", "subj", "category", "obj", "n_a", "n_b", F.round(ranking.co_count(F.col("n_a"), F.col("n_b")), 6).alias("co"))


@query(with_sql("SELECT doc_id, unit_idx, subj, category, obj, round(prox, 6) AS prox, same FROM scored", *I.TO_RANKED))
def proximity_bonus(spark: SparkSession, d: str) -> DataFrame:
    return I.scored(I.spans(spark, d), I.units(spark, d)).select("doc_id", "unit_idx", "subj", "category", "obj", F.round("prox", 6).alias("prox"), "same")


@query(with_sql("SELECT doc_id, subj, category, obj, unit_idx, CAST(rank AS INT) AS rank, round(score, 6) AS score FROM top", *I.TO_RANKED))
def rank_passages_topk(spark: SparkSession, d: str) -> DataFrame:
    return ranking.top_units(I.scored(I.spans(spark, d), I.units(spark, d)), 2).select("doc_id", "subj", "category", "obj", "unit_idx", "rank", F.round("score", 6).alias("score"))


@query(with_sql("SELECT doc_id, subj, category, obj, CAST(rank AS INT) AS rank, sent_idx, round(sent_score, 6) AS score FROM best", *I.TO_BEST))
def best_sentences(spark: SparkSession, d: str) -> DataFrame:
    return I.chosen(spark, d)["best"].select("doc_id", "subj", "category", "obj", "rank", "sent_idx", F.round("sent_score", 6).alias("score"))


@query(with_sql("SELECT doc_id, passage_idx, unit_idx, u_start, u_end, md5(text) AS text_md5 FROM sentences", I.PASSAGES_SQL, I.SENTENCES_SQL))
def sentence_table(spark: SparkSession, d: str) -> DataFrame:
    s = passages.split_sentences(I.article_passages(spark, d)).select("doc_id", "u_start", "passage_idx")
    return I.sentence_units(spark, d).join(s, ["doc_id", "u_start"]).select("doc_id", "passage_idx", "unit_idx", "u_start", "u_end", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(
    r"""SELECT doc_id, CAST(i - 1 AS INT) AS sent_idx, CAST(beg AS INT) AS s, CAST(beg + length(parts[i]) AS INT) AS e
        FROM (SELECT *, coalesce(sum(length(parts[i]) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS beg
              FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i
                    FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])\s+([A-Z(])', '\1' || chr(1) || '\2', 'g'), chr(1)) AS parts FROM documents)))"""
)
def sentence_split(spark: SparkSession, d: str) -> DataFrame:
    docs = I.table(spark, d, "documents")
    rows = docs.select("doc_id", F.posexplode(tx.sentence_spans(F.col("text"), F.lit(0))).alias("sent_idx", "x"))
    return rows.select("doc_id", "sent_idx", "x.s", "x.e")


@query(
    with_sql(
        """SELECT DISTINCT doc_id, subj, category, obj, CAST(i AS INT) AS sent_idx FROM (
             SELECT b.doc_id, subj, category, obj, unnest(range(greatest(0, sent_idx - 1), least(n - 1, sent_idx + 1) + 1)) AS i
             FROM best b JOIN (SELECT doc_id, count(*) AS n FROM sentences GROUP BY ALL) USING (doc_id))""",
        *I.TO_BEST,
    )
)
def context_window(spark: SparkSession, d: str) -> DataFrame:
    c = I.chosen(spark, d)
    n = c["places"].groupBy("doc_id").agg(F.count("*").cast("int").alias("n"))
    return ranking.context_indices(c["best"], n)


@query(
    with_sql(
        """SELECT doc_id, subj, category, obj, md5(array_to_string(list_concat(have, list_filter(spare, lambda x: NOT list_contains(have, x))), chr(10))) AS context_md5
           FROM (SELECT k.doc_id, k.subj, k.category, k.obj, coalesce(l.have, []) AS have, coalesce(p.spare, []) AS spare
                 FROM (SELECT DISTINCT doc_id, subj, category, obj FROM top) k LEFT JOIN lines l USING (doc_id, subj, category, obj) LEFT JOIN spares p USING (doc_id, subj, category, obj))
           WHERE trim(array_to_string(list_concat(have, list_filter(spare, lambda x: NOT list_contains(have, x))), chr(10))) <> ''""",
        *I.TO_BEST,
        """near AS (SELECT DISTINCT doc_id, subj, category, obj, i AS unit_idx FROM (
             SELECT b.doc_id, subj, category, obj, unnest(range(greatest(0, sent_idx - 1), least(n - 1, sent_idx + 1) + 1)) AS i
             FROM best b JOIN (SELECT doc_id, count(*) AS n FROM sentences GROUP BY ALL) USING (doc_id)))""",
        "lines AS (SELECT doc_id, subj, category, obj, list(text ORDER BY unit_idx) AS have FROM near JOIN sentences USING (doc_id, unit_idx) GROUP BY ALL)",
        """firsts AS (SELECT doc_id, subj, category, obj, text, min(rank) AS rank FROM top t JOIN units u USING (doc_id, unit_idx)
             WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.doc_id = t.doc_id AND b.subj = t.subj AND b.category = t.category AND b.obj = t.obj AND b.rank = t.rank) GROUP BY ALL)""",
        "spares AS (SELECT doc_id, subj, category, obj, list(text ORDER BY rank) AS spare FROM firsts GROUP BY ALL)",
    )
)
def context_assembly(spark: SparkSession, d: str) -> DataFrame:
    c = I.chosen(spark, d)
    out = ranking.assemble(c["top"], c["best"], c["sentences"].withColumnRenamed("unit_idx", "sent_idx"), c["units"], c["places"])
    return out.select("doc_id", "subj", "category", "obj", F.md5(F.col("context").cast("binary")).alias("context_md5"))


_SCORED = """gold AS (SELECT DISTINCT entity_type, doc_id, lower(name) AS name, s, e FROM spans JOIN labels USING (doc_id) WHERE quality = 1),
predicted AS (SELECT DISTINCT entity_type, doc_id, lower(name) AS name, s, e FROM spans JOIN labels USING (doc_id) WHERE toxic = 0 AND name <> 'und')"""


@query(
    with_sql(
        """SELECT label, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall,
                  round(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END, 6) AS f1
           FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall
                 FROM (SELECT entity_type AS label, count(*) FILTER (g AND p) AS tp, count(*) FILTER (p AND NOT g) AS fp, count(*) FILTER (g AND NOT p) AS fn
                       FROM (SELECT coalesce(gold.entity_type, predicted.entity_type) AS entity_type, gold.s IS NOT NULL AS g, predicted.s IS NOT NULL AS p
                             FROM gold FULL JOIN predicted USING (entity_type, doc_id, name, s, e))
                       GROUP BY GROUPING SETS ((), (entity_type))))""",
        *I.TO_SPANS,
        _SCORED,
    )
)
def ner_prf(spark: SparkSession, d: str) -> DataFrame:
    rows = I.spans(spark, d).withColumn("name", F.lower("name")).join(I.table(spark, d, "labels"), "doc_id")
    out = evaluation.precision_recall(rows.where("quality = 1"), rows.where("toxic = 0 AND name <> 'und'"), ["entity_type", "doc_id", "name", "s", "e"], "entity_type")
    return out.select("label", "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query(with_sql("SELECT doc_id, passage_idx, entity_type, name, s, e FROM annotated", I.PASSAGES_SQL, I.ANNOTATED_SQL))
def annotated_names(spark: SparkSession, d: str) -> DataFrame:
    """The gold names from which the tagger learns."""
    return I.annotated(spark, d)


@query(
    with_sql(
        "SELECT doc_id, passage_idx, count(*) AS n, count_if(tag <> 'O') AS n_named, md5(string_agg(s || ' ' || tag, chr(10) ORDER BY i)) AS tags_md5 FROM told GROUP BY ALL",
        I.PASSAGES_SQL, I.ANNOTATED_SQL, I.TOKENS_SQL,
    )
)
def token_tags(spark: SparkSession, d: str) -> DataFrame:
    """Each passage's tokens with the tags that gold names give them."""
    rows = tagging.tagged(I.article_passages(spark, d), I.annotated(spark, d)).where(F.size("tokens") > 0)
    lines = F.array_join(F.transform("tokens", lambda x: F.concat_ws(" ", x["s"], x["tag"])), "\n")
    named = F.size(F.filter("tokens", lambda x: x["tag"] != "O")).cast("long")
    return rows.select("doc_id", "passage_idx", F.size("tokens").cast("long").alias("n"), named.alias("n_named"), F.md5(lines.cast("binary")).alias("tags_md5"))


@query()
def tagged_names(spark: SparkSession, d: str) -> DataFrame:
    """Names that a tagger, learned from the documents that were labelled, finds in all documents; tests hold it against all tag paths."""
    p = I.article_passages(spark, d)
    known = p.join(I.table(spark, d, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return tagging.learn_tagger(known, materialise(I.annotated(spark, d))).extract(p)


_WORD_SQL = "regexp_replace(lower({0}), '\\.$', '')"
_BARE_SQL = f"regexp_replace(t, '{boundaries.EDGES.replace(chr(39), chr(39) * 2)}', '', 'g')"
_CHANCE_SQL = "(CASE WHEN {k} > 0 THEN {k} * ln({p}) ELSE 0 END + CASE WHEN {n} > {k} THEN ({n} - {k}) * ln(1 - {p}) ELSE 0 END)"


@query(
    f"""WITH split AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i FROM (SELECT doc_id, string_split_regex(text, '\\s+') AS w FROM documents)),
       bare AS (SELECT doc_id, i, {_BARE_SQL} AS t FROM split), told AS (SELECT doc_id, i, {_WORD_SQL.format("t")} AS word, t LIKE '%.' AS dotted FROM bare),
       words AS (SELECT word, count(*) AS n, count_if(dotted) AS k FROM told WHERE regexp_matches(word, '[\\p{{L}}\\p{{N}}]') GROUP BY 1),
       shaped AS (SELECT word, n, k, CAST(sum(k) OVER () AS DOUBLE) / sum(n) OVER () AS p, length(regexp_replace(word, '[^.]', '', 'g')) AS stops, CAST(length(word) AS DOUBLE) AS size FROM words)
       SELECT word, n, k AS n_dotted,
              round(2 * ({_CHANCE_SQL.format(k="k", n="n", p=boundaries.SURE)} - {_CHANCE_SQL.format(k="k", n="n", p="p")}) * exp(stops - size) * (stops + 1) * pow(size - stops, k - n), 6) + 0.0 AS score
       FROM shaped WHERE k > 0 AND NOT regexp_matches(word, '^\\p{{N}}')"""
)
def abbreviation_scores(spark: SparkSession, d: str) -> DataFrame:
    """How much each dotted word of the documents is like an abbreviation."""
    found = boundaries.abbreviation_scores(materialise(boundaries.neighbours(I.table(spark, d, "documents"), every=False)))
    return found.withColumns({"score": F.round("score", 6) + F.lit(0.0), "n_dotted": F.col("n_dotted").cast("long")})


@query()
def learned_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of all passages, cut where ends learned from all documents say so; tests hold the ratios against plain Python."""
    model = boundaries.learn_boundaries(I.table(spark, d, "documents"))
    rows = boundaries.split_sentences(I.article_passages(spark, d), model)
    return rows.select("doc_id", "passage_idx", F.explode("sentences").alias("x")).select("doc_id", "passage_idx", "x.*")


@query()
def learned_relations(spark: SparkSession, d: str) -> DataFrame:
    """A relation model learned from the documents that were labelled answers and judges the first two words of each passage in all
    documents; the tables have no gold relations, so the language of the document is the predicate.  Tests hold the fit against Newton's method."""
    spoken = I.table(spark, d, "documents").select("doc_id", "lang")
    words = lambda i: F.get(F.split("text", " "), F.lit(i))
    p = I.article_passages(spark, d).join(spoken, "doc_id").select("doc_id", "passage_idx", F.col("text").alias("context"), words(0).alias("subj"), words(1).alias("obj"), F.col("lang").alias("actual"))
    model = relation_model.learn_relations(p.join(I.table(spark, d, "labels").select("doc_id").distinct(), "doc_id", "left_semi"))
    return model.judge()(model.answers(p)).select("doc_id", "passage_idx", "predicate", "justification", "decision")


@query(with_sql("SELECT doc_id, passage_idx, entity_type, name, s, e FROM spans WHERE NOT (entity_type = 'species' AND lower(name) = 'und')", *I.TO_SPANS))
def annotation_remove(spark: SparkSession, d: str) -> DataFrame:
    unwanted = spark.createDataFrame([("species", "UND"), ("genes", "the")], "entity_type string, name string")
    return annotations.remove(I.spans(spark, d), unwanted)


_MARK_SQL = "concat_ws(' ', s, e, entity_type, name)"


@query(
    with_sql(
        f"SELECT doc_id, count(*) AS n, md5(string_agg({_MARK_SQL}, chr(10) ORDER BY s, e, entity_type, name)) AS marks_md5 FROM spans WHERE entity_type IN ('compounds', 'species') GROUP BY 1",
        *I.TO_SPANS,
    )
)
def annotations_saved(spark: SparkSession, d: str) -> DataFrame:
    """Annotations to which names are added that are partly there, saved in order of place and read again."""
    marks, path = I.spans(spark, d).drop("passage_idx"), f"{shared_dir(spark)}/annotations-{uuid.uuid4().hex}"
    annotations.save(annotations.add(marks.where("entity_type = 'compounds'"), marks.where("entity_type IN ('compounds', 'species')")), path)
    read = spark.read.schema("doc_id long, annotations array<struct<s:int,e:int,entity_type:string,name:string>>").json(path)
    lines = F.transform("annotations", lambda x: F.concat_ws(" ", x["s"].cast("string"), x["e"].cast("string"), x["entity_type"], x["name"]))
    return read.select("doc_id", F.size("annotations").cast("long").alias("n"), F.md5(F.array_join(lines, "\n").cast("binary")).alias("marks_md5"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    done = I.table(spark, d, "labels").select("doc_id")
    return I.table(spark, d, "documents").select("doc_id").join(done, "doc_id", "left_anti")


@query(
    """SELECT conv_id, turn, md5(""" + prompts.EXTRACTION_SQL + "text" + """) AS prompt_md5 FROM conversations WHERE text IS NOT NULL"""
)
def prompt_text(spark: SparkSession, d: str) -> DataFrame:
    rows = I.table(spark, d, "conversations").where("text IS NOT NULL")
    return rows.select("conv_id", "turn", F.md5(prompts.extraction(F.col("text")).cast("binary")).alias("prompt_md5"))


_INITIALS_SQL = "array_to_string(list_transform(string_split(p_name, ' '), lambda x: upper(x[1])), '')"


@query(
    f"""SELECT p_partkey AS doc_id, {_INITIALS_SQL} AS short, CASE WHEN p_size % 2 = 0 THEN upper(p_name[1]) || p_name[2:] ELSE p_name END AS long
        FROM part WHERE p_size % 5 <> 0 AND length({_INITIALS_SQL}) > 1"""
)
def abbreviation_detect(spark: SparkSession, d: str) -> DataFrame:
    """Names of parts with their initials, defined at a title word or within a sentence; every fifth size defines nothing."""
    from ..operators.abbreviations import detect

    ship(spark)
    name = F.col("p_name")
    initials = F.array_join(F.transform(F.split(name, " "), lambda x: F.upper(F.substring(x, 1, 1))), "")
    titled = F.concat(F.lit("We list: "), F.upper(F.substring(name, 1, 1)), F.expr("substring(p_name, 2)"))
    said = F.when(F.col("p_size") % 2 == 0, titled).otherwise(F.concat(F.lit("zany young "), name))
    short = F.when(F.col("p_size") % 5 == 0, "no definition").otherwise(initials)
    texts = F.array(F.concat(said, F.lit(" ("), short, F.lit(") is there.")), F.lit("(Nothing more.)"))
    parts = I.table(spark, d, "part").select(F.col("p_partkey").alias("doc_id"), F.posexplode(texts).alias("passage_idx", "text"))
    return detect(parts).where(F.char_length("short") > 1)


@query(with_sql("SELECT DISTINCT entity_type || ': ' || lower(name) AS value FROM spans", *I.TO_SPANS))
def reference_lines(spark: SparkSession, d: str) -> DataFrame:
    return annotations.reference_lines(I.spans(spark, d))
