"""Queries over the relational tables in the roles of reference data, relations and gold files, each beside its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.vectors import embedder
from ..operators import annotations, embedding, evaluation, hierarchy, linking, loading, mentions, passages, relations
from ..schemas import DEFINITIONS, NO_DEFINITION, NO_RELATION, NOT_GUIDED, PREDICATES, predicate_guidelines
from ..session import materialise, ship
from .inputs import quoted, table, with_sql

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---------- projections and cleaning ----------


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def keyed_child_projection(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query(
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'compounds' WHEN 'click' THEN 'genes' WHEN 'signup' THEN 'species' END AS entity_type
       FROM events WHERE event_type IN ('view', 'click', 'signup')"""
)
def annotation_type_map(spark: SparkSession, d: str) -> DataFrame:
    kind = F.create_map(*[F.lit(x) for x in ("view", "Chemical", "click", "Gene", "signup", "Species", "error", "Disease")])[F.col("event_type")]
    return table(spark, d, "events").select("event_id", passages.annotation_type(kind).alias("entity_type")).where("entity_type IS NOT NULL")


@query("SELECT o_custkey AS doc_id, 0 AS passage_idx, o_orderpriority AS entity_type, o_orderstatus AS name, min(o_orderkey) AS entity_idx FROM orders GROUP BY ALL")
def unique_names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(
        F.col("o_custkey").alias("doc_id"), F.lit(0).alias("passage_idx"), F.col("o_orderpriority").alias("entity_type"), F.col("o_orderstatus").alias("name"), F.col("o_orderkey").alias("entity_idx")
    )
    return mentions.unique_names(rows)


@query(
    """SELECT DISTINCT p_partkey, unnest(list_distinct(list_concat([trim(p_name)], string_split(p_name, ' '), [p_brand, p_type]))) AS surface FROM part"""
)
def surface_expansion(spark: SparkSession, d: str) -> DataFrame:
    synonyms = F.concat(F.split("p_name", " "), F.array("p_brand", "p_type"))
    return linking.surface_forms(table(spark, d, "part"), F.col("p_name"), synonyms).select("p_partkey", "surface")


@query(r"SELECT page_id, md5(regexp_replace(trim(regexp_replace(html, '<[^>]+>', '', 'g')), '\s*\([^)]*\)$', '')) AS text_md5 FROM pages")
def clean_names(spark: SparkSession, d: str) -> DataFrame:
    clean = tx.strip_trailing_parenthesis(F.trim(tx.strip_tags(F.col("html"))))
    return table(spark, d, "pages").select("page_id", F.md5(clean.cast("binary")).alias("text_md5"))


@query("SELECT DISTINCT trim(url) AS id FROM pages WHERE url IS NOT NULL")
def distinct_ids_clean(spark: SparkSession, d: str) -> DataFrame:
    return loading.distinct_ids(table(spark, d, "pages").withColumnRenamed("url", " url "), "url")


# ---------- linking ----------

_COSINE = "list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))"


def _vectors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, d, "embeddings")
    entities = e.select(F.col("vec_id").alias("entity_id"), F.col("label").alias("space"), F.col("embedding").alias("vec"))
    terms = e.select(F.col("vec_id").alias("row_idx"), F.col("label").alias("space"), F.col("embedding").alias("vec"), F.col("vec_id").alias("not_for"))
    return entities, terms


_KNN = f"""SELECT a.vec_id AS entity_id, a.label AS space, b.vec_id AS row_idx, {_COSINE} AS score,
  row_number() OVER (PARTITION BY a.vec_id ORDER BY {_COSINE} DESC, b.vec_id) AS rn
  FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id"""


@query(f"SELECT entity_id, space, row_idx, round(score, 4) AS score FROM ({_KNN}) WHERE rn = 1")
def ontology_knn(spark: SparkSession, d: str) -> DataFrame:
    return linking.nearest_terms(*_vectors(spark, d)).withColumn("score", F.round("score", 4))


@query(f"SELECT entity_id, row_idx FROM ({_KNN}) WHERE rn = 1 AND score > 0.3")
def ontology_threshold(spark: SparkSession, d: str) -> DataFrame:
    return linking.nearest_terms(*_vectors(spark, d)).where("score > 0.3").select("entity_id", "row_idx")


@query(
    f"""SELECT entity_id, space, row_idx, round(score, 4) AS score FROM (
          SELECT a.vec_id AS entity_id, b.label AS space, b.vec_id AS row_idx, {_COSINE} AS score, row_number() OVER (PARTITION BY a.vec_id, b.label ORDER BY {_COSINE} DESC, b.vec_id) AS rn
          FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE rn = 1"""
)
def ontology_search_all(spark: SparkSession, d: str) -> DataFrame:
    entities, terms = _vectors(spark, d)
    spaces = F.broadcast(terms.select("space").distinct())  # one row for each ontology
    everywhere = entities.drop("space").crossJoin(spaces)
    return linking.nearest_terms(everywhere, terms).withColumn("score", F.round("score", 4))


_PARTS = """folded AS (SELECT lower(p_name) AS k, min(p_partkey) AS cid FROM part GROUP BY 1),
compounds AS (SELECT p_partkey, upper(p_name) AS name, CASE WHEN p_size > 25 THEN 'X:' || p_size END AS ontology_id FROM part)"""


def _compounds(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    part = table(spark, d, "part")
    compounds = part.select("p_partkey", F.upper("p_name").alias("name"), F.when(F.col("p_size") > 25, F.concat(F.lit("X:"), F.col("p_size").cast("string"))).alias("ontology_id"))
    synonyms = part.select(F.col("p_partkey").alias("row_idx"), F.col("p_partkey").alias("cid"), F.col("p_name").alias("synonym"))
    smiles = part.where("p_size <= 25").select(F.col("p_partkey").alias("cid"), F.col("p_brand").alias("smiles"))
    keys = part.select(F.col("p_partkey").alias("cid"), F.col("p_type").alias("inchikey"))
    return compounds, synonyms, smiles, keys


@query(with_sql("SELECT p_partkey, c.name, f.cid FROM compounds c LEFT JOIN folded f ON f.k = lower(c.name)", _PARTS))
def synonym_lookup_nocase(spark: SparkSession, d: str) -> DataFrame:
    compounds, *rest = _compounds(spark, d)
    return linking.link_compounds(compounds.withColumn("ontology_id", F.lit(None).cast("string")), *rest).select("p_partkey", "name", "cid")


@query(
    with_sql(
        """SELECT c.p_partkey, f.cid, CASE WHEN p.p_size <= 25 THEN p.p_brand END AS smiles, p.p_type AS inchikey
           FROM compounds c LEFT JOIN folded f ON f.k = lower(c.name) LEFT JOIN part p ON p.p_partkey = f.cid""",
        _PARTS,
    )
)
def compound_properties(spark: SparkSession, d: str) -> DataFrame:
    compounds, *rest = _compounds(spark, d)
    return linking.link_compounds(compounds.withColumn("ontology_id", F.lit(None).cast("string")), *rest).select("p_partkey", "cid", "smiles", "inchikey")


@query(with_sql("SELECT c.p_partkey, c.ontology_id, f.cid FROM compounds c LEFT JOIN folded f ON c.ontology_id IS NULL AND f.k = lower(c.name)", _PARTS))
def skip_if_linked(spark: SparkSession, d: str) -> DataFrame:
    return linking.link_compounds(*_compounds(spark, d)).select("p_partkey", "ontology_id", "cid")


def _taxonomy(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    nation = table(spark, d, "nation")
    kind = F.when(F.col("n_regionkey") <= 2, "scientific name").otherwise("common name")
    names = nation.select(F.col("n_nationkey").alias("row_idx"), F.col("n_nationkey").alias("tax_id"), F.col("n_name").alias("name"), kind.alias("name_class")).unionByName(
        nation.select((F.col("n_nationkey") + 100).alias("row_idx"), (F.col("n_nationkey") + 100).alias("tax_id"), F.col("n_name").alias("name"), F.lit("scientific name").alias("name_class"))
    )
    nodes = names.select("tax_id", F.when(F.col("tax_id") < 110, "species").otherwise("Species").alias("rank")).where("tax_id <> 3")
    merged = nation.where("n_regionkey = 4").select(F.col("n_nationkey").alias("old_tax_id"), (F.col("n_nationkey") + 500).alias("new_tax_id"))
    return names, nodes, merged


_TAXONOMY = """names AS (
  SELECT n_nationkey AS row_idx, n_nationkey AS tax_id, n_name AS name, CASE WHEN n_regionkey <= 2 THEN 0 ELSE 1 END AS turn FROM nation
  UNION ALL SELECT n_nationkey + 100, n_nationkey + 100, n_name, 0 FROM nation),
best AS (SELECT name, arg_min(tax_id, (turn, row_idx)) AS tax_id FROM names WHERE tax_id <> 3 GROUP BY 1),
species AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN lower(n_name) ELSE n_name END AS name FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _species(spark: SparkSession, d: str) -> DataFrame:
    joined = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("name"))


@query(with_sql("SELECT c_custkey, s.name, b.tax_id AS taxonomy_id FROM species s LEFT JOIN best b ON s.name = b.name", _TAXONOMY))
def prioritised_lookup(spark: SparkSession, d: str) -> DataFrame:
    names, nodes, merged = _taxonomy(spark, d)
    return linking.link_species(_species(spark, d), names, nodes, merged.where("false")).select("c_custkey", "name", "taxonomy_id")


@query(
    with_sql(
        """SELECT c_custkey, CASE WHEN n.n_regionkey = 4 THEN b.tax_id + 500 ELSE b.tax_id END AS taxonomy_id
           FROM species s LEFT JOIN best b ON s.name = b.name LEFT JOIN nation n ON n.n_nationkey = b.tax_id""",
        _TAXONOMY,
    )
)
def id_redirect(spark: SparkSession, d: str) -> DataFrame:
    return linking.link_species(_species(spark, d), *_taxonomy(spark, d)).select("c_custkey", "taxonomy_id")


@query(
    """WITH s AS (
         SELECT DISTINCT c_nationkey AS doc_id, upper(substring(c_mktsegment, 1, 1)) || lower(substring(c_mktsegment, 2)) || ' ' || CASE WHEN c_acctbal > 5000 THEN 'rosea' ELSE 'alba' END AS name
         FROM customer WHERE c_acctbal > 2000
         UNION SELECT DISTINCT c_nationkey, substring(c_mktsegment, 1, 1) || '. rosea' FROM customer
         UNION SELECT DISTINCT c_nationkey, 'weed' FROM customer),
       f AS (SELECT doc_id, lower(substring(name, 1, 1) || '. ' || string_split(name, ' ')[2]) AS k, min(name) AS full_name FROM s WHERE regexp_full_match(name, '[A-Z][a-z]+ [a-z]+') GROUP BY ALL)
       SELECT s.doc_id, s.name, coalesce(f.full_name, s.name) AS lookup_name FROM s LEFT JOIN f ON s.doc_id = f.doc_id AND lower(s.name) = f.k"""
)
def abbrev_species_expand(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    full = c.where("c_acctbal > 2000").select(F.col("c_nationkey").alias("doc_id"), F.concat(F.initcap(F.lower("c_mktsegment")), F.lit(" "), F.when(F.col("c_acctbal") > 5000, "rosea").otherwise("alba")).alias("name"))
    short = c.select(F.col("c_nationkey").alias("doc_id"), F.concat(F.substring("c_mktsegment", 1, 1), F.lit(". rosea")).alias("name"))
    other = c.select(F.col("c_nationkey").alias("doc_id"), F.lit("weed").alias("name"))
    return linking.expand_binomials(full.unionByName(short).unionByName(other).distinct())


@query(
    """SELECT p_partkey, p_brand, CASE WHEN row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) = 1 THEN c.kingdom END AS kingdom
       FROM part LEFT JOIN (SELECT p_brand, max(p_type) AS kingdom FROM part WHERE p_size < 40 GROUP BY 1) c USING (p_brand)"""
)
def classify_first_only(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    classes = part.where("p_size < 40").groupBy("p_brand").agg(F.max("p_type").alias("kingdom"))
    return linking.attach_once(part.select("p_partkey", "p_brand"), classes, "p_brand", "p_partkey")


_TREE = "part_tree(tax_id, parent_tax_id) AS (SELECT p_partkey, greatest(p_partkey - 1 - (p_partkey * 7) % 40, CASE WHEN p_partkey % 500 = 0 THEN p_partkey ELSE 0 END) FROM part)"
_UP = f"{_TREE}, up(tax_id, ancestor, depth) AS (SELECT tax_id, parent_tax_id, 1 FROM part_tree WHERE parent_tax_id <> tax_id UNION ALL SELECT u.tax_id, n.parent_tax_id, depth + 1 FROM up u JOIN part_tree n ON n.tax_id = u.ancestor WHERE n.parent_tax_id <> n.tax_id)"


def part_tree(spark: SparkSession, d: str) -> DataFrame:
    """Parts as nodes of trees of more than sixty levels: some are their own parents, some have a parent that is no node."""
    up = F.expr("greatest(p_partkey - 1 - (p_partkey * 7) % 40, CASE WHEN p_partkey % 500 = 0 THEN p_partkey ELSE 0 END)")
    return table(spark, d, "part").select(F.col("p_partkey").alias("tax_id"), up.alias("parent_tax_id"))


@query(f"WITH RECURSIVE {_UP} SELECT tax_id, ancestor, CAST(depth AS BIGINT) AS depth FROM up")
def taxonomy_ancestors(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.ancestors(part_tree(spark, d))


@query(
    f"""WITH RECURSIVE {_UP}, real AS (SELECT * FROM up WHERE ancestor IN (SELECT tax_id FROM part_tree))
        SELECT p.tax_id, coalesce(r.root, p.tax_id) AS root, coalesce(r.depth, 0) AS depth, 1 + coalesce(b.below, 0) AS size
        FROM part_tree p LEFT JOIN (SELECT tax_id, CAST(max(depth) AS BIGINT) AS depth, arg_max(ancestor, depth) AS root FROM real GROUP BY 1) r USING (tax_id)
        LEFT JOIN (SELECT ancestor AS tax_id, count(*) AS below FROM real GROUP BY 1) b USING (tax_id)"""
)
def taxonomy_intervals(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.intervals(part_tree(spark, d)).select("tax_id", "root", "depth", "size")


@query()
def embed_terms(spark: SparkSession, d: str) -> DataFrame:
    ship(spark)
    return table(spark, d, "part").select("p_name").distinct().select("p_name", embedder(64)("p_name").alias("vec"))


_PIECE_SQL = "CAST(CAST('0x' || substr(md5({x}), 1, 8) AS BIGINT) % {n} AS INT)"


@query(
    f"""WITH listed AS (SELECT list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
       near AS (SELECT unnest(list_zip(w[1:len(w) - 1], w[2:])) AS p FROM listed WHERE len(w) > 1
                UNION ALL SELECT unnest(list_zip(w[1:len(w) - 2], w[3:])) FROM listed WHERE len(w) > 2),
       pairs AS (SELECT struct_extract(p, 1) AS a, struct_extract(p, 2) AS b, count(*) AS n FROM near GROUP BY 1, 2),
       by_word AS (SELECT a, {_PIECE_SQL.format(x="b", n=embedding.CONTEXTS)} AS context, sum(n) AS n
                   FROM (SELECT a, b, n FROM pairs UNION ALL SELECT b, a, n FROM pairs) GROUP BY 1, 2),
       pieces AS (SELECT a, unnest(list_distinct(list_transform(list_append(list_transform(range(1, length(a) + 1), lambda i: substring('<' || a || '>', i, 3)), '<' || a || '>'),
                                                                lambda x: {_PIECE_SQL.format(x="x", n=embedding.PIECES)}))) AS piece FROM (SELECT DISTINCT a FROM by_word)),
       counts AS (SELECT piece, context, sum(n) AS n FROM by_word JOIN pieces USING (a) GROUP BY 1, 2),
       valued AS (SELECT piece, context, n, ln(CAST(n AS DOUBLE) * sum(n) OVER () / (CAST(sum(n) OVER (PARTITION BY piece) AS DOUBLE) * sum(n) OVER (PARTITION BY context))) AS ppmi FROM counts)
       SELECT piece, count(*) AS n_contexts, CAST(sum(n) AS BIGINT) AS n, CAST(sum(context * CAST(round(ppmi * 1e6) AS BIGINT)) AS BIGINT) AS placed, CAST(sum(CAST(round(ppmi * 1e6) AS BIGINT)) AS BIGINT) AS millionths
       FROM valued WHERE ppmi > 0 GROUP BY piece"""
)
def subword_ppmi(spark: SparkSession, d: str) -> DataFrame:
    """The mutual information of each piece of a word with all that surrounds it, in millionths, summed plainly and by place."""
    counts = materialise(embedding.cooccurrence(table(spark, d, "documents")))
    found = embedding.mutual_information(counts).withColumn("m", F.round(F.col("ppmi") * 1e6).cast("long"))
    sums = [F.sum("n").alias("n"), F.sum(F.col("context") * F.col("m")).alias("placed"), F.sum("m").alias("millionths")]
    return found.groupBy("piece").agg(F.count("*").alias("n_contexts"), *sums)


@query()
def learned_vectors(spark: SparkSession, d: str) -> DataFrame:
    """The vectors of all word pieces of the documents, held against numpy's SVD in tests."""
    return embedding.learn_vectors(table(spark, d, "documents")).vectors


# ---------- relations ----------

_PREDICATE = f"CASE l_returnflag WHEN 'N' THEN '{NO_RELATION}' WHEN 'A' THEN 'made_in' ELSE 'present_in' END"
_ANSWER = f"CASE WHEN l_quantity < 20 THEN 'made_in' WHEN l_quantity < 35 THEN 'present_in' ELSE '{NO_RELATION}' END"


@query(f"SELECT l_orderkey, l_linenumber, {_PREDICATE} AS predicate, CASE WHEN l_returnflag = 'N' THEN 'none' ELSE 'relation' END AS side FROM lineitem")
def relation_split(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_PREDICATE).alias("predicate"))
    some, none = relations.route(rows)
    return some.withColumn("side", F.lit("relation")).unionByName(none.withColumn("side", F.lit("none")))


@query(
    """SELECT a.conv_id, a.turn, CASE WHEN contains(lower(b.text), lower(string_split(a.text, ' ')[1])) AND trim(string_split(a.text, ' ')[1]) <> '' THEN 'yes' ELSE 'no' END AS decision
       FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1"""
)
def self_eval_filter(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    after = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("context"))
    rows = c.withColumn("justification", F.get(F.split("text", " "), F.lit(0))).join(after, ["conv_id", "turn"])
    return relations.judge(rows).select("conv_id", "turn", "decision")


def _nested(spark: SparkSession, d: str) -> DataFrame:
    """Relations of parts (subjects) with suppliers (objects)."""
    rows = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    some = lambda when, value: F.when(F.expr(when), value)
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        F.struct(
            F.col("p_name").alias("name"), F.array("p_brand", "p_type").alias("alt_names"), some("p_size > 20", F.col("p_partkey")).alias("CID"), some("p_size < 10", F.col("p_type")).alias("ontology_id")
        ).alias("subject_entity"),
        F.expr(_PREDICATE).alias("predicate"),
        F.struct(
            F.col("s_name").alias("name"), F.array("s_name").alias("alt_names"), some("s_acctbal > 3000", F.concat(F.lit("PO:"), F.col("s_suppkey").cast("string"))).alias("ontology_id"),
            some("s_nationkey < 12", F.col("s_nationkey")).alias("taxonomy_id"),
        ).alias("object_entity"),
        F.when(F.col("l_linestatus") == "O", "species").otherwise("anatomical_structures").alias("category"),
        F.lit("because").alias("justification"),
        F.lit("text").alias("context"),
    )


_FLAT = f"""flat AS (
  SELECT l_orderkey, l_linenumber, p_name AS subject_name, p_brand || ';' || p_type AS subject_alt_names,
         coalesce(CASE WHEN p_size > 20 THEN CAST(p_partkey AS VARCHAR) END, CASE WHEN p_size < 10 THEN p_type END) AS subject_cid, {_PREDICATE} AS predicate, s_name AS object_name,
         s_name AS object_alt_names, coalesce(CASE WHEN s_acctbal > 3000 THEN 'PO:' || s_suppkey END, CASE WHEN s_nationkey < 12 THEN CAST(s_nationkey AS VARCHAR) END) AS object_ontology_id,
         CASE WHEN l_linestatus = 'O' THEN 'species' ELSE 'anatomical_structures' END AS category, 'because' AS justification, 'text' AS context
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""


@query(with_sql("SELECT * EXCLUDE (l_orderkey, l_linenumber) FROM flat", _FLAT))
def relation_flatten(spark: SparkSession, d: str) -> DataFrame:
    flat = relations.flatten(_nested(spark, d))
    return flat.withColumns({c: F.array_join(c, ";") for c in ("subject_alt_names", "object_alt_names")})


@query(with_sql("SELECT subject_name, subject_cid, predicate, object_name, object_ontology_id FROM flat WHERE subject_cid IS NOT NULL AND object_ontology_id IS NOT NULL", _FLAT))
def linked_only(spark: SparkSession, d: str) -> DataFrame:
    return relations.linked_only(relations.flatten(_nested(spark, d))).select("subject_name", "subject_cid", "predicate", "object_name", "object_ontology_id")


@query(
    with_sql(
        """SELECT 'PMC' || l_orderkey AS pmcid, subject_name, replace(subject_alt_names, ';', '; ') AS subject_alt_names, subject_cid AS subject_id, predicate, object_name, object_alt_names,
                  CASE WHEN object_ontology_id LIKE 'PO:%' THEN object_ontology_id END AS object_id, category, justification FROM flat""",
        _FLAT.replace("CASE WHEN p_size > 20 THEN", "CASE WHEN p_size > 20 AND p_partkey <> 0 THEN"),
    )
)
def relation_export(spark: SparkSession, d: str) -> DataFrame:
    return relations.export(_nested(spark, d).withColumn("pmcid", F.concat(F.lit("PMC"), F.col("l_orderkey").cast("string"))))


@query(with_sql("SELECT subject_name, md5(string_agg(predicate || ' ' || object_name, ';' ORDER BY predicate || ' ' || object_name)) AS relations_md5, count(*) AS n FROM flat GROUP BY 1", _FLAT))
def relations_by_subject(spark: SparkSession, d: str) -> DataFrame:
    out = relations.by_subject(relations.flatten(_nested(spark, d)))
    return out.select("subject_name", F.md5(F.array_join("relations", ";").cast("binary")).alias("relations_md5"), F.size("relations").cast("long").alias("n"))


@query(
    with_sql(
        """SELECT coalesce(a.subject, b.subject) AS subject, coalesce(a.predicate, b.predicate) AS predicate, coalesce(a.object, b.object) AS object,
                  CASE WHEN a.subject IS NULL THEN 'second' WHEN b.subject IS NULL THEN 'first' ELSE 'both' END AS side
           FROM (SELECT * FROM t WHERE category = 'species') a FULL JOIN (SELECT * FROM t WHERE category <> 'species') b USING (subject, predicate, object)""",
        _FLAT,
        "t AS (SELECT DISTINCT coalesce(subject_cid, 'Unknown subject') AS subject, predicate, coalesce(object_ontology_id, 'Unknown object') AS object, category FROM flat)",
    )
)
def triple_set_diff(spark: SparkSession, d: str) -> DataFrame:
    flat = relations.flatten(_nested(spark, d)).select(F.col("subject_cid").alias("subject_name"), "predicate", F.col("object_ontology_id").alias("object_name"), "category")
    cores, rows = spark.sparkContext.defaultParallelism, table(spark, d, "lineitem").count()
    return relations.compare_triples(flat, F.col("category") == "species", max(cores, -(-rows // 250_000)))  # rows of a task


_GUIDELINES = ", ".join(f"({quoted(c)}, {quoted(p)}, {quoted(DEFINITIONS[p])})" for c, ps in PREDICATES.items() if c not in NOT_GUIDED for p in ps)


@query(
    with_sql(
        f"""SELECT l_orderkey, l_linenumber, f.category, f.predicate, coalesce(g.definition, {quoted(NO_DEFINITION)}) AS definition
            FROM flat f LEFT JOIN (VALUES {_GUIDELINES}) g(category, predicate, definition) ON f.category = g.category AND f.predicate = g.predicate""",
        _FLAT,
    )
)
def guideline_lookup(spark: SparkSession, d: str) -> DataFrame:
    rows = _nested(spark, d).select("l_orderkey", "l_linenumber", "category", "predicate")
    return relations.with_definitions(rows, predicate_guidelines(spark))


# ---------- evaluation ----------


def _outcomes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(F.expr(_PREDICATE).alias("actual"), F.expr(_ANSWER).alias("predicted"))


_METRICS = f"""o AS (SELECT {_PREDICATE} AS actual, {_ANSWER} AS predicted FROM lineitem),
labels_ AS (SELECT actual AS label FROM o UNION SELECT predicted FROM o),
m AS (SELECT label, (SELECT count(*) FROM o WHERE actual = label AND predicted = label) AS tp, (SELECT count(*) FROM o WHERE predicted = label) AS named,
             (SELECT count(*) FROM o WHERE actual = label) AS support, (SELECT count(*) FROM o) AS total FROM labels_),
c AS (SELECT label, tp, named - tp AS fp, support - tp AS fn, total - named - support + tp AS tn, CASE WHEN named > 0 THEN tp / named ELSE 0 END AS precision,
             CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall, support FROM m),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM c)"""


@query(with_sql("SELECT a.label AS actual, b.label AS predicted, (SELECT count(*) FROM o WHERE o.actual = a.label AND o.predicted = b.label) AS n FROM labels_ a, labels_ b", _METRICS))
def re_confusion(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.confusion(_outcomes(spark, d))


@query(
    with_sql(
        "SELECT label, tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f", _METRICS
    )
)
def re_class_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = evaluation.class_metrics(evaluation.confusion(_outcomes(spark, d)))
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(
    with_sql(
        """SELECT row, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM (
             SELECT label AS row, precision, recall, f1, support FROM f
             UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM f
             UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
             UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM f)""",
        _METRICS,
    )
)
def classification_report(spark: SparkSession, d: str) -> DataFrame:
    out = evaluation.report(evaluation.class_metrics(evaluation.confusion(_outcomes(spark, d))))
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


def _gold(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, d, "part")
    gold = part.select(
        F.col("p_partkey").alias("gold_id"), F.concat(F.lit("PMC"), F.col("p_size").cast("string")).alias("pmcid"), F.col("p_brand").alias("subject"), F.col("p_name").alias("object"),
        F.when(F.col("p_size") < 40, F.concat("p_type", F.lit("; "), F.element_at(F.split("p_name", " "), -1))).alias("alt_names"), F.col("p_type").alias("actual"),
    )
    predicted = part.where("p_size < 45").select(
        F.col("p_partkey").alias("row_idx"), F.concat(F.lit("PMC"), (F.col("p_size") + 2).cast("string")).alias("pmcid"), F.col("p_brand").alias("subject"),
        F.when(F.col("p_retailprice") > 1000, F.element_at(F.split("p_name", " "), -1)).otherwise(F.col("p_name")).alias("object"), F.col("p_type").alias("predicate"),
    )
    return gold, predicted


_GOLD = """gold AS (SELECT p_partkey AS gold_id, 'PMC' || p_size AS pmcid, p_brand AS subject, p_name AS object,
                   CASE WHEN p_size < 40 THEN p_type || '; ' || string_split(p_name, ' ')[-1] END AS alt_names, p_type AS actual FROM part),
guess AS (SELECT p_partkey AS row_idx, 'PMC' || (p_size + 2) AS pmcid, p_brand AS subject, CASE WHEN p_retailprice > 1000 THEN string_split(p_name, ' ')[-1] ELSE p_name END AS object, p_type AS predicate
          FROM part WHERE p_size < 45),
final AS (SELECT pmcid, subject, object, arg_max(predicate, row_idx) AS predicate FROM guess GROUP BY ALL)"""


@query(
    with_sql(
        f"""SELECT gold_id, actual, coalesce((SELECT arg_min(final.predicate, t.turn) FROM final JOIN (
                SELECT 0 AS turn, g.object AS name UNION ALL SELECT i, trim(string_split(g.alt_names, ';')[i]) FROM range(1, 3) r(i)) t ON t.name = final.object
              WHERE final.pmcid = g.pmcid AND final.subject = g.subject), '{NO_RELATION}') AS predicted FROM gold g""",
        _GOLD,
    )
)
def gold_match_alt_names(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.match_gold(*_gold(spark, d)).select("gold_id", "actual", "predicted")


@query(
    with_sql(
        """SELECT pmcid, subject, object, predicate AS predicted FROM final f
           WHERE pmcid IN (SELECT pmcid FROM gold) AND NOT EXISTS (
             SELECT 1 FROM gold g WHERE g.pmcid = f.pmcid AND g.subject = f.subject
               AND (f.object = g.object OR list_contains(list_transform(string_split(coalesce(g.alt_names, ''), ';'), lambda x: trim(x)), f.object)))""",
        _GOLD,
    )
)
def fp_existence(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.invented(*_gold(spark, d))


# ---------- loading ----------

_LINE = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query(f"SELECT l_orderkey, {_LINE} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE}) AS rn FROM lineitem) WHERE rn = 1")
def insert_or_ignore(spark: SparkSession, d: str) -> DataFrame:
    columns = _LINE.split(", ")
    return linking.first_by(table(spark, d, "lineitem").select("l_orderkey", *columns), "l_orderkey", *columns)


@query("SELECT 'orders' AS tbl, count(*) AS n_stored, count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer)) AS n_unknown FROM orders")
def integrity_check(spark: SparkSession, d: str) -> DataFrame:
    stored = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return loading.integrity("orders", stored, table(spark, d, "customer").select("c_custkey"), ["c_custkey"])


@query("SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY ALL")
def annotation_dedup_last(spark: SparkSession, d: str) -> DataFrame:
    return annotations.keep_last(table(spark, d, "events").select("user_id", "event_type", "event_id", "value"), ["user_id", "event_type"], "event_id")
