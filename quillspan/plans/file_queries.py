"""Tables written as files of the kinds that are read and written, and read back; answers of services.  Each beside its SQL."""

from __future__ import annotations

import io
import json
import tarfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import embedder
from ..operators import evaluation, linking, loading, passages, providers
from ..schemas import NO_RELATION
from ..session import shared_dir, ship
from ..sources import articles, dumps, fetch, gold, ontologies, sinks, stages
from ..streaming.ingest import ingest
from . import build
from .inputs import quoted, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"


def _lines(rows: DataFrame, line: Column, path: str, **options: str) -> str:
    rows.select(line.alias("value")).write.options(**options).text(path)
    return path


# ---------- articles ----------

_ROLES = {"en": "Intro", "de": "ref", "es": "RESULTS"}  # sections by language; the others have none
_STRIP = r"^\s+|\s+$"


def _articles(spark: SparkSession, d: str) -> str:
    """A collection of articles in XML for each task: every document is an article of one passage."""

    def infon(value: Column, key: str) -> Column:
        return F.struct(value.alias("_VALUE"), F.lit(key).alias("_key"))

    section = F.create_map(*[F.lit(x) for pair in _ROLES.items() for x in pair])[F.col("lang")]
    kind = F.when(F.col("n_chars") > 3000, "table").otherwise("paragraph")
    annotation = F.struct(F.array(infon(F.lit("Chemical"), "type")).alias("infon"), F.col("source").alias("text"))
    passage = F.struct(
        F.filter(F.array(infon(section, "section_type"), infon(kind, "type")), lambda x: x["_VALUE"].isNotNull()).alias("infon"),
        F.lit(7).alias("offset"), F.regexp_replace("text", _STRIP, "").alias("text"), F.array(annotation).alias("annotation"),
    )
    path = _folder(spark)
    rows = table(spark, d, "documents").where("text IS NOT NULL").select(F.col("doc_id").cast("string").alias("id"), F.array(passage).alias("passage"))
    rows.write.format("xml").option("rootTag", "collection").option("rowTag", "document").save(path)
    return path


_PASSAGES = rf"""(SELECT CAST(doc_id AS VARCHAR) AS doc_id, source, regexp_replace(text, '{_STRIP}', '', 'g') AS text FROM documents
   WHERE text IS NOT NULL AND lang IS DISTINCT FROM 'de' AND NOT coalesce(n_chars > 3000, false)) AS p WHERE text <> ''"""


@query(f"SELECT doc_id, 0 AS passage_idx, 7 AS u_start, CAST(7 + length(text) AS INT) AS u_end, md5(text) AS text_md5 FROM {_PASSAGES}")
def article_scan(spark: SparkSession, d: str) -> DataFrame:
    """Articles in XML; passages of other sections and types are left out."""
    read = passages.select_passages(articles.read_articles(spark, _articles(spark, d)))
    return read.select("doc_id", "passage_idx", "u_start", "u_end", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(f"SELECT doc_id, 0 AS entity_idx, 'compounds' AS entity_type, source AS name FROM {_PASSAGES}")
def article_annotations(spark: SparkSession, d: str) -> DataFrame:
    read = passages.select_passages(articles.read_articles(spark, _articles(spark, d)))
    return passages.pre_annotations(read).select("doc_id", "entity_idx", "entity_type", "name")


@query(f"SELECT doc_id, md5(text) AS text_md5 FROM {_PASSAGES}")
def ingest_once(spark: SparkSession, d: str) -> DataFrame:
    """The same files as a stream, taken in twice: the second time nothing is new."""
    source, out = _articles(spark, d), _folder(spark)
    for run in range(2):
        ingest(spark, source, f"{out}/out", f"{out}/progress{run}", passages.select_passages).awaitTermination()
    return spark.read.parquet(f"{out}/out/rows").select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))


# ---------- stage files ----------

_TYPES = {"AUTOMOBILE": "compounds", "BUILDING": "genes", "FURNITURE": "species", "MACHINERY": "pathways", "HOUSEHOLD": "plant_traits"}
_TYPE_SQL = "CASE c_mktsegment " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in _TYPES.items()) + " END"


@query(
    f"""SELECT 'PMC' || c_nationkey AS doc_id, {_TYPE_SQL} AS entity_type, c_name AS name, c_custkey AS CID, CAST(c_custkey + 1 AS INT) AS span_end, c_acctbal AS score
        FROM customer WHERE {_TYPE_SQL} IS NOT NULL"""
)
def entity_files(spark: SparkSession, d: str) -> DataFrame:
    """Entities nested by document, a JSON file for each, and read back."""
    kind = F.create_map(*[F.lit(x) for pair in _TYPES.items() for x in pair])[F.col("c_mktsegment")]
    rows = table(spark, d, "customer").select(
        F.concat(F.lit("PMC"), "c_nationkey").alias("doc_id"), kind.alias("entity_type"), F.col("c_name").alias("name"),
        F.array(F.array(F.col("c_custkey").cast("int"), (F.col("c_custkey") + 1).cast("int"))).alias("spans"), F.col("c_acctbal").alias("score"), F.col("c_custkey").alias("CID"),
    )
    path = _folder(spark)
    sinks.write_json(stages.nest_entities(rows.where("entity_type IS NOT NULL"), "doc_id"), path)
    read, _ = stages.read_document_entities(spark, path)
    return read.select("doc_id", "entity_type", "name", "CID", F.col("spans")[0][1].alias("span_end"), "score")


_RELATIONS = "SELECT 'PMC' || s_nationkey AS pmcid, s_name AS subject, CASE WHEN s_acctbal > 0 THEN 'made_in' ELSE 'affects' END AS predicate FROM supplier"


def _supplier_relations(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(
        F.concat(F.lit("PMC"), "s_nationkey").alias("doc_id"), F.struct(F.col("s_name").alias("name")).alias("subject_entity"), F.when(F.col("s_acctbal") > 0, "made_in").otherwise("affects").alias("predicate")
    )


@query(_RELATIONS)
def relation_files(spark: SparkSession, d: str) -> DataFrame:
    path = _folder(spark)
    sinks.write_json(stages.nest_relations(_supplier_relations(spark, d)), path)
    read, _ = stages.read_relations(spark, path)
    return read.select("pmcid", F.col("subject_entity.name").alias("subject"), "predicate")


@query(_RELATIONS)
def routed_relations(spark: SparkSession, d: str) -> DataFrame:
    """Relations in a folder for each predicate."""
    path = _folder(spark)
    sinks.write_routed(_supplier_relations(spark, d), path, "predicate")
    return spark.read.json(path).select(F.col("doc_id").alias("pmcid"), F.col("subject_entity.name").alias("subject"), "predicate")


# ---------- reference data ----------

_LARGE = 40  # parts of a greater size are obsolete terms


def _terms(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(
        F.lit("[Term]\nid: P:"), F.col("p_partkey").cast("string"), F.lit("\nname: "), F.col("p_name"), F.lit("\nnamespace: "), F.col("p_brand"), F.lit('\nsynonym: "'), F.col("p_type"),
        F.lit(' (INN)" EXACT []\nis_a: P:'), F.col("p_size").cast("string"), F.lit(" ! parent"), F.when(F.col("p_size") > _LARGE, "\nis_obsolete: true").otherwise(""), F.lit("\n"),
    )
    return ontologies.read_obo(spark, _lines(table(spark, d, "part"), line, _folder(spark)))


@query(f"SELECT 'P:' || p_partkey AS id, trim(p_name) AS name, p_brand AS namespace FROM part WHERE p_size <= {_LARGE}")
def obo_terms(spark: SparkSession, d: str) -> DataFrame:
    return ontologies.annotatable(_terms(spark, d)).select("id", "name", "namespace")


@query("SELECT 'P:' || p_partkey AS child, 'is_a' AS rel, 'P:' || p_size AS parent FROM part")
def obo_edges(spark: SparkSession, d: str) -> DataFrame:
    return ontologies.edges(_terms(spark, d))


@query(
    f"""SELECT id, surface, canonical_name, row_number() OVER (ORDER BY id, surface) - 1 AS row_idx, true AS unit_length FROM (
          SELECT DISTINCT 'P:' || p_partkey AS id, unnest([trim(p_name), p_type]) AS surface, trim(p_name) AS canonical_name FROM part WHERE p_size <= {_LARGE})"""
)
def vector_cache(spark: SparkSession, d: str) -> DataFrame:
    """Vectors of every surface form, written and loaded."""
    path = _folder(spark)
    build.build_vectors(spark, path, "parts", ontologies.annotatable(_terms(spark, d)), embedder())
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    return build.load_reference(spark, path, vectors=path).terms.select("id", "surface", "canonical_name", "row_idx", (F.abs(length - 1) < 0.001).alias("unit_length"))


@query("SELECT 'P' || p_partkey AS id, p_name || ' & ' || p_brand AS name FROM part")
def pathway_scan(spark: SparkSession, d: str) -> DataFrame:
    """Names with tags and entities, tab, id, under a header."""
    rows = table(spark, d, "part").select(F.concat(F.lit("<i>"), "p_name", F.lit("</i> &amp; "), "p_brand").alias("name"), F.concat(F.lit("P"), "p_partkey").alias("id"))
    path = _folder(spark)
    rows.write.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    ship(spark)
    return ontologies.read_pathways(spark, path)


@query(
    """SELECT o_custkey AS cid, arg_min(o_orderstatus || o_orderkey, o_orderkey) AS smiles, arg_min('K' || o_orderkey, o_orderkey) AS inchikey, count(*) AS n_synonyms
       FROM orders GROUP BY 1"""
)
def compound_dumps(spark: SparkSession, d: str) -> DataFrame:
    """Gzipped dumps built into tables once: of each compound the first row counts, and a second build changes nothing."""
    orders = table(spark, d, "orders").repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey")
    path = _folder(spark)
    key = F.col("o_orderkey").cast("string")
    columns = {"smiles": [F.concat("o_orderstatus", key)], "inchikeys": [F.lit("inchi"), F.concat(F.lit("K"), key)], "synonyms": [key]}
    paths = {name: _lines(orders, F.concat_ws("\t", F.col("o_custkey").cast("string"), *values), f"{path}/dump-{name}", compression="gzip") for name, values in columns.items()}
    build.build_reference(spark, f"{path}/ref", **paths)
    build.build_reference(spark, f"{path}/ref", **dict(paths, smiles=paths["synonyms"]))
    ref = build.load_reference(spark, f"{path}/ref")
    counts = ref.synonyms.groupBy("cid").agg(F.count("*").alias("n_synonyms"))
    return ref.smiles.join(ref.inchikeys, "cid").join(counts, "cid").select("cid", "smiles", "inchikey", "n_synonyms")


@query(
    """SELECT reason, line, count(*) AS n FROM (
         SELECT CASE WHEN o_orderkey % 5 = 1 OR o_orderkey % 5 = 2 OR o_orderkey % 5 = 4 THEN 'malformed' ELSE 'no synonym' END AS reason,
                CASE o_orderkey % 5 WHEN 1 THEN o_orderstatus WHEN 2 THEN 'C' || o_custkey || chr(9) || o_orderpriority
                  WHEN 4 THEN o_custkey || chr(9) || o_orderstatus || chr(9) || 'more' ELSE o_custkey || chr(9) END AS line
         FROM orders WHERE o_orderkey % 5 <> 0) GROUP BY ALL"""
)
def rejected_dump_rows(spark: SparkSession, d: str) -> DataFrame:
    """A dump in which most rows have too few or too many columns, no number or no name: none goes unseen."""
    orders = table(spark, d, "orders")
    key = F.col("o_custkey").cast("string")
    rest = F.col("o_orderkey") % 5
    bad = F.when(rest == 1, F.col("o_orderstatus")).when(rest == 2, F.concat(F.lit("C"), key, F.lit("\t"), "o_orderpriority")).when(rest == 4, F.concat(key, F.lit("\t"), "o_orderstatus", F.lit("\tmore")))
    line = F.coalesce(bad, F.concat(key, F.lit("\t"), F.when(rest == 0, F.col("o_orderpriority")).otherwise("")))
    path = _lines(orders, line, f"{_folder(spark)}/synonyms", compression="gzip")
    return dumps.rejected_rows(spark, path, "synonyms").groupBy("reason", "line").agg(F.count("*").alias("n"))


@query(
    """SELECT CAST(100 + n_nationkey AS INT) AS tax_id, upper(n_name) AS name, CAST(500 + n_nationkey AS INT) AS old_tax_id, CAST(a AS INT) AS ancestor, CAST(depth AS INT) AS depth
       FROM (SELECT *, unnest([10 + n_regionkey, 1]) AS a, unnest([1, 2]) AS depth FROM nation)"""
)
def taxonomy_archive(spark: SparkSession, d: str) -> DataFrame:
    """A tar.gz of nodes, names and merged ids: nations under regions under a root; two tables of fixed size."""
    nations = table(spark, d, "nation").collect()
    regions = [r["r_regionkey"] for r in table(spark, d, "region").collect()]
    nodes = [(1, 1, "no rank"), *((10 + r, 1, "family") for r in regions), *((100 + n["n_nationkey"], 10 + n["n_regionkey"], "species") for n in nations)]
    names = [(100 + n["n_nationkey"], n["n_name"].upper(), "", "scientific name") for n in nations]
    merged = [(500 + n["n_nationkey"], 100 + n["n_nationkey"]) for n in nations]
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w:gz") as tar:
        for member, rows in (("nodes", nodes), ("names", names), ("merged", merged), ("division", [])):
            text = "".join("\t|\t".join(map(str, row)) + "\t|\n" for row in rows).encode()
            info = tarfile.TarInfo(f"./{member}.dmp")
            info.size = len(text)
            tar.addfile(info, io.BytesIO(text))
    path = f"{_folder(spark)}/taxdump.tar.gz"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
    out.write(bytearray(raw.getvalue()))
    out.close()
    taxonomy = dumps.read_taxonomy(spark, path)
    old = taxonomy["merged"].withColumnRenamed("new_tax_id", "tax_id")
    up = dumps.lineage(taxonomy["nodes"])
    return taxonomy["names"].select("tax_id", "name").join(old, "tax_id").join(up, "tax_id").select("tax_id", "name", "old_tax_id", "ancestor", "depth")


# ---------- sheets and reports ----------


@query(
    """SELECT event_type AS entity_type, lower(props) AS name, CAST(event_id AS INT) AS s, CAST(user_id AS INT) AS e FROM events WHERE event_type <> 'error'"""
)
def gold_entity_sheet(spark: SparkSession, d: str) -> DataFrame:
    """A sheet in which the places of some rows are no numbers."""
    start = F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).otherwise("n/a")
    path = _folder(spark)
    sinks.write_sheet(table(spark, d, "events").select(F.col("event_type").alias("entity type"), F.col("props").alias("entity"), start.alias("start"), F.col("user_id").alias("end")), path)
    return gold.read_gold_entities(spark, path)


@query(
    f"""SELECT 'PMC' || c_nationkey AS pmcid, c_name AS subject, c_mktsegment AS object, c_mktsegment || '; "' || c_name || '"' AS alt_names,
          CASE WHEN c_acctbal > 5000 THEN 'made_in' ELSE '{NO_RELATION}' END AS actual FROM customer"""
)
def gold_relation_sheet(spark: SparkSession, d: str) -> DataFrame:
    """A sheet with lists, quotes and empty relations."""
    rows = table(spark, d, "customer").select(
        F.concat(F.lit("PMC"), "c_nationkey").alias("PMCID"), F.col("c_name").alias("Subject_name"), F.col("c_mktsegment").alias("Object_name"),
        F.array("c_mktsegment", F.concat(F.lit('"'), "c_name", F.lit('"'))).alias("Object alt names"),
        F.when(F.col("c_acctbal") > 5000, " made_in ").when(F.col("c_acctbal") > 0, "  ").alias("Actual Relation"),
    )
    path = _folder(spark)
    sinks.write_sheet(rows, path)
    return gold.read_gold_relations(spark, path).drop("gold_id")


@query(
    """SELECT p_type || ' ' || CASE WHEN bool_or(g) AND bool_or(p) THEN 'TP' WHEN bool_or(p) THEN 'FP' ELSE 'FN' END || ' ' || p_type || ' | ' || p_name AS line
       FROM (SELECT p_type, p_name, p_size <= 30 AS g, p_size >= 20 AS p FROM part) GROUP BY p_type, p_name"""
)
def report_lines(spark: SparkSession, d: str) -> DataFrame:
    """A text report of names found, missed and invented by type."""
    part = table(spark, d, "part")
    path = _folder(spark)
    sinks.write_report(evaluation.match_sets(part.where("p_size <= 30"), part.where("p_size >= 20"), ["p_type", "p_name"]), path, "p_type", ["p_type", "p_name"])
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("SELECT 'orders' AS tbl, least(count(*), 5) AS n_stored, CAST(0 AS BIGINT) AS n_unknown FROM orders")
def integrity_sample(spark: SparkSession, d: str) -> DataFrame:
    """Five stored rows at random, looked up in their source."""
    orders = table(spark, d, "orders")
    return loading.integrity("orders", orders.select("o_orderkey", "o_custkey"), orders, ["o_orderkey", "o_custkey"], sample=5)


# ---------- services ----------


@query("SELECT page_id, replace(url_encode(url), '%2F', '/') AS address FROM pages")
def address_quote(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", fetch.quoted(F.col("url")).alias("address"))


@query("SELECT DISTINCT l_shipdate AS asked, l_returnflag || l_linestatus AS key, lower(l_returnflag || l_linestatus) AS answer FROM (SELECT 1 AS l_shipdate, l_returnflag, l_linestatus FROM lineitem)")
def lookup_answers(spark: SparkSession, d: str) -> DataFrame:
    """A service that is asked once about each distinct key, again when it is busy."""
    keys = table(spark, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("key"))
    asked: list[list] = []

    def call(values: list) -> list[dict]:
        asked.append(values)
        if len(asked) == 1:
            raise providers.Busy("0.01s")
        return [{"key": v, "answer": v.lower()} for v in values]

    ship(spark)
    answers = providers.lookup(keys, "key", providers.with_retries(call), "key string, answer string", batch=2, at_once=2)
    return answers.groupBy("key", "answer").agg(F.count("*").cast("int").alias("asked")).select("asked", "key", "answer")


@query("SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS kind FROM customer")
def checked_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers of a model: a prompt that never gets one that fits has none."""

    def generate(prompts: list[str]) -> list[str]:
        return [json.dumps({"kind": p} if not p.startswith("-") else {"other": p}) for p in prompts]

    ship(spark)
    rows = table(spark, d, "customer")
    prompt = F.concat(F.when(F.col("c_acctbal") < 0, "-").otherwise(""), "c_mktsegment")
    return providers.answer(rows, prompt, generate, "kind string").select("c_custkey", F.col("answer.kind").alias("kind"))


_CUE_SQL = " ".join(f"WHEN contains(lower(text), {quoted(cue)}) THEN {quoted(name)}" for cue, name in providers.CUES)


@query(f"SELECT conv_id, turn, CASE {_CUE_SQL} ELSE '{NO_RELATION}' END AS predicate FROM conversations")
def cue_predicates(spark: SparkSession, d: str) -> DataFrame:
    """The stand-in for a relation model: the first phrase that gives a relation away."""
    return providers.cue_predictor()(table(spark, d, "conversations").withColumnRenamed("text", "context")).select("conv_id", "turn", "predicate")


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN l_returnflag || '1' END AS np_class, CASE WHEN l_linestatus = 'O' THEN l_returnflag || '2' END AS np_superclass
       FROM lineitem"""
)
def natural_product_classes(spark: SparkSession, d: str) -> DataFrame:
    """Classes of compounds that no ontology has, each formula asked once."""
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.lit("compounds").alias("entity_type"), F.when(F.col("l_linestatus") != "O", "X:1").alias("ontology_id"), F.col("l_returnflag").alias("SMILES")
    )
    classes = lambda keys: keys.withColumns({"Np_class": F.array(F.concat("SMILES", F.lit("1"))), "Np_superclass": F.array(F.concat("SMILES", F.lit("2")))})
    found = linking.natural_products(rows, classes)
    return found.select("l_orderkey", "l_linenumber", F.get("Natural_product_class.Np_class", F.lit(0)).alias("np_class"), F.get("Natural_product_class.Np_superclass", F.lit(0)).alias("np_superclass"))
