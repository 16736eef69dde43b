"""Articles to evaluated relations, stage by stage; each stage's table is written once for each document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import abbreviations, linking, loading, mentions, merging, passages, providers, ranking, relations
from ..schemas import entity_policy
from ..session import materialise, ship


@dataclass
class Reference:
    """What entities are linked to; any part may be missing."""

    terms: DataFrame | None = None  # ontology, row_idx, id, canonical_name, namespace, vec
    synonyms: DataFrame | None = None
    smiles: DataFrame | None = None
    inchikeys: DataFrame | None = None
    names: DataFrame | None = None
    nodes: DataFrame | None = None
    merged: DataFrame | None = None


@dataclass
class Providers:
    extractor: providers.Extractor
    predictor: providers.RelationPredictor
    judge: providers.RelationJudge
    embedder: providers.Embedder
    classifier: providers.CompoundClassifier | None = None  # InChIKey and SMILES to ClassyFire classes
    np_classifier: providers.CompoundClassifier | None = None  # SMILES to natural product classes


def link_ontologies(located: DataFrame, terms: DataFrame, embed: providers.Embedder) -> DataFrame:
    """located with ontology_id, normalized_name and score of the nearest term above the type's threshold."""
    spark = located.sparkSession
    policy = F.broadcast(entity_policy(spark).where("ontology IS NOT NULL"))  # nine rows
    names = located.select("entity_type", "name").distinct().join(policy.select("entity_type", "ontology", "threshold", "namespace"), "entity_type")
    names = names.withColumns({"entity_id": F.xxhash64("entity_type", "name"), "space": F.concat_ws("|", "ontology", F.coalesce("namespace", F.lit("")))})
    names = names.withColumn("vec", embed(F.col("name")))
    limits = policy.select("ontology", F.col("namespace").alias("wanted")).distinct()
    spaced = terms.join(limits, "ontology").where(F.col("wanted").isNull() | (F.col("wanted") == F.col("namespace")))
    spaced = spaced.withColumn("space", F.concat_ws("|", "ontology", F.coalesce("wanted", F.lit("")))).withColumn("not_for", F.lit(None).cast("long"))
    found = linking.nearest_terms(names.select("entity_id", "space", "vec"), spaced.select("row_idx", "space", "vec", "not_for"))
    linked = names.join(found, ["entity_id", "space"]).where(F.col("score") > F.col("threshold"))
    linked = linked.join(terms.select("ontology", "row_idx", F.col("id").alias("ontology_id"), F.col("canonical_name").alias("normalized_name")), ["ontology", "row_idx"])
    return located.join(linked.select("entity_type", "name", "ontology_id", "normalized_name", "score"), ["entity_type", "name"], "left")


def link_all(located: DataFrame, ref: Reference, embed: providers.Embedder) -> DataFrame:
    """Ontologies first; compounds without a term then go by the compound tables, species by the taxonomy."""
    none = {"ontology_id": "string", "normalized_name": "string", "score": "double"}
    out = link_ontologies(located, ref.terms, embed) if ref.terms is not None else located.withColumns({c: F.lit(None).cast(t) for c, t in none.items()})
    compounds, species = out.where("entity_type = 'compounds'"), out.where("entity_type = 'species'")
    rest = out.where("entity_type NOT IN ('compounds', 'species')")
    if ref.synonyms is not None:
        compounds = linking.link_compounds(compounds, ref.synonyms, ref.smiles, ref.inchikeys)
        compounds = compounds.withColumnsRenamed({"cid": "CID", "smiles": "SMILES", "inchikey": "InChIKey"})
    if ref.names is not None:
        species = linking.expand_binomials(species).withColumnRenamed("name", "own").withColumnRenamed("lookup_name", "name")
        species = linking.link_species(species, ref.names, ref.nodes, ref.merged).drop("name").withColumnRenamed("own", "name")
    wide = compounds.unionByName(species, allowMissingColumns=True).unionByName(rest, allowMissingColumns=True)
    for column, kind in {"CID": "long", "SMILES": "string", "InChIKey": "string", "taxonomy_id": "int"}.items():
        if column not in wide.columns:
            wide = wide.withColumn(column, F.lit(None).cast(kind))
    return wide


def document_entities(read: DataFrame, given: Providers, ref: Reference) -> DataFrame:
    """Selected passages to the entities of each document."""
    extracted = passages.override(given.extractor(read), passages.pre_annotations(read)) if "annotation" in read.columns else given.extractor(read)
    located = materialise(mentions.drop_unfound(mentions.locate(extracted, read)))
    linked = link_all(located, ref, given.embedder)
    if given.classifier is not None:
        linked = linking.classify_compounds(linked, given.classifier, "doc_id", "passage_idx", "entity_idx")
    if given.np_classifier is not None:
        linked = linking.natural_products(linked, given.np_classifier)
    merged = merging.merge_duplicates(linked)
    return merging.merge_abbreviations(merged.drop("merge_key"), abbreviations.detect(read.withColumn("passage_idx", F.col("passage_idx").cast("int"))))


def contexts(read: DataFrame, entities: DataFrame) -> DataFrame:
    """The context of each pair of a document's entities."""
    units = read.select("doc_id", F.col("passage_idx").alias("unit_idx"), "u_start", (F.col("u_start") + F.char_length("text")).cast("int").alias("u_end"), "text")
    cut = passages.split_sentences(read)
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("passage_idx", "sent_idx")) - 1
    lines = cut.select("doc_id", number.cast("int").alias("unit_idx"), "u_start", "u_end", "text")
    spans = entities.select("doc_id", "entity_type", "name", F.explode("spans").alias("x")).select("doc_id", "entity_type", "name", "x.s", "x.e")
    weigh = lambda u: ranking.inverse_frequency(ranking.unit_counts(spans, u), u)
    top = materialise(ranking.top_units(ranking.passage_scores(ranking.pair_units(ranking.sentence_indices(weigh(units), units))), 2))
    best = materialise(ranking.best_sentences(top, weigh(lines), 2))
    return ranking.assemble(top, best, lines.withColumnRenamed("unit_idx", "sent_idx"), units)


def run(spark: SparkSession, articles: DataFrame, folder: str, given: Providers, ref: Reference | None = None) -> DataFrame:
    """Articles (as read) to judged relations, also written under folder: entities, relations.

    Documents that are in a table already are not done again, so a run that broke off goes on where it was.
    """
    ship(spark)
    read = passages.select_passages(articles)
    entities = _resumed(spark, f"{folder}/entities", read, lambda todo: document_entities(todo, given, ref or Reference()))

    def relate(todo: DataFrame) -> DataFrame:
        own = entities.join(todo.select("doc_id").distinct(), "doc_id", "left_semi")
        return given.judge(given.predictor(contexts(todo, own)))

    out = _resumed(spark, f"{folder}/relations", read, relate)
    some, _ = relations.route(out)
    return some


def _resumed(spark: SparkSession, path: str, read: DataFrame, make) -> DataFrame:
    """The table at path, after what is missing has been added.

    Each run writes a part of its own and then, beside the table, which documents it has done.  A run that broke
    off in between has no such note: the next one has its number and writes over its part.
    """
    try:
        done = spark.read.parquet(f"{path}.done")
        number = done.agg(F.max("run")).first()[0] + 1
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        done, number = None, 0
    new = materialise(read if done is None else loading.pending(read, done))
    if not new.isEmpty():
        make(new).write.mode("overwrite").parquet(f"{path}/run={number}")
        new.select("doc_id").distinct().write.mode("overwrite").parquet(f"{path}.done/run={number}")
    return spark.read.parquet(path).drop("run")
