"""Reference tables from dumps and ontologies, written once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.loading import store
from ..operators.providers import Embedder
from ..session import number_rows, ship
from ..sources import dumps, ontologies
from .corpus import Reference

COMPOUNDS = {"smiles": dumps.read_smiles, "inchikeys": dumps.read_inchikeys, "synonyms": dumps.read_synonyms}


def build_reference(spark: SparkSession, folder: str, taxonomy: str | None = None, **paths: str) -> None:
    """Writes smiles, inchikeys and synonyms (paths by name) and the taxonomy under folder; tables that are there stay."""
    for name, path in paths.items():
        store(COMPOUNDS[name](spark, path), f"{folder}/{name}", mode="ignore")
    if taxonomy:
        for name, rows in dumps.read_taxonomy(spark, taxonomy).items():
            store(rows, f"{folder}/{name}", mode="ignore")


def ontology_vectors(terms: DataFrame, ontology: str, embed: Embedder, namespace: str | None = None) -> DataFrame:
    """ontology, row_idx, id, surface, canonical_name, namespace and vec: a row for each surface form of a term.

    Rows are numbered by id and surface, by a range sort and the sizes of its partitions; no task has them all.
    """
    ship(terms.sparkSession)
    named = terms.where("name IS NOT NULL" if namespace is None else F.col("name").isNotNull() & (F.col("namespace") == namespace))
    surfaces = number_rows(ontologies.term_surfaces(named).orderBy("id", "surface"), "row_idx")
    return surfaces.select(
        F.lit(ontology).alias("ontology"), "row_idx", "id", "surface", F.col("name").alias("canonical_name"), "namespace", embed(F.col("surface")).alias("vec")
    )


def build_vectors(spark: SparkSession, folder: str, ontology: str, terms: DataFrame, embed: Embedder, namespace: str | None = None) -> None:
    """Writes an ontology's vectors under folder, partitioned by ontology; one that is there stays."""
    store(ontology_vectors(terms, ontology, embed, namespace), f"{folder}/ontology={ontology}", mode="ignore")


def load_reference(spark: SparkSession, folder: str, vectors: str | None = None) -> Reference:
    """The tables under folder; those that are not there are left out, with what depends on them."""

    def table(path: str) -> DataFrame | None:
        try:
            return spark.read.parquet(path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None

    names = ("synonyms", "smiles", "inchikeys", "names", "nodes", "merged")
    return Reference(terms=table(vectors) if vectors else None, **{n: table(f"{folder}/{n}") for n in names})
