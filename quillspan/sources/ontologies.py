"""Ontologies in OBO files, and pathway lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_name, clean_synonym

# Subsets whose terms are not for annotation.
LEFT_OUT = ["gocheck_do_not_annotate", "gocheck_obsoletion_candidate"]
NO_NAMESPACE = "unknown_namespace"


def _values(tag: str) -> Column:
    """All values of a tag of a stanza."""
    return F.regexp_extract_all("value", F.lit(rf"(?m)^{tag}:[ \t]*(.*?)[ \t]*\r?$"), F.lit(1))


def _first(tag: str) -> Column:
    return F.get(_values(tag), F.lit(0))


def read_obo(spark: SparkSession, path: str) -> DataFrame:
    """Terms: id, name, namespace, synonyms (lines), subsets, is_obsolete, is_a, relationships.

    A stanza is a row of the text, so files are split and read in parallel.  Terms without a namespace have their
    file's default one.  Line ends may be those of any system.  Nothing is filtered: see annotatable().
    """
    # a stanza starts at a line with its kind in brackets, whatever ends the line before
    chunks = spark.read.option("lineSep", "\n[").text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    stanzas = chunks.withColumn("value", F.when(F.col("value").rlike(r"^[A-Za-z]+\]"), F.concat(F.lit("["), F.col("value"))).otherwise(F.col("value")))
    header = stanzas.where(~F.contains(F.ltrim("value"), F.lit("[Term]")) & F.contains("value", F.lit("default-namespace:")))
    default = header.groupBy("_file").agg(F.first(_first("default-namespace")).alias("_default"))
    terms = stanzas.where(F.col("value").rlike(r"(?m)^\[Term\]\s*$")).select(
        "_file",
        F.regexp_replace(_first("id"), r"\s*!.*$", "").alias("id"),
        _first("name").alias("name"),
        _first("namespace").alias("namespace"),
        _values("synonym").alias("synonyms"),
        _values("subset").alias("subsets"),
        F.coalesce(_first("is_obsolete") == "true", F.lit(False)).alias("is_obsolete"),
        F.transform(_values("is_a"), lambda x: F.trim(F.get(F.split(x, "!"), F.lit(0)))).alias("is_a"),
        _values("relationship").alias("relationships"),
    )
    joined = terms.join(F.broadcast(default), "_file", "left")  # a row for each file
    return joined.withColumn("namespace", F.coalesce("namespace", "_default", F.lit(NO_NAMESPACE))).drop("_file", "_default")


def annotatable(terms: DataFrame, namespace: str | None = None) -> DataFrame:
    """Terms that may be linked to: named, not obsolete, in none of the subsets left out, of the namespace if given."""
    out = terms.where(F.col("name").isNotNull() & ~F.col("is_obsolete") & ~F.arrays_overlap("subsets", F.array(*[F.lit(x) for x in LEFT_OUT])))
    return out if namespace is None else out.where(F.col("namespace") == namespace)


def edges(terms: DataFrame) -> DataFrame:
    """child, rel and parent of is_a lines and relationships."""
    is_a = terms.select(F.col("id").alias("child"), F.lit("is_a").alias("rel"), F.explode("is_a").alias("parent"))
    other = terms.select(F.col("id").alias("child"), F.explode("relationships").alias("r"))
    words = F.split(F.trim(F.get(F.split("r", "!"), F.lit(0))), r"\s+")
    return is_a.unionByName(other.select("child", F.get(words, F.lit(0)).alias("rel"), F.get(words, F.lit(1)).alias("parent")))


def term_surfaces(terms: DataFrame) -> DataFrame:
    """id, name, namespace and surface: each distinct surface form of a term, synonyms cleaned."""
    lines = terms.select("id", "name", "namespace", F.explode("synonyms").alias("line")).select("id", "name", "namespace", clean_synonym(F.col("line")).alias("surface"))
    names = terms.select("id", "name", "namespace", F.trim("name").alias("surface"))
    return names.unionByName(lines).where("surface IS NOT NULL AND surface <> ''").distinct()


def read_pathways(spark: SparkSession, path: str) -> DataFrame:
    """id and name of a pathway list: a header, then name, tab, id; rows without both are left out."""
    rows = spark.read.option("sep", "\t").option("header", True).schema("name string, id string").option("quote", "").csv(path)
    return rows.where("name IS NOT NULL AND id IS NOT NULL").select("id", clean_name(F.col("name")).alias("name"))
