"""Relations: routing, checking, flattening, exporting, comparing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import NO_DEFINITION, NO_RELATION


def route(relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Relations, and those that say there is none.  Pairs without a predicate are in neither: see unanswered()."""
    none = F.col("predicate") == NO_RELATION
    return relations.where(~none), relations.where(none)


def unanswered(relations: DataFrame) -> DataFrame:
    """Pairs whose predicate is null, because no answer of the model fitted: kept to be asked again or looked at."""
    return relations.where("predicate IS NULL")


def judge(relations: DataFrame) -> DataFrame:
    """relations with decision: yes if the justification, without regard to case, is in the context."""
    found = F.contains(F.lower("context"), F.lower("justification")) & (F.trim("justification") != "")
    return relations.withColumn("decision", F.when(F.coalesce(found, F.lit(False)), "yes").otherwise("no"))


def with_definitions(relations: DataFrame, guidelines: DataFrame) -> DataFrame:
    """relations with the definition of their predicate in their category; guidelines are a table of fixed size."""
    return relations.join(F.broadcast(guidelines), ["category", "predicate"], "left").withColumn("definition", F.coalesce("definition", F.lit(NO_DEFINITION)))


def _id(*columns: str) -> Column:
    return F.coalesce(*[F.col(c).cast("string") for c in columns])


def flatten(relations: DataFrame) -> DataFrame:
    """Ten flat columns of nested relations: a taxonomy id stands in for an object's ontology id."""
    s, o = "subject_entity", "object_entity"
    return relations.select(
        F.col(f"{s}.name").alias("subject_name"), F.col(f"{s}.alt_names").alias("subject_alt_names"), _id(f"{s}.CID", f"{s}.ontology_id").alias("subject_cid"),
        "predicate", F.col(f"{o}.name").alias("object_name"), F.col(f"{o}.alt_names").alias("object_alt_names"), _id(f"{o}.ontology_id", f"{o}.taxonomy_id").alias("object_ontology_id"),
        "category", "justification", "context",
    )


def linked_only(flat: DataFrame) -> DataFrame:
    return flat.where("subject_cid IS NOT NULL AND object_ontology_id IS NOT NULL")


def export(relations: DataFrame) -> DataFrame:
    """Rows for a sheet: an empty or zero CID gives way to the ontology id, and objects have no taxonomy id."""
    s, o = "subject_entity", "object_entity"
    cid = F.when(F.col(f"{s}.CID") != 0, F.col(f"{s}.CID").cast("string"))
    names = lambda c: F.concat_ws("; ", c)
    return relations.select(
        "pmcid", F.col(f"{s}.name").alias("subject_name"), names(f"{s}.alt_names").alias("subject_alt_names"), F.coalesce(cid, F.col(f"{s}.ontology_id")).alias("subject_id"), "predicate",
        F.col(f"{o}.name").alias("object_name"), names(f"{o}.alt_names").alias("object_alt_names"), F.col(f"{o}.ontology_id").alias("object_id"), "category", "justification",
    )


def by_subject(flat: DataFrame, subject: str | None = None) -> DataFrame:
    """subject_name and its relations, each as "predicate object", sorted; of the subjects that hold ``subject``,
    without regard to case, if it is given."""
    line = F.concat_ws(" ", "predicate", "object_name")
    if subject is not None:
        flat = flat.where(F.contains(F.lower("subject_name"), F.lit(subject.lower())))
    return flat.groupBy("subject_name").agg(F.array_sort(F.collect_list(line)).alias("relations"))


def _filled() -> list[Column]:
    return [F.coalesce(F.col(c), F.lit(f"Unknown {w}")).alias(w) for c, w in (("subject_name", "subject"), ("predicate", "predicate"), ("object_name", "object"))]


def triples(flat: DataFrame) -> DataFrame:
    """Distinct subject, predicate, object; missing ones are named as unknown."""
    return flat.select(*_filled()).distinct()


def compare(a: DataFrame, b: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows of two sets with where they are: both, first or second.  One aggregate over both; nulls are equal, repeated rows count once.

    With ``parts`` the rows are dealt to so many tasks before any of them is kept, so that a task's memory is theirs over parts.
    """
    return _sides(a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(2))), parts)


def compare_triples(flat: DataFrame, first: Column, parts: int | None = None) -> DataFrame:
    """compare() of the triples of the rows for which ``first`` is true and of those for which it is false, in one pass."""
    return _sides(flat.select(*_filled(), F.when(first, 1).when(~first, 2).alias("_side")).where("_side IS NOT NULL"), parts)


def _sides(every: DataFrame, parts: int | None) -> DataFrame:
    columns = [c for c in every.columns if c != "_side"]
    dealt = every.repartition(parts, *columns) if parts else every
    sides = dealt.groupBy(*columns).agg(F.bit_or("_side").alias("_side"))
    side = F.when(F.col("_side") == 3, "both").when(F.col("_side") == 1, "first").otherwise("second")
    return sides.select(*columns, side.alias("side"))
