"""Passage-level mentions to document entities: merging by key and by abbreviation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import ENTITY_POLICY


def merge_key(df: DataFrame) -> Column:
    """The first id that the entity's type goes by and that is filled, as text, else the lower-case name."""
    out = F.lower("name")
    for entity_type, *_, order in ENTITY_POLICY:
        ids = [F.when((F.col(c).cast("string") != "") & (F.col(c).cast("string") != "0"), F.col(c).cast("string")) for c in order if c in df.columns]
        if ids:
            out = F.when(F.col("entity_type") == entity_type, F.coalesce(*ids, F.lower("name"))).otherwise(out)
    return out


def merge_duplicates(mentions: DataFrame, attributes: list[str] | None = None) -> DataFrame:
    """A row for each document, type and key: the attributes of the first mention, all spans, other names.

    mentions: doc_id, passage_idx, entity_idx, entity_type, name, spans and id columns.  Spans are distinct and
    sorted; alt_names are the later names that differ from the first one without regard to case.
    """
    attributes = [c for c in mentions.columns if c not in ("doc_id", "passage_idx", "entity_idx", "entity_type", "name", "spans")] if attributes is None else attributes
    keyed = mentions.withColumn("merge_key", merge_key(mentions)).where(F.coalesce("merge_key", F.lit("")) != "")
    turn = F.struct("passage_idx", "entity_idx")
    first = F.min_by(F.struct("name", *attributes), turn).alias("_first")
    grouped = keyed.groupBy("doc_id", "entity_type", "merge_key").agg(first, F.min(turn).alias("turn"), F.collect_list("spans").alias("_spans"), F.collect_set("name").alias("_names"))
    return grouped.select(
        "doc_id",
        "entity_type",
        "merge_key",
        "turn",
        F.col("_first.name").alias("name"),
        F.array_sort(F.array_distinct(F.flatten("_spans"))).alias("spans"),
        F.array_sort(F.filter("_names", lambda x: (x != "") & (F.lower(x) != F.lower(F.col("_first.name"))))).alias("alt_names"),
        *[F.col(f"_first.{c}").alias(c) for c in attributes],
    )


def merge_abbreviations(entities: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """entities in which a short form goes into the entity of its long form, of the same document and type.

    entities: doc_id, entity_type, turn, name, spans, alt_names, ...; abbreviations: doc_id, short, long.  Of
    entities with equal names the first stays.  The long form's entity takes over spans and names, and the short name.
    A short form of a short form ends with that one.
    """
    others = [c for c in entities.columns if c not in ("doc_id", "entity_type", "turn", "name", "spans", "alt_names")]
    once = entities.groupBy("doc_id", "entity_type", "name").agg(F.min_by(F.struct(*[c for c in entities.columns if c not in ("doc_id", "entity_type", "name")]), "turn").alias("x"))
    once = once.select("doc_id", "entity_type", "name", "x.*")
    long = abbreviations.select("doc_id", F.col("short").alias("name"), F.lower("long").alias("_long"))
    homes = once.groupBy("doc_id", "entity_type", F.lower("name").alias("_long")).agg(F.max_by("name", "turn").alias("_home"))
    placed = once.join(long, ["doc_id", "name"], "left").join(homes, ["doc_id", "entity_type", "_long"], "left")
    moves = F.col("_home").isNotNull() & (F.col("_home") != F.col("name"))
    placed = placed.withColumns({"_moved": moves, "_to": F.when(moves, F.col("_home")).otherwise(F.col("name"))})
    own = F.struct("_moved", "turn")
    grouped = placed.groupBy("doc_id", "entity_type", F.col("_to").alias("name")).agg(
        F.min_by(F.struct("turn", "_moved", *others), own).alias("x"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
        F.array_sort(F.array_distinct(F.concat(F.flatten(F.collect_list("alt_names")), F.collect_set(F.when(F.col("_moved"), F.col("name")))))).alias("alt_names"),
    )
    return grouped.select("doc_id", "entity_type", "x.turn", "name", "spans", "alt_names", *[F.col(f"x.{c}").alias(c) for c in others])
