"""Editing hand-made annotations: find, add, remove, keep the last, save in order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .mentions import locate_all, spans_of


def annotate(passages: DataFrame, requests: DataFrame) -> DataFrame:
    """Every place in every passage of each request (entity_type, name): a non-interactive annotator."""
    return spans_of(locate_all(passages, requests))


def keep_last(annotations: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Of rows with equal keys the one with the largest seq."""
    rest = [c for c in annotations.columns if c not in keys]
    out = annotations.groupBy(*keys).agg(F.max_by(F.struct(*rest), seq).alias("x"))
    return out.select(*keys, "x.*")


def add(annotations: DataFrame, found: DataFrame) -> DataFrame:
    """annotations and those of found that they do not have yet: equal document, type, place and name without regard to case."""
    key = ["doc_id", "entity_type", "s", "e"]
    both = annotations.withColumn("_turn", F.lit(0)).unionByName(found.withColumn("_turn", F.lit(1)))
    rest = [c for c in annotations.columns if c not in key]
    out = both.groupBy(*key, F.lower("name").alias("_name")).agg(F.min_by(F.struct(*rest), "_turn").alias("_x"))
    return out.select(*key, "_x.*").select(*annotations.columns)


def by_place(annotations: DataFrame) -> DataFrame:
    """doc_id and its annotations as a list, sorted by start, end, type and name; sorted in the row, not over all rows."""
    mark = F.struct("s", "e", "entity_type", "name")
    return annotations.groupBy("doc_id").agg(F.array_sort(F.collect_list(mark)).alias("annotations"))


def save(annotations: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A line of JSON for each document, its annotations in order of place."""
    by_place(annotations).write.mode(mode).json(path)


def remove(annotations: DataFrame, unwanted: DataFrame) -> DataFrame:
    """annotations without those of an unwanted (entity_type, name), names without regard to case."""
    gone = unwanted.select(F.col("entity_type").alias("_t"), F.lower("name").alias("_n")).distinct()
    return annotations.join(gone, (annotations["entity_type"] == gone["_t"]) & (F.lower(annotations["name"]) == gone["_n"]), "left_anti")


def reference_lines(annotations: DataFrame) -> DataFrame:
    """value: a sorted line "type: name" for each distinct pair, in lower case."""
    return annotations.select(F.concat_ws(": ", "entity_type", F.lower("name")).alias("value")).distinct().orderBy("value")
