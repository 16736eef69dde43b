"""JSON files of the pipeline's stages, read with fixed schemas and written as they are read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ENTITY, ENTITY_TYPES, RELATION

_NAMES = T.StructType([T.StructField(t, T.ArrayType(ENTITY)) for t in ENTITY_TYPES])
_RELATIONS = T.StructType([T.StructField("relations", T.ArrayType(RELATION))])
CORRUPT = "_corrupt_record"


def _file_name() -> Column:
    """A file's name; of one that write_json() made, the document in its folder's name."""
    decode = lambda x: F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B")))
    key = F.regexp_extract("_metadata.file_path", r"/doc_id=([^/]+)/[^/]*$", 1)
    return F.when(key != "", F.concat(decode(decode(key)), F.lit(".json"))).otherwise(F.col("_metadata.file_name"))


def _read(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """file_name and items (an array: a file holds one object or a list of them), and the files that don't fit."""
    wide = T.ArrayType(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
    text = spark.read.text(path, wholetext=True, pathGlobFilter="*.json").select(F.trim(F.regexp_replace("value", r"^\s+", "")).alias("value"), _file_name().alias("file_name"))
    listed = F.when(F.startswith("value", F.lit("[")), F.col("value")).otherwise(F.concat(F.lit("["), F.col("value"), F.lit("]")))
    rows = text.withColumn("items", F.from_json(listed, wide, {"columnNameOfCorruptRecord": CORRUPT}))
    bad = F.col("items").isNull() | F.exists("items", lambda x: x[CORRUPT].isNotNull())
    return rows.where(~bad).select("file_name", "items"), rows.where(bad).select("file_name", F.col("value").alias(CORRUPT))


def _long(rows: DataFrame, *keys: str) -> DataFrame:
    """A row for each entity."""
    each = rows.select(*keys, F.explode(F.array(*[F.struct(F.lit(t).alias("entity_type"), F.col(t).alias("list")) for t in ENTITY_TYPES])).alias("x"))
    placed = each.select(*keys, "x.entity_type", F.posexplode("x.list").alias("entity_idx", "e"))
    return placed.select(*keys, "entity_type", "entity_idx", "e.*").where("name IS NOT NULL")


def read_passage_entities(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Entities by passage (a list for each file), and files that don't fit: doc_id is the file's name."""
    rows, bad = _read(spark, path, _NAMES)
    each = rows.select(F.regexp_replace("file_name", r"\.json$", "").alias("doc_id"), F.posexplode("items").alias("passage_idx", "x"))
    return _long(each.select("doc_id", "passage_idx", "x.*"), "doc_id", "passage_idx"), bad


def read_document_entities(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Entities by document, and files that don't fit."""
    rows, bad = _read(spark, path, _NAMES)
    each = rows.select(F.regexp_replace("file_name", r"\.json$", "").alias("doc_id"), F.explode("items").alias("x"))
    return _long(each.select("doc_id", "x.*"), "doc_id"), bad


def read_relations(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """pmcid, row_idx and relation columns of relation files; those that were not evaluated or hold none are left out."""
    rows, bad = _read(spark, path, _RELATIONS)
    rows = rows.where(~F.col("file_name").rlike("_not_evaluated|_no_relationships"))
    number = F.regexp_extract("file_name", r"PMC(\d+)", 0)
    rows = rows.withColumn("pmcid", F.when(number != "", number).otherwise("Unknown"))
    rows = rows.select("pmcid", F.flatten("items.relations").alias("relations"))
    return rows.select("pmcid", F.posexplode("relations").alias("row_idx", "r")).select("pmcid", "row_idx", "r.*"), bad


def nest_entities(entities: DataFrame, *keys: str) -> DataFrame:
    """keys and a list column for each type that occurs: the shape of a document's JSON object."""
    fields = [c for c in entities.columns if c not in (*keys, "entity_type", "turn", "merge_key", "entity_idx")]
    lists = [F.collect_list(F.when(F.col("entity_type") == t, F.struct(*fields))).alias(t) for t in ENTITY_TYPES]
    return entities.groupBy(*keys).agg(*lists).select(*keys, *[F.when(F.size(t) > 0, F.col(t)).alias(t) for t in ENTITY_TYPES])


def nest_relations(relations: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and a list of relations."""
    fields = [c for c in relations.columns if c != key]
    return relations.groupBy(key).agg(F.collect_list(F.struct(*fields)).alias("relations"))
