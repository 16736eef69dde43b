"""Gold tables (CSV or Parquet) and predictions by file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import NO_RELATION


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path) if path.rstrip("/").endswith(".parquet") else spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def read_gold_entities(spark: SparkSession, path: str) -> DataFrame:
    """entity_type, name, s, e: rows whose places are no numbers are left out."""
    rows = _read(spark, path)
    number = lambda c: F.col(c).cast("string").try_cast("double").cast("int")
    out = rows.select(F.col("entity type").alias("entity_type"), F.lower(F.col("entity").cast("string")).alias("name"), number("start").alias("s"), number("end").alias("e"))
    return out.dropna(subset=["s", "e"])


def read_gold_relations(spark: SparkSession, path: str) -> DataFrame:
    """gold_id, pmcid, subject, object, alt_names and actual; an empty relation is No_Relationship."""
    rows = _read(spark, path)
    actual = next((c for c in rows.columns if c.startswith("Actual Relation")), None)
    alt = next((c for c in rows.columns if c.lower() == "object alt names"), None)
    return rows.select(
        F.monotonically_increasing_id().alias("gold_id"),
        F.col("PMCID").alias("pmcid"),
        F.col("Subject_name").alias("subject"),
        F.col("Object_name").alias("object"),
        (F.col(f"`{alt}`") if alt else F.lit(None).cast("string")).alias("alt_names"),
        F.coalesce(F.when(F.trim(F.col(f"`{actual}`")) != "", F.trim(F.col(f"`{actual}`"))) if actual else F.lit(None).cast("string"), F.lit(NO_RELATION)).alias("actual"),
    )
