"""BioC XML articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_INFON = "array<struct<_VALUE:string,_key:string>>"
ARTICLE = f"id string, passage array<struct<infon:{_INFON},offset:int,text:string,annotation:array<struct<infon:{_INFON},text:string>>>>"


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """A row for each document of the XML files under path (a file, folder or glob), with its file's name.

    A file with several documents gives them all.
    """
    rows = spark.read.schema(ARTICLE).format("xml").option("rowTag", "document").load(path)
    return rows.select("id", "passage", F.col("_metadata.file_name").alias("file_name"))


def stream_articles(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """The same for files as they arrive in a folder, ``files`` of them at most in a batch if given."""
    reader = spark.readStream.schema(ARTICLE).format("xml").option("rowTag", "document")
    return (reader.option("maxFilesPerTrigger", files) if files else reader).load(path)
