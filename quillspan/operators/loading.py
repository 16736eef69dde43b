"""Loading: id lists, first rows, integrity, resuming, writing by document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    """id: the distinct trimmed values of a column, found by its trimmed name; nulls and blanks go."""
    name = next((c for c in df.columns if c.strip() == column), None)
    if name is None:
        raise ValueError(f"no column {column!r} among {df.columns}")
    return df.select(F.trim(F.col(f"`{name}`")).alias("id")).where(F.col("id").isNotNull() & (F.col("id") != "")).distinct()


def integrity(name: str, stored: DataFrame, source: DataFrame, keys: list[str], sample: int | None = None, seed: int = 0) -> DataFrame:
    """tbl, n_stored and n_unknown: how many stored rows the source does not have.  Sound tables have none.

    sample: check that many rows, picked at random, instead of all.
    """
    rows = stored if sample is None else stored.orderBy(F.rand(seed)).limit(sample)
    known = source.select(*keys).distinct().withColumn("_known", F.lit(True))
    return rows.join(known, keys, "left").agg(F.count("*").alias("n_stored"), F.count_if(F.col("_known").isNull()).alias("n_unknown")).select(F.lit(name).alias("tbl"), "n_stored", "n_unknown")


def pending(inputs: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """Inputs that no output has yet."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def store(df: DataFrame, path: str, partition: str | None = None, mode: str = "errorifexists", kind: str = "parquet") -> None:
    """Writes a stage's result; mode ``ignore`` leaves a table alone that is there."""
    writer = df.write.mode(mode).format(kind)
    (writer.partitionBy(partition) if partition else writer).save(path)
