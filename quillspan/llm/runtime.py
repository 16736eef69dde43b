"""Session services that the operators share: checkpoints, sizes and guarded broadcasts."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that end a word: space and tab to carriage return.
SPACE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees; one of our own only where the session names none."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        named = "file://" + tempfile.mkdtemp(prefix="quillspan-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Materialises df in the shared folder and drops its lineage; survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small(df: DataFrame, limit: int = 20_000) -> DataFrame:
    """df marked for broadcast if it has at most ``limit`` rows, else df as it is.

    The rows are counted first, at most limit + 1 of them, so what is broadcast has a checked size.
    """
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def input_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the bytes that df reads; where it has none (a checkpoint), 4 kB a row."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 4096 * df.count()


def power_of_two(n: float, least: int, most: int) -> int:
    k = least
    while k < n and k < most:
        k *= 2
    return k


def word_count(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE))).cast("long")
