"""Articles as their files arrive: each micro-batch runs the stages on documents that are new."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.loading import pending
from ..session import materialise, written
from ..sources.articles import stream_articles


def new_articles(articles: DataFrame) -> DataFrame:
    """A stream's rows, of each id the first to come; rows without an id all pass.

    The ids are keyed state in the checkpoint's state store, so a batch meets only the partitions of the state that its own ids
    hash to, however many batches came before.  A row without an id is a key of its own.
    """
    alone = F.when(F.col("id").isNull(), F.uuid())
    return articles.withColumn("_alone", alone).dropDuplicates(["id", "_alone"]).drop("_alone")


def _taken_elsewhere(spark: SparkSession, output: str, run: str) -> DataFrame | None:
    """The ids that queries with another checkpoint wrote under output; read once, as a query starts."""
    try:
        ids = spark.read.parquet(f"{output}/taken").where(F.col("run") != run).select("id")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    ids = materialise(ids.distinct())
    return None if ids.isEmpty() else ids


def ingest(spark: SparkSession, folder: str, output: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], once: bool = True, files: int | None = None) -> StreamingQuery:
    """Starts a query that writes process(articles) under output, each article once, ``files`` files at most in a batch if given.

    The checkpoint keeps which files were read and which ids came.  A batch writes its rows, and its articles' ids for queries with
    another checkpoint, under its own number; if it runs again after a failure, it finds the state as it was before and writes
    the same over them.  So results are neither lost nor doubled.  Two queries should not write under one output at once.
    """
    run = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    elsewhere = _taken_elsewhere(spark, output, run)

    def batch(articles: DataFrame, epoch: int) -> None:
        new = written(articles)  # one pass over the state, whatever process() does with the rows
        if elsewhere is not None:
            new = materialise(pending(new, elsewhere, "id"))
        process(new).write.mode("overwrite").parquet(f"{output}/rows/run={run}/epoch={epoch}")
        new.select("id").where("id IS NOT NULL").write.mode("overwrite").parquet(f"{output}/taken/run={run}/epoch={epoch}")

    articles = new_articles(stream_articles(spark, folder, files))
    writer = articles.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()
