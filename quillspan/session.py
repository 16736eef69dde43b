"""Session helpers: a tuned local session, and the package itself for Python workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def local_session(cores: int = 8, partitions: int | None = None, memory: str = "12g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="quillspan-code-"), "quillspan.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def spread(df: DataFrame, most_bytes: int = 64 << 20) -> DataFrame:
    """A small table whose files make fewer tasks than there are cores, dealt out to all of them; others as they are.

    A Parquet row group is one task however many cores there are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > most_bytes or df._jdf.rdd().getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees (spark.checkpoint.dir); one of our own only where a local session names none."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="quillspan-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def materialise(df: DataFrame) -> DataFrame:
    """Written to the shared folder, its lineage dropped: computed once, and kept when executors are lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: for rounds that build on each other, whose plans then start from a plain scan.
    (A checkpoint remembers what is known of its columns, which grows from round to round until planning stands still.)"""
    path = f"{shared_dir(df.sparkSession)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def number_rows(df: DataFrame, name: str) -> DataFrame:
    """df with ``name``, the place of each row in the order that df has, from 0.  df is written; then only the number of rows of each
    partition is on the driver."""
    rows = materialise(df)
    counts = {r[0]: r[1] for r in rows.groupBy(F.spark_partition_id()).count().collect()}
    before, total = [], 0
    for part in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(part, 0)
    start = F.get(F.array(*[F.lit(x) for x in before or [0]]), F.spark_partition_id())
    return rows.withColumn(name, start.cast("long") + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
