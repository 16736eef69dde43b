"""A training corpus from raw documents: five stages over Parquet, each on all that the one before it kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspan.llm.exact_dedup import without_copies
from quillspan.llm.jaccard_join import similar_documents
from quillspan.llm.mixing import mix, mixed_rows
from quillspan.llm.packing import cut_pieces, pack
from quillspan.llm.quality_model import classify
from quillspan.llm.queries import tokenizer_path
from quillspan.llm.runtime import cut, input_bytes, power_of_two, shared_dir, word_count
from quillspan.session import ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _held(docs: DataFrame) -> DataFrame:
    """The rows of docs, each as one column, beside what the stages work with: no name of theirs can clash."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha")
    return docs.select(row, F.col("doc_id").cast("long").alias("doc_id"), "text", sha)


def _where_kept(held: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows whose doc_id and sha are those of a row of kept; ids may be null or repeated."""
    ids = kept.select(F.col("doc_id").alias("kept_id"), F.col("sha").alias("kept_sha"))
    return held.join(ids, held["doc_id"].eqNullSafe(ids["kept_id"]) & (held["sha"] == ids["kept_sha"]), "left_semi")


def _numbered(held: DataFrame) -> DataFrame:
    """held with number, which distinct rows of id and text have for themselves, in the order of doc_id (null ids last).

    Where no id is null or repeated, it is the doc_id.
    """
    unclear = held.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1")
    if not unclear.limit(1).count():
        return held.withColumn("number", F.col("doc_id"))
    order = held.select(F.col("doc_id").alias("id"), F.col("sha").alias("of")).distinct().orderBy(F.asc_nulls_last("id"), "of")
    numbers = cut(order.withColumn("number", F.monotonically_increasing_id()))
    joined = held.join(numbers, held["doc_id"].eqNullSafe(numbers["id"]) & (held["sha"] == numbers["of"])).dropDuplicates(["number"])
    return cut(joined)  # what is written keeps its order when a task runs again, which a join's rows don't


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good.

    Null and empty texts are judged like any other.  Rows of one id, or without one, are judged each by their own
    text; repeated rows go or stay together.  Columns of any name come through.  An empty table stays empty; without
    labels of both kinds every score is 0.5, which is good.
    """
    ship(spark)
    held = _held(docs)
    judged = classify(held.select("doc_id", "text", "sha"), spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=("sha",))
    return _where_kept(held, judged.where("predicted = 1")).select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest original, then the smallest doc_id, null ids last.

    Null texts are equal to empty ones.  Of rows that repeat id and text one stays.  Columns of any name come
    through.  An empty table stays empty.
    """
    ship(spark)
    return without_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id; 80 % of the shingles of 5 words link.

    Null ids come after all others.  Rows of one id are documents each by their own text; of rows that repeat both
    one stays.  Texts without words, null ones too, are linked with nothing and stay.  Columns of any name come
    through.  An empty table stays empty.
    """
    ship(spark)
    rows = _numbered(_held(docs))
    joined = similar_documents(rows.select("number", "text"), id_col="number", shingle=5, percent=80)
    stay = joined.where("component_id = doc_id").select(F.col("doc_id").alias("number"))
    return rows.join(stay, "number", "left_semi").select("row.*")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight: documents that it takes twice or more are repeated, others go.

    Null sources are one source; a text without words, null too, has size 0 and comes with its block.  Rows that
    repeat an id and a size are taken together.  Columns of any name come through.  An empty table stays empty.
    """
    ship(spark)
    parts = power_of_two(input_bytes(docs) / (64 << 20), 64, 1 << 16)
    shards = min(parts, 1 << 12)
    held = _held(docs).withColumn("source", F.col("row.source"))
    mixed = mix(held.select("row", "doc_id", "source", word_count(F.col("text")).alias("size")), shards=shards)
    return mixed_rows(mixed, ["row"], slices=parts // shards).select("row.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows, packed into sequences of 2048 ids.

    Null and empty texts are one piece of one id.  Repeated rows, and rows without an id, are packed each.  Other
    columns don't matter.  An empty table gives no piece.
    """
    ship(spark)
    return pack(cut_pieces(docs, tokenizer_path(), end_id=0, capacity=2048), 2048)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", best_fit_packing),
]

#: The classifier, the mix and the tokenizer have no SQL: tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written to the shared folder and read again."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
