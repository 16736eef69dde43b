"""Exact duplicates, with heavy hitters split off: built-in functions only.

A frequent-items sketch of bounded size (the Misra-Gries family: counters that decrement each other) names
digests that may be frequent.  One pass counts those exactly, with map-side combining, and finds their winners;
the verified winners are broadcast, so that rows of frequent digests are decided where they are.  All other
digests, none of them frequent, take an ordinary shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import SPACE, cut


def normalised(text: Column) -> Column:
    """The text without its white space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars (code points of the original text) and text_sha256 of each row."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.char_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_chars"),
        F.sha2(normalised(text).cast("binary"), 256).alias("text_sha256"),
    )


def group_copies(keys: DataFrame, heavy: int = 256, capacity: int = 4096) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for each row of digests().

    The row with the most code points stays, then the smallest doc_id (null ids last).  Rows that repeat a
    winner's id and text are counted each and marked kept alike.  At most ``heavy`` winners are broadcast;
    ``capacity`` counters make the sketch find every digest with over about 1 / capacity of the rows.
    """
    keys = cut(keys)
    order = F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    best = [F.min(order).alias("best"), F.count("*").alias("group_size")]
    told = keys.agg(F.expr(f"approx_top_k(text_sha256, {heavy}, {capacity})").alias("top"))
    named = F.broadcast(told.select(F.explode("top").alias("t")).where("t.count > 1").select(F.col("t.item").alias("text_sha256")))
    winners = F.broadcast(keys.join(named, "text_sha256", "left_semi").groupBy("text_sha256").agg(*best))
    marked = keys.join(winners, "text_sha256", "left")
    frequent = marked.where("best IS NOT NULL")
    rest = marked.where("best IS NULL").select("doc_id", "n_chars", "text_sha256")
    light = rest.join(rest.groupBy("text_sha256").agg(*best), "text_sha256")
    out = frequent.unionByName(light)
    return out.select(
        "doc_id",
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("best.id")) & (-F.col("n_chars") == F.col("best.n"))).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The decision for every row of docs; other columns of docs don't matter.  Empty in, empty out."""
    return group_copies(digests(docs, id_col, text_col), **options)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs that stay, with all their columns, whatever their names; one of those that repeat a row's id
    and text."""
    decided = exact_dedup(docs, id_col, text_col, **options)
    stay = cut(decided.where("kept").groupBy(F.col("doc_id").alias("stay_id"), F.col("text_sha256").alias("stay_sha")).agg(F.count("*").alias("n")))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, F.col(id_col).cast("long").alias("id"), F.sha2(normalised(F.col(text_col)).cast("binary"), 256).alias("sha"))
    kept = rows.join(stay, rows["id"].eqNullSafe(stay["stay_id"]) & (rows["sha"] == stay["stay_sha"]), "left_semi")
    if stay.where("n > 1").limit(1).count():
        kept = kept.dropDuplicates(["id", "sha"])
    return kept.select("row.*")
