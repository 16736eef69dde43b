"""Candidate pairs, and which passages and sentences speak of both members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import sentence_of, sentence_spans
from .mentions import overlap

EPSILON = 1e-6
BOOST = 1.2


def entity_pairs(entities: DataFrame, policy: str = "all") -> DataFrame:
    """doc_id, subj, obj and category: each compound of a document with each of its other entities.

    entities: doc_id, entity_type, name (and CID under policy ``cid_only``, which takes compounds with one alone).
    """
    compounds = entities.where("entity_type = 'compounds'")
    if policy == "cid_only":
        compounds = compounds.where("CID IS NOT NULL")
    left = compounds.select("doc_id", F.col("name").alias("subj"))
    right = entities.where("entity_type <> 'compounds'").select("doc_id", F.col("name").alias("obj"), F.col("entity_type").alias("category"))
    return left.join(right, "doc_id")


def unit_counts(spans: DataFrame, units: DataFrame) -> DataFrame:
    """For each entity and unit: n mentions that overlap, and their centres (pos, sorted).

    spans: doc_id, entity_type, name, s, e; units: doc_id, unit_idx, u_start, u_end.
    """
    met = overlap(spans, units)
    return met.groupBy("doc_id", "entity_type", "name", "unit_idx", "u_start", "u_end").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(F.floor((F.col("s") + F.col("e")) / 2).cast("int"))).alias("pos")
    )


def inverse_frequency(counts: DataFrame, units: DataFrame) -> DataFrame:
    """counts with idf of each entity over the units of its document: ln(1 + N / df)."""
    n = units.groupBy("doc_id").agg(F.count("*").alias("n_units"))
    df = F.count("*").over(Window.partitionBy("doc_id", "entity_type", "name"))  # counts has a row for each unit
    return counts.withColumn("df", df).join(n, "doc_id").withColumn("idf", F.log(1.0 + F.col("n_units") / F.greatest("df", F.lit(1))))


def co_count(a: Column, b: Column) -> Column:
    """ln(1 + the harmonic mean of two counts)."""
    return F.log(1.0 + 2.0 * a * b / (a + b + EPSILON))


def proximity(a: Column, b: Column) -> Column:
    """Over the sentence indices of a: 1 / (1 + distance to the nearest of b), summed; 0 if either has none."""
    near = F.transform(a, lambda x: 1.0 / (1.0 + F.array_min(F.transform(b, lambda y: F.abs(x - y)))))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.aggregate(near, F.lit(0.0), lambda s, x: s + x)).otherwise(F.lit(0.0))


def sentence_indices(counts: DataFrame, units: DataFrame) -> DataFrame:
    """counts with sent: the sentence within the unit of each mention.  units has text as well."""
    places = units.select("doc_id", "unit_idx", sentence_spans(F.col("text"), F.col("u_start")).alias("_sentences"))  # not the text itself
    joined = counts.join(places, ["doc_id", "unit_idx"])
    return joined.withColumn("sent", F.transform("pos", lambda p: sentence_of(p, F.col("_sentences")))).drop("_sentences")


def pair_units(weighed: DataFrame) -> DataFrame:
    """Each compound with each other entity of the same unit, with both sides' n, idf and sent.

    weighed: counts with idf, and sent if it is needed.  The entities of a unit meet in its row: there are few.
    """
    extra = [c for c in ("sent",) if c in weighed.columns]
    entity = F.struct("entity_type", "name", "n", "idf", *extra)
    met = weighed.groupBy("doc_id", "unit_idx", "u_start", "u_end").agg(F.collect_list(entity).alias("all"))
    compounds = F.filter("all", lambda x: x["entity_type"] == "compounds")
    others = F.filter("all", lambda x: x["entity_type"] != "compounds")
    rows = met.select("doc_id", "unit_idx", "u_start", "u_end", F.explode(compounds).alias("a"), others.alias("others")).select("*", F.explode("others").alias("b"))
    sides = [F.col(f"{side}.{c}").alias(f"{c}_{side}") for c in ("n", "idf", *extra) for side in "ab"]
    return rows.select("doc_id", "unit_idx", "u_start", "u_end", F.col("a.name").alias("subj"), F.col("b.entity_type").alias("category"), F.col("b.name").alias("obj"), *sides)


def passage_scores(pairs: DataFrame) -> DataFrame:
    """pairs with co, prox, same and score."""
    out = pairs.withColumns({"co": co_count(F.col("n_a"), F.col("n_b")), "prox": proximity(F.col("sent_a"), F.col("sent_b")), "same": F.arrays_overlap("sent_a", "sent_b")})
    boost = F.when(F.col("same"), BOOST).otherwise(1.0)
    return out.withColumn("score", F.col("co") * (1.0 + F.col("prox")) * F.col("idf_a") * F.col("idf_b") * boost)


def top_units(scored: DataFrame, k: int = 2) -> DataFrame:
    """The k best units of each pair, with their rank; equal scores (to 9 digits) in document order."""
    order = Window.partitionBy("doc_id", "subj", "category", "obj").orderBy(F.round("score", 9).desc(), "unit_idx")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_sentences(top: DataFrame, weighed_sentences: DataFrame, per_paragraph: int = 2) -> DataFrame:
    """The best sentences within each chosen passage: doc_id, subj, category, obj, rank, sent_idx, u_start, u_end, score.

    A sentence that lies in several chosen passages belongs to the best of them.
    """
    key = ["doc_id", "subj", "category", "obj"]
    scored = pair_units(weighed_sentences).select(
        *key, F.col("unit_idx").alias("sent_idx"), F.col("u_start").alias("s_start"), F.col("u_end").alias("s_end"),
        (co_count(F.col("n_a"), F.col("n_b")) * 2.0 * F.col("idf_a") * F.col("idf_b") * BOOST).alias("sent_score"),
    )
    inside = top.select(*key, "rank", "u_start", "u_end").join(scored, key).where((F.col("s_start") >= F.col("u_start")) & (F.col("s_end") <= F.col("u_end")))
    home = inside.withColumn("_home", F.row_number().over(Window.partitionBy(*key, "sent_idx").orderBy("rank"))).where("_home = 1")
    order = Window.partitionBy(*key, "rank").orderBy(F.round("sent_score", 9).desc(), "sent_idx")
    return home.withColumn("turn", F.row_number().over(order)).where(F.col("turn") <= per_paragraph).drop("_home")


def context_indices(best: DataFrame, n_sentences: DataFrame) -> DataFrame:
    """The best sentences and their neighbours within the document: distinct doc_id, subj, category, obj, sent_idx."""
    around = F.sequence(F.greatest(F.lit(0), F.col("sent_idx") - 1), F.least(F.col("n") - 1, F.col("sent_idx") + 1))
    return best.join(n_sentences, "doc_id").select("doc_id", "subj", "category", "obj", F.explode(around).alias("sent_idx")).distinct()


def assemble(top: DataFrame, best: DataFrame, sentences: DataFrame, passages: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """doc_id, subj, category, obj and context of each pair that has one.

    The context is the best sentences with their neighbours in order, then the chosen passages that gave no
    sentence and are not there yet; without any sentence, all chosen passages.
    sentences: doc_id, sent_idx (over the document), text; passages: doc_id, unit_idx, text; places: a row with doc_id for each
    sentence, where one is at hand that costs less than sentences.
    """
    key = ["doc_id", "subj", "category", "obj"]
    n = (sentences if places is None else places).groupBy("doc_id").agg(F.count("*").cast("int").alias("n"))
    lines = context_indices(best, n).join(sentences.select("doc_id", "sent_idx", "text"), ["doc_id", "sent_idx"])
    lines = lines.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("sent_idx", "text"))), lambda x: x["text"]).alias("lines"))
    used = best.select(*key, "rank").distinct()
    spare = top.join(used, [*key, "rank"], "left_anti").join(passages.select("doc_id", "unit_idx", "text"), ["doc_id", "unit_idx"])
    spare = spare.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]).alias("spare"))
    every = top.select(*key).distinct().join(lines, key, "left").join(spare, key, "left")
    none = F.array().cast("array<string>")
    have = F.coalesce("lines", none)
    tail = F.filter(F.array_distinct(F.coalesce("spare", none)), lambda x: ~F.array_contains(have, x))
    context = F.concat_ws("\n", F.concat(have, tail))
    return every.select(*key, context.alias("context")).where(F.trim("context") != "")
