"""Articles to passages and sentences; the section, type and structure filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let, running_starts, sentences
from ..schemas import ANNOTATION_TYPES, PASSAGE_TYPES, SECTIONS


def child(infons: Column, key: str) -> Column:
    """The value of the first infon with this key."""
    return F.get(F.filter(infons, lambda x: x["_key"] == key), F.lit(0))["_VALUE"]


def in_or_absent(value: Column, allowed: list[str]) -> Column:
    """True if the value is missing or, in upper case, among the allowed ones."""
    return value.isNull() | F.upper(value).isin(allowed)


def select_passages(articles: DataFrame) -> DataFrame:
    """doc_id, passage_idx, u_start, u_end, text and annotation of the passages of parsed articles that are read."""
    each = articles.select(F.col("id").alias("doc_id"), F.posexplode("passage").alias("source_idx", "p"))
    kept = each.where(
        in_or_absent(child(F.col("p.infon"), "section_type"), SECTIONS) & in_or_absent(child(F.col("p.infon"), "type"), PASSAGE_TYPES) & F.col("p.offset").isNotNull() & F.col("p.text").isNotNull()
    )
    return kept.select(
        "doc_id",
        F.col("source_idx").alias("passage_idx"),
        F.col("p.offset").cast("int").alias("u_start"),
        (F.col("p.offset") + F.char_length("p.text")).cast("int").alias("u_end"),
        F.col("p.text").alias("text"),
        F.col("p.annotation").alias("annotation"),
    )


def split_passages(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id, passage_idx, u_start and text of each line of a text; the line break counts as one character."""
    parts = F.split(F.col(text_col), "\n")
    placed = let(parts, lambda p: F.arrays_zip(p.alias("text"), running_starts(F.transform(p, lambda x: F.char_length(x)), 1).alias("at")))
    rows = docs.select("doc_id", F.posexplode(placed).alias("passage_idx", "p"))
    return rows.select("doc_id", "passage_idx", F.col("p.at").alias("u_start"), F.col("p.text").alias("text"))


def number_sentences(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id, unit_idx (over the document), passage_idx, u_start, u_end and text of each sentence of each line of a
    text; numbered in the document's row, so no text is shuffled."""

    def of_lines(lines: Column) -> Column:
        return let(
            running_starts(F.transform(lines, lambda x: F.char_length(x)), 1),
            lambda starts: F.flatten(
                F.transform(
                    lines,
                    lambda line, i: F.transform(sentences(line), lambda x: F.struct(i.alias("passage_idx"), (F.get(starts, i) + x["s"]).cast("int").alias("at"), x["text"].alias("text"))),
                )
            ),
        )

    every = F.filter(let(F.split(F.col(text_col), "\n"), of_lines), lambda x: F.char_length(x["text"]) > 0)
    rows = docs.select("doc_id", F.posexplode(every).alias("unit_idx", "x"))
    return rows.select("doc_id", "unit_idx", "x.passage_idx", F.col("x.at").alias("u_start"), (F.col("x.at") + F.char_length("x.text")).cast("int").alias("u_end"), "x.text")


def split_sentences(passages: DataFrame) -> DataFrame:
    """doc_id, passage_idx, sent_idx (within the document's passage), u_start, u_end and text of each sentence."""
    rows = passages.select("doc_id", "passage_idx", "u_start", F.posexplode(sentences(F.col("text"))).alias("sent_idx", "x")).where(F.char_length("x.text") > 0)
    start = (F.col("u_start") + F.col("x.s")).cast("int")
    return rows.select("doc_id", "passage_idx", "sent_idx", start.alias("u_start"), (start + F.char_length("x.text")).cast("int").alias("u_end"), F.col("x.text").alias("text"))


def annotation_type(kind: Column) -> Column:
    """The entity type of an annotation type, null for the others."""
    out = F.lit(None).cast("string")
    for found, entity_type in ANNOTATION_TYPES.items():
        out = F.when(kind == found, entity_type).otherwise(out)
    return out


def pre_annotations(passages: DataFrame) -> DataFrame:
    """doc_id, passage_idx, entity_idx, entity_type and name of the annotations that come with the articles."""
    each = passages.select("doc_id", "passage_idx", F.posexplode("annotation").alias("entity_idx", "a"))
    out = each.select("doc_id", "passage_idx", "entity_idx", annotation_type(child(F.col("a.infon"), "type")).alias("entity_type"), F.col("a.text").alias("name"))
    return out.where(F.col("entity_type").isNotNull() & (F.col("name") != ""))


def override(mentions: DataFrame, annotated: DataFrame) -> DataFrame:
    """mentions, in which a document with any annotation has its compounds, genes and species from those alone."""
    columns = ["doc_id", "passage_idx", "entity_type", "entity_idx", "name"]
    documents = annotated.select("doc_id").distinct().withColumn("_annotated", F.lit(True))
    replaced = F.col("_annotated").isNotNull() & F.col("entity_type").isin(list(ANNOTATION_TYPES.values()))
    return mentions.join(documents, "doc_id", "left").where(~replaced).select(columns).unionByName(annotated.select(columns))
