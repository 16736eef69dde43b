"""Licence scans by canonical digests: built-in functions only.

A text is brought to a canonical form (case, punctuation, copyright lines, equivalent spellings) and its
digest is looked up among those of known licences, which are made by the same expressions.  So are the lines that
speak of a licence: many documents are under one by such a line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .known_licenses import LINE_WORD, NOTICE_LINE, OWN_NOTICE, SPELLINGS, TEXTS


def canonical(text: Column) -> Column:
    """The words of a text in canonical form, one space between them; null has none.

    Lines that are a copyright notice (a year or a mark after the word, nothing to fill in) go, and so does "all
    rights reserved"; a notice of a licence's own text stays, and a body's line that happens to start with the word too, so line ends
    don't matter.  Whatever is no ASCII letter or digit separates words; each of SPELLINGS becomes its common form.
    """
    x = F.lower(F.coalesce(text, F.lit("")))
    x = F.regexp_replace(x, OWN_NOTICE, "xcopyright$1$2")
    x = F.regexp_replace(x, "(?md)" + NOTICE_LINE, "")
    x = F.regexp_replace(x, "[^a-z0-9]+", " ")
    x = F.concat(F.lit(" "), F.trim(x), F.lit(" "))
    for found, common in SPELLINGS:
        x = F.replace(x, F.lit(f" {found} "), F.lit(f" {common} "))
    return F.trim(F.regexp_replace(x, " +", " "))


def _digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known(spark: SparkSession, texts: dict[str, str] | None = None) -> DataFrame:
    """text_sha256 and license_id of the known texts: a table of fixed size.  The first of equal texts counts."""
    rows = list((TEXTS if texts is None else texts).items())
    table = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "i int, license_id string, text string")
    return table.select("i", "license_id", _digest(F.col("text")).alias("text_sha256")).groupBy("text_sha256").agg(F.min_by("license_id", "i").alias("license_id"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", texts: dict[str, str] | None = None) -> DataFrame:
    """doc_id, text_sha256 (of the canonical text), license_id (null if unknown) and line_licenses of each row.

    license_id is of a whole text that is a known licence; line_licenses are those of its lines that are one, in order,
    each once, divided by commas (empty without any).  Texts without words, and texts that are nothing but a
    copyright line, have the digest of the empty text, which is no licence.  Null texts are empty.  Repeated rows are looked up each.
    """
    table = known(docs.sparkSession, texts)
    ids = F.create_map(*[F.lit(x) for r in table.collect() for x in (r["text_sha256"], r["license_id"])] or [F.lit("")] * 2)  # as many as there are known texts
    text = F.col(text_col)
    speaking = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.contains(F.lower(x), F.lit(LINE_WORD)))
    named = F.array_distinct(F.array_sort(F.array_compact(F.transform(speaking, lambda x: F.try_element_at(ids, _digest(x))))))
    lines = F.when(F.contains(F.lower(text), F.lit(LINE_WORD)), F.array_join(named, ",")).otherwise(F.lit(""))
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), _digest(text).alias("text_sha256"), lines.alias("line_licenses"))
    return found.join(F.broadcast(table), "text_sha256", "left").select("doc_id", "text_sha256", "license_id", "line_licenses")
