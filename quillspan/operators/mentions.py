"""Extracted names to mentions with spans, and spans to units."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.automaton import pack_names, searcher
from ..functions.text import find_spans
from ..session import number_rows, ship


#: Characters of names in one automaton, some hundred bytes of memory each; larger lexicons are searched in parts.
PART = 4_000_000


def unique_names(extracted: DataFrame) -> DataFrame:
    """One row for each name of a passage and type; names that differ in case are different."""
    return extracted.groupBy("doc_id", "passage_idx", "entity_type", "name").agg(F.min("entity_idx").alias("entity_idx"))


def locate(extracted: DataFrame, passages: DataFrame) -> DataFrame:
    """The names with spans, counted over the document; names that their passage doesn't hold have none."""
    names = unique_names(extracted)
    joined = names.join(passages.select("doc_id", "passage_idx", "u_start", "text"), ["doc_id", "passage_idx"])
    return joined.select("doc_id", "passage_idx", "entity_type", "entity_idx", "name", find_spans(F.col("text"), F.col("name"), F.col("u_start")).alias("spans"))


def locate_all(passages: DataFrame, lexicon: DataFrame, part: int = PART) -> DataFrame:
    """The names of a lexicon (entity_type, name) that a passage holds, with spans: every name is looked for in every passage.

    An automaton goes through each text once, whatever the number of names.  entity_idx is the lexicon's own, or else
    the place of the row in it.  A lexicon of more than ``part`` characters is cut by a hash of its names, and each part
    is broadcast and searched for itself; so neither the driver nor a task holds more than a part.
    """
    ship(passages.sparkSession)
    numbered = lexicon.select("entity_idx", "entity_type", "name") if "entity_idx" in lexicon.columns else number_rows(lexicon.select("entity_type", "name"), "entity_idx").select("entity_idx", "entity_type", "name")
    numbered = numbered.where("name <> ''")
    parts = max(1, -(-(numbered.agg(F.sum(F.char_length("name"))).first()[0] or 0) // part))
    rows = passages.select("doc_id", "passage_idx", F.col("u_start").cast("long").alias("u_start"), "text")
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in ("doc_id", "passage_idx"))
    schema = f"{kept}, entity_type string, entity_idx int, name string, spans array<struct<s:int,e:int>>"
    kinds = to_arrow_schema(passages.sparkSession.createDataFrame([], schema).schema)
    found = []
    for k in range(parts):
        mine = numbered.where(F.pmod(F.xxhash64(F.lower("name")), F.lit(parts)) == k).orderBy("entity_idx").collect()
        shared = passages.sparkSession.sparkContext.broadcast(pack_names([tuple(r) for r in mine]))
        found.append(rows.mapInArrow(searcher(shared, kinds), schema))
    return reduce(DataFrame.union, found)


def drop_unfound(located: DataFrame) -> DataFrame:
    """Names without any span are made up: out."""
    return located.where(F.size("spans") > 0)


def spans_of(located: DataFrame) -> DataFrame:
    """A row for each span."""
    rows = located.select("doc_id", "passage_idx", "entity_type", "name", F.explode("spans").alias("x"))
    return rows.select("doc_id", "passage_idx", "entity_type", "name", F.col("x.s").alias("s"), F.col("x.e").alias("e"))


def overlap(spans: DataFrame, units: DataFrame, width: int = 4096) -> DataFrame:
    """spans joined with the units (doc_id, unit_idx, u_start, u_end) they overlap.

    Both sides are dealt to buckets of positions, so that a long document is no single key; a pair counts in the
    bucket where the later of the two starts, which is one of both.
    """
    bucket = lambda lo, hi: F.explode(F.sequence(F.floor(lo / width), F.floor(F.greatest(hi - 1, lo) / width)))
    a = spans.withColumn("_bucket", bucket(F.col("s"), F.col("e")))
    b = units.withColumn("_bucket", bucket(F.col("u_start"), F.col("u_end")))
    joined = a.join(b, ["doc_id", "_bucket"]).where((F.col("e") > F.col("u_start")) & (F.col("s") < F.col("u_end")))
    return joined.where(F.col("_bucket") == F.floor(F.greatest("s", "u_start") / width)).drop("_bucket")
