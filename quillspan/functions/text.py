"""Text functions as column expressions: spans of literal names, sentences, folding, cleaning."""

from __future__ import annotations

import html
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SENTENCE_GAP = r"(?<=[.!?])\s+(?=[A-Z(])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_ascii(x: Column) -> Column:
    """A-Z to a-z and nothing else: how the reference tables compare without case."""
    return F.translate(x, UPPER, LOWER)


def running_starts(lengths: Column, gap: int = 0) -> Column:
    """Where each piece starts if pieces of these lengths follow each other with a gap between."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    step = lambda a, n: F.struct((a["at"] + n + F.lit(gap)).alias("at"), F.array_append(a["out"], a["at"]).alias("out"))
    return F.aggregate(lengths, start, step, lambda a: a["out"])


def name_pattern(name: Column, ascii_text: bool = False) -> Column:
    """The name as a literal without case; whole words only if it has neither a space nor a parenthesis.

    ascii_text: for texts of ASCII alone, where plain case and word borders say the same and are found faster.
    """
    literal = F.concat(F.lit("\\Q"), F.replace(name, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    loose, word = ("(?i)", "(?i)") if ascii_text else ("(?iu)", "(?iuU)")
    return F.when(name.contains(" ") | name.contains("("), F.concat(F.lit(loose), literal)).otherwise(F.concat(F.lit(word + "\\b"), literal, F.lit("\\b")))


def find_spans(text: Column, name: Column, offset: Column, lowered: Column | None = None) -> Column:
    """All places of name in text, as array<struct<s, e>> counted from offset.  lowered: the text in lower case, if
    it is at hand.

    The pattern is a literal, and case folding here maps single characters, so each match is as long as the
    name: matches start where the pieces between them end.
    """

    def spans(pieces: Column) -> Column:
        start = F.struct(offset.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))

        def step(a: Column, piece: Column) -> Column:
            end = (a["at"] + F.char_length(piece) + F.char_length(name)).cast("int")
            return F.struct(end.alias("at"), F.array_append(a["out"], end).alias("out"))

        ends = F.aggregate(F.slice(pieces, 1, F.size(pieces) - 1), start, step, lambda a: a["out"])
        return F.transform(ends, lambda e: F.struct((e - F.char_length(name)).cast("int").alias("s"), e.alias("e")))

    none = F.array().cast("array<struct<s:int,e:int>>")
    plain = F.octet_length(text) == F.char_length(text)
    pieces = F.when(plain, F.split(text, name_pattern(name, True), -1)).otherwise(F.split(text, name_pattern(name), -1))
    found = let(pieces, lambda p: F.when(F.size(p) > 1, spans(p)).otherwise(none))
    return F.when((F.char_length(name) > 0) & F.contains(F.lower(text) if lowered is None else lowered, F.lower(name)), found).otherwise(none)


def sentences(text: Column) -> Column:
    """array<struct<s, text>>: sentences with their true places in the text."""
    cut = F.split(F.regexp_replace(text, r"(?<=[.!?])(\s+)(?=[A-Z(])", "$1\x01"), "\x01")
    return let(
        cut,
        lambda parts: let(
            running_starts(F.transform(parts, lambda p: F.char_length(p))),
            lambda at: F.transform(parts, lambda p, i: F.struct(F.get(at, i).alias("s"), F.regexp_replace(p, r"\s+$", "").alias("text"))),
        ),
    )


def sentence_spans(text: Column, start: Column) -> Column:
    """array<struct<s, e>> of the sentences within a unit; every gap counts as one character, as ranking takes it."""
    return let(
        F.split(text, SENTENCE_GAP),
        lambda parts: let(
            running_starts(F.transform(parts, lambda p: F.char_length(p)), 1),
            lambda at: F.transform(parts, lambda p, i: F.struct((start + F.get(at, i)).cast("int").alias("s"), (start + F.get(at, i) + F.char_length(p)).cast("int").alias("e"))),
        ),
    )


def sentence_of(position: Column, spans: Column) -> Column:
    """The index of the first span that holds the position, else of the last one."""
    inside = F.array_position(F.transform(spans, lambda x: (x["s"] <= position) & (position < x["e"])), True)
    return F.when(inside > 0, inside.cast("int") - 1).otherwise(F.greatest(F.size(spans) - 1, F.lit(0)))


def strip_tags(x: Column) -> Column:
    return F.regexp_replace(x, "<[^>]+>", "")


def strip_trailing_parenthesis(x: Column) -> Column:
    return F.regexp_replace(x, r"\s*\([^)]*\)$", "")


@F.pandas_udf(T.StringType())
def unescape(x: pd.Series) -> pd.Series:
    """HTML entities decoded; there is no built-in for the named ones."""
    return x.map(html.unescape, na_action="ignore")


def clean_name(x: Column) -> Column:
    """A pathway name without entities and tags."""
    return F.trim(strip_tags(unescape(x)))


def clean_synonym(x: Column) -> Column:
    """The text of an OBO synonym line, between its first two quotes, without a trailing parenthesis."""
    quoted = F.get(F.split(x, '"'), F.lit(1))
    return F.trim(strip_trailing_parenthesis(F.trim(unescape(F.coalesce(quoted, x)))))
