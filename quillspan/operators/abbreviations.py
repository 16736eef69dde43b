"""Abbreviations that a text defines in parentheses, by alignment with the words before."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Words that an abbreviation may skip.
SKIPPED = {"and", "for", "in", "of", "the", "an"}
_TOKEN = re.compile(r"\w+(?:[-'’]\w+)*|[^\w\s]")
_STOP = ".!?"
LONGEST_SHORT, LOOK_BACK = 10, 5


def is_short_form(text: str) -> bool:
    """1 to 10 characters that start with a letter; with one or two there must be a capital."""
    if not 1 <= len(text) <= LONGEST_SHORT or not text[0].isalpha():
        return False
    return len(text) > 2 or any(c.isupper() for c in text)


def _consume(short: str, words: list[str]) -> int | None:
    """The score of reading the short form's letters in order out of the words: 2 for a word's first letter, else 1."""
    left, points = iter(short), 0
    want = next(left, None)
    for k, word in enumerate(words):
        if want is None:
            break
        if k and word in SKIPPED:
            continue
        for place, letter in enumerate(word):
            if letter == want:
                points += 1 if place else 2
                want = next(left, None)
                if want is None:
                    break
    return points if want is None else None


def align(words: list[str], short: str) -> int | None:
    """Where in words the long form of short starts: the first start with the best score, which is at least one a
    letter, at a word with the same first letter; None without one."""
    letters = "".join(short.lower().split())
    lower = [w.lower() for w in words]
    scores = {i: _consume(letters, lower[i:]) for i, w in enumerate(lower) if letters and w[0] == letters[0]}
    good = {i: s for i, s in scores.items() if s is not None and s >= len(letters)}
    return min(good, key=lambda i: (-good[i], i)) if good else None


def _borders(words: list[str], starts: set[int]) -> list[tuple[int, int]]:
    """For each number of words the nearest border among them and where a long form after it begins; (-1, -1) without one.

    A title word, a number and a sentence's first word are borders and begin it; after a mark the next word does.
    """
    out = [(-1, -1)]
    for i, word in enumerate(words):
        begins = i in starts or word.isdigit() or word.istitle()
        out.append((i, i) if begins else (i, i + 1) if not word[0].isalnum() else out[-1])
    return out


def _span(words: list[str], starts: set[int], borders: list[tuple[int, int]], opening: int, inner: int) -> range:
    """The words before a parenthesis that may spell out what its ``inner`` words abbreviate: from the nearest border
    within reach, without a single capital in front; empty without such a border."""
    border, first = borders[opening]
    if border < max(0, opening - inner - LOOK_BACK):
        return range(0)
    lone = opening - first > 1 and first not in starts and len(words[first]) == 1 and words[first].isupper()
    return range(first + lone, opening)


def definitions(text: str) -> dict[str, str]:
    """short: long for each definition in a text, the first of each short form."""
    tokens = list(_TOKEN.finditer(text))
    marks = [t.group() for t in tokens]
    starts = {i for i in range(len(tokens)) if i == 0 or marks[i - 1] in _STOP}
    borders = _borders(marks, starts)
    found: dict[str, str] = {}
    for opening in (i for i, m in enumerate(marks) if m == "("):
        for closing in (i for i in range(opening + 2, min(len(marks), opening + 2 + 2 * LONGEST_SHORT)) if marks[i] == ")"):
            short = text[tokens[opening + 1].start() : tokens[closing - 1].end()]
            span = _span(marks, starts, borders, opening, closing - opening - 1)
            if short in found or not span or not is_short_form(short):
                continue
            at = align([marks[i] for i in span], short)
            if at is not None:
                long = text[tokens[span[at]].start() : tokens[span[-1]].end()]
                if len(long) > len(short):
                    found[short] = long
    return found


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (doc, passage, short, long)
            for doc, passage, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "passage_idx", "text")), strict=True)
            if text and "(" in text
            for short, long in definitions(text).items()
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = [batch.schema.field("doc_id").type, pa.int32(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "passage_idx", "short", "long"])


def detect(passages: DataFrame) -> DataFrame:
    """doc_id, short and long of the abbreviations of each document; of several definitions the last passage's."""
    kind = dict(passages.dtypes)["doc_id"]
    rows = passages.select("doc_id", "passage_idx", "text").where(F.contains("text", F.lit("(")))
    each = rows.mapInArrow(_detect, f"doc_id {kind}, passage_idx int, short string, long string")
    return each.groupBy("doc_id", "short").agg(F.max_by("long", "passage_idx").alias("long"))
