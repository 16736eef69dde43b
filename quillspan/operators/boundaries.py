"""Where sentences end, learned from the texts without labels: abbreviations, words that begin sentences, and words that go together
across a full stop, each by a log-likelihood ratio of counts over all texts (Kiss and Strunk, Computational Linguistics 32, 2006).

Tasks count the tokens of whole Arrow batches, distinct ones are taken apart once; the rest is DataFrame aggregates and joins.  Nothing of the
vocabulary comes to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let, running_starts
from ..functions.words import stretches
from ..session import materialise, ship

# The thresholds of the paper.
ABBREVIATION, STARTER, COLLOCATION, SURE = 0.3, 30.0, 7.88, 0.99
EDGES = r"""^[^\p{L}\p{N}]+|[,;:!?)\]"']+$"""
GAP = r"(?<=[.!?])(\s+)(?=[A-Z(])"
SINGLE = r"^(\p{L}|\p{N}+)$"
_STRETCH = 1 << 22  # characters whose tokens are counted at once; a longer text is a stretch of its own
_SAID = regex.compile(r"[\p{L}\p{N}]")
_DOTTED = re.compile(r"""\.[,;:!?)\]"']*\Z""")


def _bare(token: Column) -> Column:
    return F.regexp_replace(token, EDGES, "")


def word_of(token: Column) -> Column:
    """A token in lower case, without what encloses it and without its full stop."""
    return F.regexp_replace(F.lower(_bare(token)), r"\.$", "")


def _counted(texts: list[str], every: bool) -> pa.RecordBatch:
    """token, dotted, after and n of some texts; tokens are as they stand there, those without a letter or digit are passed over."""
    listed = [t.encode().split() for t in texts]  # bytes: white space of ASCII, as \\s
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(t, len(number)) for w in listed for t in w), np.int64)
    row = np.repeat(np.arange(len(listed)), [len(w) for w in listed])
    names = [t.decode() for t in number]
    said = np.fromiter((_SAID.search(t) is not None for t in names), bool, len(names))
    dotted = np.fromiter((_DOTTED.search(t) is not None for t in names), bool, len(names))
    kept = said[ids]
    ids, row = ids[kept], row[kept]
    after = np.full(len(ids), -1, np.int64)
    after[:-1] = np.where(row[1:] == row[:-1], ids[1:], -1)
    if not every:
        after[~dotted[ids]] = -1
    keys, n = np.unique(ids * (len(names) + 1) + after + 1, return_counts=True)
    token, after = keys // (len(names) + 1), keys % (len(names) + 1) - 1
    named = pa.array(names, pa.string())
    columns = [named.take(pa.array(token)), pa.array(dotted[token]), named.take(pa.array(after, mask=after < 0)), pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["token", "dotted", "after", "n"])


def neighbours(texts: DataFrame, column: str = "text", every: bool = True) -> DataFrame:
    """word, dotted (a full stop follows it), after (the next word, null at a text's end) and n, over all texts.

    every: whether each word has its next; else ``after`` is null where no full stop is between, which leaves about as many rows as words.
    """

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            listed = frame.column(0).to_pylist()
            for part in stretches(listed, _STRETCH):
                yield _counted(listed[part], every)

    ship(texts.sparkSession)
    met = texts.where(F.col(column).isNotNull()).select(F.col(column).cast("string")).mapInArrow(count, "token string, dotted boolean, after string, n long")
    words = met.select(word_of(F.col("token")).alias("word"), "dotted", word_of(F.col("after")).alias("after"), "n")
    return words.groupBy("word", "dotted", "after").agg(F.sum("n").alias("n"))


def _log_chance(k: Column, n: Column, p: Column) -> Column:
    """The log chance of k of n at probability p, without the factor that ratios lose."""
    part = lambda k, p: F.when(k > 0, k * F.log(p)).otherwise(0.0)
    return part(k, p) + part(n - k, 1 - p)


def likelihood_ratio(a: Column, b: Column, ab: Column, n: Column) -> Column:
    """How much more likely ``ab`` meetings are if b depends on a (Dunning's ratio): a and b of n times in all."""
    a, b, ab, n = (x.cast("double") for x in (a, b, ab, n))
    p, p1, p2 = b / n, ab / a, F.when(n > a, (b - ab) / (n - a)).otherwise(0.0)
    return 2 * (_log_chance(ab, a, p1) + _log_chance(b - ab, n - a, p2) - _log_chance(ab, a, p) - _log_chance(b - ab, n - a, p))


def abbreviation_scores(pairs: DataFrame) -> DataFrame:
    """word, n, n_dotted and score of the words that a full stop follows at least once; from ABBREVIATION on they are abbreviations.

    The ratio of "nearly always dotted" to "dotted as all words are", times the inner full stops and one, less for length and for each time
    it stands without.  Numbers are none.
    """
    words = pairs.groupBy("word").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("dotted"), F.col("n")).otherwise(0)).alias("n_dotted"))
    total = pairs.agg((F.sum(F.when(F.col("dotted"), F.col("n")).otherwise(0)) / F.sum("n")).alias("p"))  # one row
    k, n = F.col("n_dotted").cast("double"), F.col("n").cast("double")
    ratio = 2 * (_log_chance(k, n, F.lit(SURE)) - _log_chance(k, n, F.col("p")))
    stops = F.char_length(F.regexp_replace("word", r"[^.]", ""))
    letters = (F.char_length("word") - stops).cast("double")
    score = ratio * F.exp(-letters) * (stops + 1) * F.pow(letters, -(n - k))
    return words.where(F.col("n_dotted") > 0).where(~F.rlike("word", F.lit(r"^\p{N}"))).join(F.broadcast(total)).select("word", "n", "n_dotted", score.alias("score"))


@dataclass
class Boundaries:
    abbreviations: DataFrame  # word, n, n_dotted, score
    starters: DataFrame  # word, n, n_starts, ratio
    collocations: DataFrame  # word, after, n, ratio


def learn_boundaries(texts: DataFrame, column: str = "text") -> Boundaries:
    """Counts all texts once (null ones have nothing) and keeps what passes the thresholds; each table is written."""
    pairs = materialise(neighbours(texts, column, every=False))
    abbreviations = materialise(abbreviation_scores(pairs).where(F.col("score") >= ABBREVIATION))
    return Boundaries(abbreviations, materialise(starters(pairs, abbreviations)), materialise(collocations(pairs, abbreviations)))


def _ends(pairs: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """Dotted words with ``short``: whether the stop may be an abbreviation's or a number's; else it ends a sentence."""
    known = abbreviations.select("word", F.lit(True).alias("_short"))
    short = F.coalesce("_short", F.lit(False)) | F.rlike("word", F.lit(SINGLE))
    return pairs.where("dotted AND after IS NOT NULL").join(known, "word", "left").withColumn("short", short).drop("_short")


def starters(pairs: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """Words that follow sure ends of sentences more often than they follow other words."""
    after = _ends(pairs, abbreviations).where("NOT short").groupBy(F.col("after").alias("word")).agg(F.sum("n").alias("n_starts"))
    ends = after.agg(F.sum("n_starts").alias("n_ends"))  # one row, as the next
    total = pairs.agg(F.sum("n").alias("n_all"))
    words = pairs.groupBy("word").agg(F.sum("n").alias("n"))
    rows = after.join(words, "word").join(F.broadcast(ends)).join(F.broadcast(total))
    more = F.col("n_starts") * F.col("n_all") > F.col("n_ends") * F.col("n")
    ratio = likelihood_ratio(F.col("n_ends"), F.col("n"), F.col("n_starts"), F.col("n_all"))
    return rows.where(more).select("word", "n", "n_starts", ratio.alias("ratio")).where(F.col("ratio") >= STARTER)


def collocations(pairs: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """Pairs of a short dotted word or number and the word after it that meet more often than chance, twice at least."""
    met = _ends(pairs, abbreviations).where("short").groupBy("word", "after").agg(F.sum("n").alias("n")).where("n > 1")
    words = pairs.groupBy("word").agg(F.sum("n").alias("n_word"))
    total = pairs.agg(F.sum("n").alias("n_all"))
    rows = met.join(words, "word").join(words.select(F.col("word").alias("after"), F.col("n_word").alias("n_after")), "after").join(F.broadcast(total))
    more = F.col("n").cast("double") * F.col("n_all") > F.col("n_word").cast("double") * F.col("n_after")
    ratio = likelihood_ratio(F.col("n_word"), F.col("n_after"), F.col("n"), F.col("n_all"))
    return rows.where(more).select("word", "after", "n", ratio.alias("ratio")).where(F.col("ratio") >= COLLOCATION)


def split_sentences(passages: DataFrame, model: Boundaries) -> DataFrame:
    """passages with sentences, array<struct<s, text>>: their places in the passage's text; null for a null text.

    A gap is white space after . ! or ? and before a capital or a bracket.  After a full stop it is none if the words on its sides are a
    collocation, or if the word before is an abbreviation or single letter and the one after does not begin sentences.  Gaps depend on the text
    alone: they are asked about in small rows, of which few are left once the words before them are known to be short.
    """
    parts = F.split(F.regexp_replace("text", GAP, "$1\x01"), "\x01")
    rows = passages.withColumn("_text", F.sha2("text", 256))
    last = lambda p: F.regexp_extract(p, r"(?<!\S)(\S++)\s*+$", 1)
    next_of = lambda i: F.regexp_extract(F.get("parts", i + 1), r"^\S+", 0)
    gaps = F.transform(F.slice("parts", 1, F.size("parts") - 1), lambda p, i: F.struct(i.alias("i"), last(p).alias("before"), next_of(i).alias("after")))
    cut = rows.select("_text", parts.alias("parts")).where(F.size("parts") > 1)
    asked = cut.select("_text", F.explode(F.filter(gaps, lambda x: F.contains(x["before"], F.lit(".")))).alias("x")).select("_text", "x.*")
    asked = asked.where(F.endswith(_bare(F.col("before")), F.lit("."))).select("_text", "i", word_of(F.col("before")).alias("word"), word_of(F.col("after")).alias("after"))
    short = model.abbreviations.select("word", F.lit(True).alias("short"))
    starts = model.starters.select(F.col("word").alias("after"), F.lit(True).alias("starts"))
    bound = model.collocations.select("word", "after", F.lit(True).alias("bound"))
    told = asked.join(short, "word", "left").where(F.col("short") | F.rlike("word", F.lit(SINGLE)))  # others are neither abbreviations nor in collocations
    told = told.join(starts, "after", "left").join(bound, ["word", "after"], "left")
    inner = told.where("bound OR ((short OR word RLIKE '^\\\\p{L}$') AND starts IS NULL)")
    none = inner.groupBy("_text").agg(F.collect_set("i").alias("_none"))  # gaps of one text
    ends = F.coalesce("_none", F.array().cast("array<int>"))
    joined = let(parts, lambda p: F.array_join(F.transform(p, lambda x, i: F.when((i < F.size(p) - 1) & ~F.array_contains(ends, i), F.concat(x, F.lit("\x01"))).otherwise(x)), ""))
    at = lambda p: running_starts(F.transform(p, lambda x: F.char_length(x)))
    whole = let(F.split(joined, "\x01"), lambda p: F.zip_with(at(p), p, lambda s, x: F.struct(s.alias("s"), F.regexp_replace(x, r"\s+$", "").alias("text"))))
    return rows.join(none, "_text", "left").withColumn("sentences", F.when(F.col("text").isNotNull(), whole)).drop("_text", "_none")
