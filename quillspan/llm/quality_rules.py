"""Quality rules: base counts, and divergence from language references.  Built-in functions only.

Each text stays in its row: counts come from string functions and from arrays of the text's own words.  The
histograms (character classes; common words against all others) are compared with those of each language by
Jensen-Shannon distance, and the nearest language counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import SPACE, cut, word_count

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"

# The commonest function words of each language.
COMMON = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an".split(),
    "en": "the of and to in a is that it for on was be with as by this are at from or an have not".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se".split(),
}
#: One histogram cell for each of these, in the order of their bytes; a word of two languages has one cell.
VOCABULARY = sorted({w for words in COMMON.values() for w in words}, key=str.encode)
CLASSES = ["upper", "digit", "mark", "symbol", "beyond", "lower"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_cells(tokens: Column) -> Column:
    """How many of an array of tokens are each of VOCABULARY.

    With one of each added and all sorted, every word has a run, in order; a run's length less one is its count.
    """
    vocabulary = F.array(*[F.lit(w) for w in VOCABULARY])

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: ~F.get(s, i).eqNullSafe(F.get(s, i - 1)))
        return let(starts, lambda at: F.transform(at, lambda x, k: (F.coalesce(F.get(at, k + 1), F.size(s)) - x - 1).cast("long")))

    known = F.filter(tokens, lambda x: x.isin(VOCABULARY))
    return let(F.sort_array(F.concat(known, vocabulary)), runs)


def repeated_words(words: Column, n: int = 5) -> Column:
    """Words of an array within n-word windows that the array holds twice or more, the first included.

    Windows go by a 64-bit hash of their words' hashes.  Equal windows meet by sorting (hash, place); the words covered are summed over
    the places in order, so the work is a sort of the text's own windows at most.
    """

    def covered(pairs: Column) -> Column:
        def twice(x: Column, i: Column) -> Column:
            same = (F.get(pairs, i - 1)["h"] == x["h"]) | (F.get(pairs, i + 1)["h"] == x["h"])
            return F.when(same, x["at"])

        def total(places: Column) -> Column:
            gaps = F.transform(places, lambda p, i: F.least(F.lit(n), F.coalesce(F.get(places, i + 1) - p, F.lit(n))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

        return let(F.array_sort(F.array_compact(F.transform(pairs, twice))), total)

    def windows(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(pairs, covered))

    def hashed(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(h) - n)
        return let(F.transform(places, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)])), windows)

    each = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < n, F.lit(0).cast("long")).otherwise(let(each, hashed))


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the base counts and, as _rest, what is left of a text without lower case, blanks and letters
    beyond ASCII.  Null texts have no words, characters, symbols or lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return docs.withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            "n_repeat_words": repeated_words(words),
            "_rest": F.regexp_replace(text, r"[a-z\x20\x09-\x0D\x{80}-\x{10FFFF}]+", ""),
            "_bytes": F.octet_length(text) - F.char_length(text),
        }
    ).withColumn("n_symbols", F.char_length(F.regexp_replace("_rest", "[^#*$%&|<>]+", "")).cast("long"))


def histograms(counted: DataFrame, text_col: str = "text", least_words: int = 50) -> DataFrame:
    """counted with classes (characters by CLASSES) and common (words by VOCABULARY, the others last; empty for
    texts of fewer than least_words words)."""

    def kept(pattern: str) -> Column:
        return F.char_length(F.regexp_replace("_rest", pattern, "")).cast("long")

    upper, digit, mark = kept("[^A-Z]+"), kept("[^0-9]+"), kept(r"[^.,;:!?'\"()-]+")
    tokens = F.split(F.lower(F.col(text_col)), r"[^\p{L}\p{M}]+")
    common = let(word_cells(tokens), lambda c: F.concat(c, F.array(F.greatest(F.lit(0).cast("long"), F.col("n_words") - F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)))))
    out = counted.withColumns({"_upper": upper, "_digit": digit, "_mark": mark})
    symbol = F.char_length("_rest") - F.col("_upper") - F.col("_digit") - F.col("_mark")
    lower = F.greatest(F.lit(0).cast("long"), F.col("word_chars") - F.char_length("_rest") - F.col("_bytes"))
    return out.withColumns(
        {
            "classes": F.array(*[c.cast("long") for c in (F.col("_upper"), F.col("_digit"), F.col("_mark"), symbol, F.col("_bytes"), lower)]),
            "common": F.when(F.col("n_words") >= least_words, common).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop("_upper", "_digit", "_mark", "_rest", "_bytes")


def fit_references(measured: DataFrame, lang_col: str = "lang", least_docs: int = 20, least_share: float = 0.001) -> DataFrame:
    """n_docs, classes and common of each language: sums over all its documents that pass the base rules.

    A language, null is one, has a reference of its own if it has least_docs such documents and least_share of them all, so there
    are at most 1 / least_share + 1 rows; all others share one.
    """
    good = measured.where(~F.col("base_failed") & (F.size("common") > 0))
    cells = [f"a{i}" for i in range(len(CLASSES))], [f"b{i}" for i in range(len(VOCABULARY) + 1)]
    sums = [F.sum(F.get(name, F.lit(i))).alias(c) for name, of in (("classes", cells[0]), ("common", cells[1])) for i, c in enumerate(of)]
    by_lang = cut(good.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n_docs"), *sums))
    total = by_lang.agg(F.sum("n_docs")).first()[0] or 0
    own = (F.col("n_docs") >= least_docs) & (F.col("n_docs") >= total * least_share)
    pooled = by_lang.groupBy(own.alias("own"), F.when(own, F.col("lang")).alias("lang")).agg(F.sum("n_docs").alias("n_docs"), *[F.sum(c).alias(c) for c in (*cells[0], *cells[1])])
    return pooled.select("n_docs", *[F.array(*of).alias(name) for name, of in (("classes", cells[0]), ("common", cells[1]))])


def shares(h: Column) -> Column:
    """A histogram as parts of 1; null if it is empty."""
    return let(F.aggregate(h, F.lit(0.0), lambda s, x: s + x), lambda s: F.when(s > 0, F.transform(h, lambda x: x / s)))


def js_distance(a: Column, b: Column) -> Column:
    """The Jensen-Shannon distance (base 2, 0 to 1) of two histograms; null if either is empty."""
    return let(shares(a), lambda p: let(shares(b), lambda q: F.when(p.isNotNull() & q.isNotNull(), _distance(p, q))))


def _distance(p: Column, q: Column) -> Column:

    def term(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0)) + F.when(q > 0, q * F.log2(2 * q / (p + q))).otherwise(F.lit(0.0))

    total = F.aggregate(F.zip_with(p, q, term), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def nearest(histogram: Column, references: list[list[int]]) -> Column:
    """The distance of a histogram to the nearest of the references that are not empty; null without one."""
    known = [[x / sum(r) for x in r] for r in references if sum(r) > 0]
    if not known:
        return F.lit(None).cast("double")
    table = F.expr("array(" + ", ".join("array(" + ", ".join(f"{x!r}D" for x in r) + ")" for r in known) + ")")
    return let(shares(histogram), lambda p: F.when(p.isNotNull(), F.array_min(F.transform(table, lambda q: _distance(p, q)))))


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    references: DataFrame | None = None,
    least_chars: int = 200,
    least_words: int = 50,
    most_class_distance: float = 0.30,
    most_word_distance: float = 0.36,
) -> DataFrame:
    """doc_id, the base counts, base_failed, class_distance, word_distance and kept, for each row.

    A document is kept if it passes the base rules and neither distance to its nearest language exceeds its
    limit.  Texts of fewer than least_chars characters or least_words words skip the distance concerned (null):
    short histograms say little.  references: see fit_references(); by default from these documents.  Without any
    reference (an empty table, or every text short) only the base rules hold.  Repeated rows are judged each.
    """
    lean = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    measured = histograms(base_counts(lean), least_words=least_words).drop("text")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    measured = cut(measured.withColumn("base_failed", failed))
    if references is None:
        references = fit_references(measured)
    refs = references.collect()  # of a bounded number of languages: see fit_references()
    chars = F.aggregate("classes", F.lit(0).cast("long"), lambda a, x: a + x)
    judged = measured.withColumns(
        {
            "class_distance": F.when(chars >= least_chars, nearest(F.col("classes"), [r["classes"] for r in refs])),
            "word_distance": F.when(F.size("common") > 0, nearest(F.col("common"), [r["common"] for r in refs])),
        }
    )
    far = (F.coalesce("class_distance", F.lit(0.0)) > most_class_distance) | (F.coalesce("word_distance", F.lit(0.0)) > most_word_distance)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "word_distance"
    )
