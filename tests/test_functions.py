import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspan.functions import text as tx
from quillspan.functions.vectors import cosine, embed_name, embedder

NAMES = ["the", "of the", "a.b", "x(y)", "é", "The", "(", "\\E", "aa", "$", "ab\\Ec"]


def spans(text, name, offset):
    literal = re.escape(name)
    pattern = literal if " " in name or "(" in name else rf"\b{literal}\b"
    return [(offset + m.start(), offset + m.end()) for m in re.finditer(pattern, text, re.IGNORECASE)]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="theTHEof ab.x(y)é\\E$,\n", max_size=50), min_size=1, max_size=8))
def test_spans_are_those_of_the_pattern(spark, texts):
    texts = [*texts, "The, of the the a.b x(y) (x(y)) é été É THE", "aaaa aa", "ab\\Ec \\E $ $$"]
    rows = [(t, n, 7) for t in texts for n in NAMES]
    df = spark.createDataFrame(rows, "text string, name string, at int")
    for r in df.select("*", tx.find_spans(F.col("text"), F.col("name"), F.col("at")).alias("x")).collect():
        assert [tuple(s) for s in r["x"]] == spans(r["text"], r["name"], 7), (r["text"], r["name"])


def test_spans_of_empty_names_and_nulls(spark):
    df = spark.createDataFrame([("a", ""), (None, "a"), ("a", None)], "text string, name string")
    assert [len(r["x"]) for r in df.select(tx.find_spans(F.col("text"), F.col("name"), F.lit(0)).alias("x")).collect()] == [0, 0, 0]


GAP = re.compile(r"(?<=[.!?])\s+(?=[A-Z(])")


@pytest.mark.parametrize("text", ["One. Two!  Three? four. (Five).  \n Six", "", "no end", "A. B. C.", "x.y. Z "])
def test_sentences(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(tx.sentences(F.col("t")).alias("s"), tx.sentence_spans(F.col("t"), F.lit(10)).alias("u")).first()
    pieces = GAP.split(text)
    assert [x["text"] for x in row["s"]] == [p.rstrip() for p in pieces]
    assert all(text[x["s"] : x["s"] + len(x["text"])] == x["text"] for x in row["s"])
    at, expected = 10, []
    for p in pieces:
        expected.append((at, at + len(p)))
        at += len(p) + 1
    assert [tuple(x) for x in row["u"]] == expected


def test_sentence_of(spark):
    spans_ = F.array(*[F.struct(F.lit(a).alias("s"), F.lit(b).alias("e")) for a, b in ((0, 5), (6, 9), (10, 12))])
    got = spark.range(1).select(*[tx.sentence_of(F.lit(p), spans_).alias(f"p{p}") for p in (0, 4, 5, 8, 11, 99)]).first()
    assert list(got) == [0, 0, 2, 1, 2, 2]


def test_cleaning(spark):
    df = spark.createDataFrame([("a &amp; <i>b</i> &alpha;", '"some name (exact)" EXACT []'), (None, None), ("x", "plain (y)")], "n string, s string")
    got = [tuple(r) for r in df.select(tx.clean_name(F.col("n")), tx.clean_synonym(F.col("s")), tx.fold_ascii(F.col("n"))).collect()]
    assert got == [("a & b α", "some name", "a &amp; <i>b</i> &alpha;"), (None, None, None), ("x", "plain", "x")]
    assert spark.range(1).select(tx.fold_ascii(F.lit("ÄBc"))).first()[0] == "Äbc"


def test_vectors(spark):
    a, b = embed_name("salicylic acid"), embed_name("Salicylic Acid")
    assert (a == b).all() and abs(np.linalg.norm(a) - 1) < 1e-6
    df = spark.createDataFrame([("salicylic acid", [3.0, 4.0], [4.0, 3.0]), (None, [0.0, 0.0], [1.0, 0.0])], "n string, x array<float>, y array<float>")
    rows = df.select(embedder()("n").alias("v"), cosine(F.col("x"), F.col("y")).alias("c")).collect()
    assert np.allclose(rows[0]["v"], a) and rows[1]["v"] is None and abs(rows[0]["c"] - 0.96) < 1e-6 and rows[1]["c"] is None
