"""Learned vectors: counts and values against plain Python, the SVD against numpy's, synonyms against trigrams."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspan.functions.vectors import embed_name
from quillspan.operators import embedding


def bucket(text, n):
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % n


def pieces(word, n):
    marked = f"<{word}>"
    return {bucket(x, n) for x in [marked, *[marked[i : i + 3] for i in range(len(word))]]}


def plain(texts, window, n_pieces, n_contexts):
    counts = Counter()
    for text in texts:
        w = re.findall(r"[^\W_]+", (text or "").lower())
        for i, a in enumerate(w):
            for j in range(max(0, i - window), min(len(w), i + window + 1)):
                if i != j:
                    for p in pieces(a, n_pieces):
                        counts[p, bucket(w[j], n_contexts)] += 1
    return counts


def matrix(counts, n_pieces, n_contexts):
    n, rows, columns = sum(counts.values()), Counter(), Counter()
    for (p, c), k in counts.items():
        rows[p] += k
        columns[c] += k
    out = np.zeros((n_pieces, n_contexts))
    for (p, c), k in counts.items():
        out[p, c] = max(0, math.log(k * n / (rows[p] * columns[c])))
    return out


TEXTS = ["Leaf wax, leaf oil; root a!", "a a a a", "Ünïcode öl ist öl", "one", "", None, "  .  ", "ab ba ab b2 leaf"]


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(60)]
    texts = TEXTS + [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(80)]
    return texts, spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)


def test_counts_and_values(mixed):
    texts, df = mixed
    counts = embedding.cooccurrence(df, "text", 2, 97, 31)
    want = plain(texts, 2, 97, 31)
    assert {(r.piece, r.context): r.n for r in counts.collect()} == dict(want)
    found = np.zeros((97, 31))
    for r in embedding.mutual_information(counts).collect():
        found[r.piece, r.context] = r.ppmi
    np.testing.assert_allclose(found, matrix(want, 97, 31), atol=1e-12)


@pytest.mark.parametrize(("size", "contexts", "close"), [(31, 31, 1e-5), (6, 64, 1e-2)])
def test_singular_values_and_vectors(mixed, size, contexts, close):
    texts, df = mixed
    model = embedding.learn_vectors(df, size=size, n_pieces=97, n_contexts=contexts, rounds=8)
    u, s, _ = np.linalg.svd(matrix(plain(texts, 2, 97, contexts), 97, contexts), full_matrices=False)
    np.testing.assert_allclose(model.singular, s[:size], rtol=close, atol=1e-6)
    found = np.zeros((97, size))
    for r in model.vectors.collect():
        found[r.piece] = r.vec
    np.testing.assert_allclose(found @ found.T, u[:, :size] * s[:size] @ u[:, :size].T, atol=20 * close)


def test_synonyms_are_nearer_than_by_trigrams(spark):
    rng = random.Random(2)
    groups = [("vitamin", "tocol", "plasma blood serum"), ("wheat", "barley", "field harvest grain"), ("stem", "stalk", "green tall upright")]
    texts = []
    for _ in range(600):
        a, b, near = rng.choice(groups)
        near = near.split()
        texts.append(f"{rng.choice(near)} {rng.choice((a, b))} {rng.choice(near)} {rng.choice(near)}")
    model = embedding.learn_vectors(spark.createDataFrame([(t,) for t in texts], "text string"), size=8, n_pieces=4096, n_contexts=256)
    names = [x for a, b, _ in groups for x in (a, b)] + ["unknown", "", None]
    rows = spark.createDataFrame([(n,) for n in names], "name string").withColumn("vec", model.embedder()("name")).collect()
    vec = {r.name: r.vec for r in rows}
    for a, b, _ in groups:
        others = [x for g in groups for x in g[:2] if x not in (a, b)]
        near = np.dot(vec[a], vec[b])
        assert near > 0.8 and near > np.dot(embed_name(a), embed_name(b))
        assert near > max(np.dot(vec[a], vec[o]) for o in others)
    assert vec[None] is None and not any(vec[""])


def test_tasks_hash_as_sql_does(spark):
    names = [t for t in TEXTS if t] + ["alpha-tocopherol 2", "élan_vital", "a\u0301b"]
    rows = spark.createDataFrame([(n,) for n in names], "name string")
    found = rows.select("name", F.flatten(F.transform(embedding.words(F.col("name")), lambda w: embedding.pieces(w, 97))).alias("b")).collect()
    assert all(list(r.b) == embedding._buckets(r.name, 97) for r in found)


def test_nothing_to_learn_from(spark):
    model = embedding.learn_vectors(spark.createDataFrame([(None,), ("one",)], "text string"), size=4, n_pieces=64, n_contexts=16)
    assert model.vectors.count() == 0
    row = spark.range(1).select(model.embedder()(F.lit("one")).alias("v")).first()
    assert list(row.v) == [0.0] * 4


def test_pairs_of_words_are_not_shuffled(spark, monkeypatch):
    """What tasks pass on is bounded by the matrix, not by the words that meet; batches and full counters change nothing."""
    rng = random.Random(9)
    texts = TEXTS + [" ".join("".join(rng.choices("abcdefghijklm", k=6)) for _ in range(50)) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(40)
    counts = embedding.cooccurrence(df, "text", 2, 13, 7)
    assert {(r.piece, r.context): r.n for r in counts.collect()} == dict(plain(texts, 2, 13, 7))
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    passed = counts._jdf.queryExecution().optimizedPlan().children().head()
    assert spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, passed).count() <= 13 * 7 * spark.sparkContext.defaultParallelism


def test_texts_in_stretches():
    from quillspan.functions.words import Words, stretches

    whole, parts = np.zeros(13 * 7, np.uint32), np.zeros(13 * 7, np.uint32)
    texts = [t for t in TEXTS if t is not None]
    embedding._add_neighbours(whole, Words.of(texts), 2, 13, 7)
    for part in stretches(texts, 9):
        embedding._add_neighbours(parts, Words.of(texts[part]), 2, 13, 7)
    assert whole.sum() and (whole == parts).all()
