"""Learned relations: weights against Newton's method, held-out pairs against the cues, calibration, the judge."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspan.operators import evaluation, relation_model
from quillspan.operators.providers import cue_predictor
from quillspan.schemas import NO_RELATION

# Sentences of the tests; S and O are the names.
SAID = {
    "made_in": ["S is synthesised within O", "cells of O build S", "S is produced by leaves, in O only"],
    "degraded_by": ["O breaks down S", "S is cleaved when O is there", "S vanishes where O is active"],
    "accumulates_in": ["S builds up in O", "O stores S", "much S is kept in O"],
    NO_RELATION: ["S and O were bought", "neither S nor O was found in regulated plots", "O was weighed after S"],
}
KINDS = "id long, context string, subj string, obj string, category string, actual string"


def made_up(rng, n):
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(3, 7)))
    out = []
    for i in range(n):
        actual = rng.choice(list(SAID))
        s, o = word(), word()
        said = " ".join({"S": s, "O": o}.get(w, w) for w in rng.choice(SAID[actual]).replace(",", " ,").split())
        out.append((i, f"{word()} {said} {word()}", s, o, "genes", actual))
    return out


@pytest.fixture(scope="module")
def learned(spark):
    odd = [(None, None, None, None, None, "made_in"), (1, "x", "", "x", "genes", None), (2, "", "a", "b", "genes", NO_RELATION)]
    gold = spark.createDataFrame(made_up(random.Random(1), 400) + odd, KINDS).repartition(3)
    return relation_model.learn_relations(gold, n=1 << 12)


def newton(rows, labels, n, l2):
    k = len(labels)
    x, y = np.zeros((len(rows), n)), np.zeros((len(rows), k))
    for i, (_, context, s, o, _, actual) in enumerate(rows):
        x[i, relation_model.buckets(list(relation_model.features(context, s, o)), n)] = 1
        y[i, labels.index(actual)] = 1
    w = np.zeros((n, k))
    for _ in range(30):
        p = np.exp(x @ w)
        p /= p.sum(1, keepdims=True)
        g = (x.T @ (p - y) + l2 * w).ravel()
        h = np.zeros((n, k, n, k))
        for a in range(k):
            for b in range(k):
                h[:, a, :, b] = x.T @ (x * (p[:, a] * ((a == b) - p[:, b]))[:, None])
        w -= np.linalg.solve(h.reshape(n * k, n * k) + l2 * np.eye(n * k), g).reshape(n, k)
    p = np.exp(x @ w)
    return w, l2 / 2 * (w**2).sum() - (y * np.log(p / p.sum(1, keepdims=True))).sum()


def test_against_newton(spark):
    import zlib

    rows = made_up(random.Random(4), 120)
    model = relation_model.learn_relations(spark.createDataFrame(rows, KINDS).repartition(4), l2=0.5, rounds=300, n=48, tolerance=1e-9)
    fitted = [r for r in rows if zlib.crc32(r[1].encode()) % 5]
    assert 60 < len(fitted) < 120
    w, loss = newton(fitted, model.labels, 48, 0.5)
    np.testing.assert_allclose(model.weights, w, atol=1e-5)
    assert model.loss == pytest.approx(loss)


def macro_f1(found):
    outcomes = found.select("actual", F.col("predicate").alias("predicted"))
    return evaluation.class_metrics(evaluation.confusion(outcomes)).agg(F.avg("f1")).first()[0]


def test_held_out_pairs_and_their_probabilities(spark, learned):
    pairs = spark.createDataFrame(made_up(random.Random(2), 300), KINDS).repartition(2)
    found = learned.answers(pairs)
    assert macro_f1(found) > 0.9 > 0.5 > macro_f1(cue_predictor()(pairs))
    rows = found.collect()
    right = np.mean([r.predicate == r.actual for r in rows])
    assert abs(np.mean([r.probability for r in rows]) - right) < 0.1
    assert all(r.justification in r.context for r in rows)


def test_allowed_and_odd_rows(spark, learned):
    odd = [(1, None, None, None, None, None), (2, "", "", "", "genes", None), (3, "ab is synthesised within cd " * 3000, "ab", "cd", "genes", None), (3, "cd breaks down ab", "ab", "cd", "species", None)]
    pairs = spark.createDataFrame([*odd, odd[2]], KINDS).withColumn("probability", F.lit("x"))
    found = learned.predictor({"genes": ["degraded_by"], "pathways": []})(pairs).collect()
    assert len(found) == 5 and {r.predicate for r in found if r.category == "genes"} <= {"degraded_by", NO_RELATION}
    assert [r.predicate for r in found if r.category == "species"] == ["degraded_by"]
    assert learned.answers(pairs.limit(0)).count() == 0


def test_judge(spark, learned):
    rows = [(1, "ab builds up in cd", "ab", "cd", "accumulates_in"), (2, "ab builds up in cd", "ab", "cd", "degraded_by"), (3, "ab builds up in cd", "ab", "cd", "unheard_of"), (4, "x", "ab", "cd", None)]
    told = spark.createDataFrame(rows, "id int, context string, subj string, obj string, predicate string")
    assert {r.id: r.decision for r in learned.judge()(told).collect()} == {1: "yes", 2: "no", 3: "no", 4: "no"}
    assert {r.decision for r in learned.judge(1.1)(told).collect()} == {"no"}


def test_without_gold(spark):
    model = relation_model.learn_relations(spark.createDataFrame([], KINDS), n=64)
    pairs = spark.createDataFrame(made_up(random.Random(3), 3), KINDS)
    assert {r.predicate for r in model.answers(pairs).collect()} == {NO_RELATION}


def test_features_of_whole_batches():
    """Buckets and justifications of many pairs at once are those of single pairs."""
    rng = random.Random(7)
    odd = [(None, None, None), ("", "", ""), ("İİ x İ y", "İ", "x"), ("Öl öl ÖL, ß2 ﬁ 9 𝔘𝔫𝔡", "öl", "𝔫"), ("a" * 500 + " b", "b", "a"), ("ab ab abab", "ab", "bab"), ("s o S O", "o", "s"), ("x\ny", "x", "x"), ("...", "x", ".")]
    pairs = odd + [tuple(r[1:4]) for r in made_up(rng, 200)] + [(" ".join(rng.choices(["ab", "cd", "é", "ab-cd", "the"], k=rng.randint(0, 9))), rng.choice(["ab", "cd", "a", ""]), rng.choice(["ab-cd", "é", "d"])) for _ in range(300)]
    h = relation_model.Hashed.of(*map(list, zip(*pairs, strict=True)), 1 << 15)
    for i, pair in enumerate(pairs):
        named = relation_model.features(*pair)
        assert h.all_at[h.all_row == i].tolist() == sorted(set(relation_model.buckets(list(named), 1 << 15).tolist()))
        said = {}
        for j in np.flatnonzero(h.row == i):
            said.setdefault(int(h.at[j]), h.said(j))
        want = {}
        for key, text in named.items():
            if text:
                want.setdefault(int(relation_model.buckets([key], 1 << 15)[0]), text)
        assert said == want


def test_sums_do_not_grow_with_the_partitions(spark, monkeypatch):
    parts, add = [], relation_model.partition_sum
    monkeypatch.setattr(relation_model, "partition_sum", lambda rows, *a: parts.append(rows.rdd.getNumPartitions()) or add(rows, *a))
    relation_model.learn_relations(spark.createDataFrame(made_up(random.Random(3), 90), KINDS).repartition(60), n=64, rounds=2)
    assert max(parts) <= spark.sparkContext.defaultParallelism
