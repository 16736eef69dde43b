import re
import zlib

import numpy as np
import pytest

from quillspan.llm import toxicity as tx
from quillspan.llm.queries import queries


def spelled(text):
    """Words and their beginnings of some bytes, in plain Python."""
    out = set()
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    for w in re.findall(rb"[0-9A-Za-z\x80-\xff]+", raw):
        out |= {(0, w)} | {(n, w[:n]) for n in tx.BEGINNINGS if len(w) > n}
    return out


def packed(texts):
    raw = [(t or "").encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_grams_are_those_of_plain_python():
    texts = ["Pathetic, PATHETIC idiotisch! élan", "", "x1 y " + "long" * 70_000 + " é" * 9, "abcd abcde", "abcd", "end"]
    found = [set() for _ in texts]
    for doc, h in tx.grams(*packed(texts)):
        for d, x in zip(doc.tolist(), h.tolist(), strict=True):
            found[d].add(x)
    plain = [spelled(t) for t in texts]
    assert [len(x) for x in found] == [len(x) for x in plain]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(found[i] & found[j]) == len(plain[i] & plain[j])


def test_features_of_texts():
    texts = ["alpha beta", "gamma alphabet", "", "beta beta"]
    names = {}
    for t in ("alpha", "beta", "gamma"):
        names[t] = int(next(tx.grams(*packed([t])))[1][0])
    features = tx.Features(np.sort(np.array(list(names.values()), np.uint64)))
    got = {(d, int(features.keys[a])) for d, a in zip(*features.of(*packed(texts)), strict=True)}
    assert got == {(0, names["alpha"]), (0, names["beta"]), (1, names["gamma"]), (3, names["beta"])}
    assert [len(x) for x in tx.Features(np.zeros(0, np.uint64)).of(*packed(texts))] == [0, 0]


def test_training_goes_down_the_corrected_risk_and_not_below_zero():
    rng = np.random.default_rng(5)
    prior, n = 0.2, 4000
    toxic = rng.random(n) < prior
    x = rng.random((n, 6)) < np.where(toxic[:, None], [0.9, 0.6, 0.3, 0.3, 0.3, 0.3], [0.05, 0.2, 0.3, 0.3, 0.3, 0.3])
    sparse = lambda m: (*np.nonzero(m), len(m))
    w = tx.train(sparse(x[toxic][:300]), sparse(x), 6, prior)
    f = x @ w[:-1] + w[-1]
    plain = np.log(prior / (1 - prior)) + sum(np.where(x[:, j], np.log(p / q), np.log((1 - p) / (1 - q))) for j, (p, q) in enumerate([(0.9, 0.05), (0.6, 0.2)]))
    assert np.mean((f > 0) == (plain > 0)) > 0.98  # the rule that knows both densities
    assert tx.risk(f[toxic], f, prior)[1] > -0.01
    before = sum(tx.risk(np.full(300, np.log(0.25)), np.full(n, np.log(0.25)), prior))
    assert sum(tx.risk(f[toxic], f, prior)) < before


def test_the_correction_holds_overfitting_back():
    """Every row has a feature of its own: the plain risk would go far below zero."""
    n, prior = 60, 0.5
    rows = np.arange(n)
    w = tx.train((rows, rows, n), (rows, rows + n, n), 2 * n, prior, steps=600, ridge=0.0)
    corrected = tx.risk(w[:n] + w[-1], w[n:-1] + w[-1], prior)[1]
    assert corrected > -0.3


def test_held_out_documents(spark):
    data = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    rows = queries()["op13_toxicity"](spark, data).collect()
    assert len(rows) == 10_000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert sum(b for a, b in held if a) / sum(a for a, _ in held) > 0.85
    assert sum(b for a, b in held if not a) / sum(not a for a, _ in held) < 0.02


def test_held_out_labels_do_not_matter(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = ({r["doc_id"]: r["score"] for r in tx.classify(docs, x).collect()} for x in (labels, flipped))
    assert max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 3), (None, "awful", 3), (4, "awful " * 50_000, 3), (4, "again", 3), (6, "awful", 1)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r["score"] for r in tx.classify(docs, none).collect()] == [0.0] * 6
    one = spark.createDataFrame([(1, 0), (2, None), (4, 1), (6, 1), (None, 1), (6, 1)], "doc_id long, toxic int")
    rows = tx.classify(docs, one, least_docs=1).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert tx.classify(docs.limit(0), one).count() == 0
    assert [r["score"] for r in tx.classify(docs, spark.createDataFrame([(99, 1)], "doc_id long, toxic int")).collect()] == [0.0] * 6


def test_bound_of_fitted_rows_keeps_the_prior(spark):
    docs = spark.createDataFrame([(i, "bad vile text here" if i % 10 == 0 else f"good kind text{i % 7} here") for i in range(1, 2000)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "CAST(doc_id % 10 = 0 AS INT) AS toxic").where("doc_id % 3 = 0")
    rows = tx.classify(docs, labels, most_rows=60, least_docs=2).collect()
    assert np.mean([r["predicted"] == (r["doc_id"] % 10 == 0) for r in rows]) > 0.99
    assert pytest.approx(1, abs=0.5) == max(r["score"] for r in rows)
