"""The registered queries that SQL can't express, over the smallest tables, against plain Python."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from helpers import word_list
from quillspan.llm import quality_model as qm
from quillspan.llm.queries import queries, tokenizer_path
from test_mixing import level


@pytest.fixture(scope="module")
def docs(spark, data):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{data}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids(docs):
    coder = Tokenizer.from_file(tokenizer_path())
    return {d: np.array(coder.encode(r["text"] or "", add_special_tokens=False).ids, "<u4") for d, r in docs.items()}


def run(spark, data, name):
    return queries()[name](spark, data).collect()


def test_op1(spark, data, docs):
    rows = run(spark, data, "op1_quality_classifier")
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_ridge_weights_are_those_of_a_plain_solve(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    stats = {r["doc_id"]: r["stats"] for r in qm.document_statistics(docs).collect()}
    rows = [(d, [float(x) for x in stats[d]], float(q), d % 2) for d, q in ((r["doc_id"], r["quality"]) for r in labels.collect()) if d in stats and q is not None]
    model = qm.fit(spark.createDataFrame(rows, "doc_id long, stats array<double>, label double, half int").repartition(3))
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    z = np.clip((x - x.mean(0)) / np.maximum(x.std(0), 1e-6), -6, 6)
    z = np.column_stack([np.ones(len(x)), z, np.sqrt(2 / len(model.phase)) * np.cos(z @ model.w + model.phase)])
    weights = np.linalg.solve(z.T @ z + 1e-3 * len(x) * np.eye(z.shape[1]), z.T @ y)
    assert np.allclose(z @ weights, model.raw(x), atol=1e-6)


def test_op3(spark, data, docs):
    rows = {r["doc_id"]: r for r in run(spark, data, "op3_cross_entropy_difference")}
    assert set(rows) == set(docs)
    for d, r in rows.items():
        assert r["n_words"] == len(word_list(docs[d]["text"]))
        assert r["score"] is None if not r["n_words"] else abs(r["score"] - (r["target_loss"] - r["background_loss"])) < 1e-9


def test_op4(spark, data, docs):
    rows = run(spark, data, "op4_source_mix")
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        size, source = len(word_list(docs[r["doc_id"]]["text"])), docs[r["doc_id"]]["source"]
        assert r["size"] == size and r["taken"] == size * len(r["places"]) <= 3 * size
        sizes[source] += size
        taken[source] += r["taken"]
        target[source] = r["target"]
    goal = level(sizes)
    assert all(abs(target[s] - goal[s]) < 1e-6 * max(1, goal[s]) for s in goal)
    assert sum(abs(taken[s] - goal[s]) for s in goal) <= 0.02 * sum(goal.values())


def test_op6(spark, data, docs, ids):
    rows = run(spark, data, "op6_best_fit_packing")
    expected = set()
    for d in docs:
        whole = np.append(ids[d], 0).astype("<u4")
        expected |= {(d, k // 2048, k, len(whole[k : k + 2048]), zlib.crc32(whole[k : k + 2048])) for k in range(0, len(whole), 2048)}
    assert {tuple(r)[:5] for r in rows} == expected and len(rows) == len(expected)
    filled = defaultdict(int)
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled[r["sequence_id"]]
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 2048 and len(filled) <= -(-sum(filled.values()) // 2048) + 1


def test_op10(spark, data, docs, ids):
    rows = {r["doc_id"]: tuple(r)[1:4] for r in run(spark, data, "op10_token_files")}
    start, expected = 0, {}
    for d in sorted(docs):
        whole = np.append(ids[d], 2).astype("<u4")
        expected[d] = (start, len(whole), zlib.crc32(whole))
        start += len(whole)
    assert rows == expected


def test_words_are_those_of_the_contract():
    assert word_list("a\x0bb c\td") == re.split(r"[\x20\x09-\x0D]+", "a\x0bb c\td")
