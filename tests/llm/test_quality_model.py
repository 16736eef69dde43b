import zlib

import numpy as np
import pytest

from quillspan.llm import quality_model as qm


def test_isotonic_is_the_best_rising_fit():
    at, y, w = np.arange(6.0), np.array([0, 1, 0, 0.5, 0.2, 1.0]), np.array([1, 1, 3, 1, 1, 2.0])
    places, values = qm.isotonic(at, y, w)
    assert (np.diff(values) > 0).all() and (np.diff(places) > 0).all()
    assert np.allclose(values, [0, 0.25, 0.35, 1.0])


def test_statistics_are_of_each_text_alone():
    texts = ["The house of THE man. The house!", "", "a b a b\n\na b a b", "x" * 5000, "é ü 12 #$"]
    raw = [t.encode() for t in texts]
    all_at_once = qm.statistics(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for t, row in zip(raw, all_at_once, strict=True):
        alone = qm.statistics(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0]
        assert np.allclose(alone, row)
    name = dict(zip(qm.NAMES, all_at_once.T, strict=True))
    assert name["empty"].tolist() == [0, 1, 0, 0, 0]
    assert name["repeated_lines"][2] == 0.5 and name["distinct_words"][2] == 0.25
    assert name["common_words"][0] == pytest.approx(4 / 7)


def test_kernel_is_approximated():
    rng = np.random.default_rng(0)
    d = len(qm.NAMES)
    model = qm.Model(np.zeros(d), np.ones(d), features=4096)
    x = rng.normal(0, 0.5, (20, d))
    z = model.features(x)[:, 1 + d :]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * d))
    assert np.abs(z @ z.T - exact).max() < 0.1


def test_held_out_accuracy(spark, data):
    docs, labels = (spark.read.parquet(f"{data.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    rows = qm.classify(docs, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_held_out_labels_do_not_matter(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    a, b = ({r["doc_id"]: r["score"] for r in qm.classify(docs, x).collect()} for x in (labels, flipped))
    assert max(abs(a[k] - b[k]) for k in a) < 1e-6


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 3), (2, "", 3), (None, "text", 3), (4, "w " * 50_000, 3), (4, "again", 3)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = qm.classify(docs, none).collect()
    assert len(rows) == 5 and {r["score"] for r in rows} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (4, None)], "doc_id long, quality int")
    assert {r["score"] for r in qm.classify(docs, one).collect()} == {0.5}
    assert qm.classify(docs.limit(0), one).count() == 0
