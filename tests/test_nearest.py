import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspan.operators import nearest


def plain(entities, terms):
    out = {}
    for e, space, v in entities:
        best = None
        for row, s, t, banned in sorted(x for x in terms if x[1] == space):
            if v is None or t is None or banned == e or not np.any(v) or not np.any(t):
                continue
            score = float(np.dot(v, t) / np.linalg.norm(v) / np.linalg.norm(t))
            if best is None or score > best[1] + 1e-12:
                best = (row, score)
        if best and space is not None:
            out[e, space] = best
    return out


def frames(spark, entities, terms):
    as_list = lambda v: None if v is None else [float(x) for x in v]
    a = spark.createDataFrame([(e, s, as_list(v)) for e, s, v in entities], "entity_id long, space string, vec array<double>")
    b = spark.createDataFrame([(r, s, as_list(v), x) for r, s, v, x in terms], "row_idx long, space string, vec array<double>, not_for long")
    return a.repartition(3), b.repartition(3)


def clustered(rng, n, centres, spread):
    c = rng.normal(size=(centres, 12))
    return c[rng.integers(centres, size=n)] + rng.normal(0, spread, (n, 12))


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_the_same_as_comparing_all(spark, monkeypatch, spread):
    """Whether the cells prune or not."""
    monkeypatch.setattr(nearest, "WHOLE", 50)
    monkeypatch.setattr(nearest, "BLOCK", 64)
    rng = np.random.default_rng(4)
    vectors = np.round(clustered(rng, 700, 20, spread), 3)
    vectors[600:650] = vectors[0]  # many equal terms: the first counts
    terms = [(int(i), "big" if i % 7 else "small", v, int(i) if i % 50 == 0 else None) for i, v in enumerate(vectors)]
    terms += [(800, "big", None, None), (801, None, vectors[1], None), (802, "big", np.zeros(12), None), (803, "alone", vectors[2], 3)]
    entities = [(int(i), "big" if i % 3 else "small", v) for i, v in enumerate(np.concatenate([vectors[:90], clustered(rng, 60, 5, spread)]))]
    entities += [(900, "none", vectors[0]), (901, "big", None), (902, None, vectors[0]), (3, "alone", vectors[0]), (904, "alone", vectors[0]), (905, "big", np.zeros(12))]
    got = {(r["entity_id"], r["space"]): r for r in nearest.nearest_terms(*frames(spark, entities, terms), counted=True).collect()}
    want = plain(entities, terms)
    assert set(got) == set(want)
    for key, (row, score) in want.items():
        assert got[key]["score"] == pytest.approx(score, abs=1e-9) and got[key]["row_idx"] == row


def test_few_of_the_pairs_are_compared(spark):
    rng = np.random.default_rng(9)
    n, m = 20_000, 300
    v = clustered(rng, n + m, 300, 0.03)
    a = spark.createDataFrame([(i, "s", x.tolist()) for i, x in enumerate(v[:m])], "entity_id long, space string, vec array<double>")
    b = spark.createDataFrame([(i, "s", x.tolist(), None) for i, x in enumerate(v[m:])], "row_idx long, space string, vec array<double>, not_for long")
    out = nearest.nearest_terms(a, b, counted=True)
    assert out.count() == m
    share = out.agg(F.sum("pairs")).first()[0] / (n * m)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = (unit[:m] @ unit[m:].T).argmax(1)
    assert {r["entity_id"]: r["row_idx"] for r in out.collect()} == dict(enumerate(want.tolist()))
    assert share < 0.2, share


def test_empty(spark):
    a, b = frames(spark, [(1, "x", [1.0])], [(1, "x", [1.0], None)])
    assert nearest.nearest_terms(a.limit(0), b).count() == 0 and nearest.nearest_terms(a, b.limit(0)).count() == 0


def test_blocks_and_shelves(spark, monkeypatch):
    """Where nothing can be ruled out, vectors go to each shelf once, not to each cell; bans and equal terms hold across shelves."""
    monkeypatch.setattr(nearest, "WHOLE", 50)
    monkeypatch.setattr(nearest, "BLOCK", 32)
    monkeypatch.setattr(nearest, "TASK", 150 * 12)
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(600, 12))
    vectors[400:420] = vectors[5]
    rows = [(int(i), "s", v) for i, v in enumerate(vectors)]
    terms = [(*x, x[0]) for x in rows]
    sent, meet = spark.sparkContext.accumulator(0), nearest._meet

    def counted(key, entities, shelf):
        sent.add(sum(len(x) for x in entities.column("entity_id")))
        return meet(key, entities, shelf)

    monkeypatch.setattr(nearest, "_meet", counted)
    got = {(r["entity_id"], r["space"]): (r["row_idx"], r["pairs"]) for r in nearest.nearest_terms(*frames(spark, rows, terms), counted=True).collect()}
    assert {k: row for k, (row, _) in got.items()} == {k: row for k, (row, _) in plain(rows, terms).items()}
    assert sent.value == 600 * 4 and sum(p for _, p in got.values()) > 600 * 400  # four shelves, some twenty-five cells
