from fractions import Fraction

import numpy as np
import pytest

from quillspan.llm import whitening as wh
from quillspan.llm.queries import queries


def plain(vectors):
    """n, exact deviations, eigenvalues and eigenvectors of a list of vectors, by numpy."""
    x = np.floor(np.array(vectors, float) * 1024).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    deviation = [sum((n * int(v) - int(t)) ** 2 for v, t in zip(row, s, strict=True)) for row in x]
    c = x - s / n
    values, basis = np.linalg.eigh(c.T @ c / n)
    return n, deviation, values[::-1], basis[:, ::-1], c


def hold(rows, vectors, ids, k=8):
    n, deviation, values, basis, c = plain(vectors)
    assert len(rows) == n * k
    got = np.full((n, k), np.nan)
    place = {v: i for i, v in enumerate(ids)}
    for r in rows:
        i, j = place[r["vec_id"]], r["component"] - 1
        got[i, j] = r["whitened"]
        assert r["n"] == n and int(r["deviation"]) == deviation[i] and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(values[j] / values.sum(), rel=1e-9)
    want = c @ basis[:, :k] / np.sqrt(values[:k])
    sign = np.sign((got * want).sum(0))
    assert np.allclose(got * sign, want, atol=1e-6)
    assert float(sum(map(Fraction, deviation)) / n**3) == pytest.approx(values.sum(), rel=1e-9)


def test_query_against_numpy(spark, data):
    table = spark.read.parquet(f"{data}/embeddings.parquet").collect()
    rows = queries()["op11_embedding_whitening"](spark, data)
    assert dict(rows.dtypes)["deviation"] == "bigint"
    hold(rows.collect(), [r["embedding"] for r in table], [r["vec_id"] for r in table])


def test_random_rows_of_few_dimensions(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 3, (60, 3)).tolist()
    rows = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(5)
    hold(wh.whiten(rows).collect(), vectors, range(60), 3)


def test_what_is_left_out(spark):
    good = [[0.5, -1.0], [0.25, 2.0], [3.0, 1.0], [0.5, -1.0]]
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [None, 1.0], [nan, 1.0], [inf, 0.0], [1.0, -inf], [1e300, 1.0], [1.0], [1.0, 2.0, 3.0]]
    rows = spark.createDataFrame([(i, v, "x") for i, v in enumerate(good + bad)], "vec_id long, embedding array<double>, whitened string")
    hold(wh.whiten(rows).collect(), good, range(4), 2)


def test_rows_without_variance_and_empty_tables(spark):
    kind = "vec_id long, embedding array<float>"
    assert wh.whiten(spark.createDataFrame([], kind)).count() == 0
    assert wh.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, kind)).count() == 0
    flat = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 2.0]), (None, [4.0, 2.0])], kind)
    rows = wh.whiten(flat).collect()
    assert {r["component"] for r in rows} == {1} and {r["vec_id"] for r in rows} == {1, 2, None}
    assert all(r["explained"] == pytest.approx(1) for r in rows)


def test_deviations_beyond_a_long_are_exact(spark):
    rows = spark.createDataFrame([(i, [float(i) * 2.0**40, float(-i)]) for i in range(4)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: int(r["deviation"]) for r in wh.whiten(rows).collect()}
    x = [[i * 2**50, -i * 1024] for i in range(4)]
    sums = [sum(v[d] for v in x) for d in range(2)]
    assert got == {i: sum((4 * v[d] - sums[d]) ** 2 for d in range(2)) for i, v in enumerate(x)}
