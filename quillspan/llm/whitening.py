"""Whitening of embeddings: MLlib's computeSVD on centred distributed rows.

An entry c becomes the integer floor(1024 * c) + 100000, so that sums and deviations are exact.  Rows are centred
before anything is multiplied; the singular values s of the centred rows give the covariance's eigenvalues s * s / n
(divisor n).  The total variance comes from the exact deviations, not from the singular values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP, SHIFT = 1024, 100_000
LARGEST = float(1 << 52)  # beyond, an entry has no long
FULL = 1024  # up to so many dimensions all singular vectors are asked for, which LAPACK finds to double precision
RANK = 1e-12  # components of less variance than this share of the first's are none


def usable(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id and vec of the rows that can be whitened.

    Left out are null and empty vectors, those that hold null, non-finite or over-large entries (2**52 and more), and
    vectors that are not of the commonest length (of equally common ones the longest).
    """
    vec = F.col(vec_col).cast("array<double>")
    good = F.forall(vec, lambda e: e.isNotNull() & (F.abs(e) < LARGEST))
    rows = rows.select(F.col(id_col).alias("vec_id"), vec.alias("vec")).where((F.size("vec") > 0) & good)
    first = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("vec") == (first[0]["d"] if first else 0))


def _whole(batch: pa.RecordBatch) -> np.ndarray:
    """floor(1024 * c) of a batch's vectors; the shift falls out of every difference."""
    flat = batch.column("vec").flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat * STEP).astype(np.int64).reshape(batch.num_rows, -1)


class Whitening:
    """What is fitted: count, exact sums, components and their shares; some numbers for each dimension."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums  # sums of floor(1024 * c)
        self.base = np.array([s // n for s in sums], np.int64)
        self.rest = [s - n * int(b) for s, b in zip(sums, self.base, strict=True)]
        self.mean = np.array([r / n for r in self.rest])  # over base, 0 to 1
        self.vectors = np.zeros((len(sums), 0))
        self.values = np.zeros(0)
        self.total = self.identity_error = 0.0

    def centred(self, batch: pa.RecordBatch) -> np.ndarray:
        return (_whole(batch) - self.base) - self.mean

    def deviations(self, batch: pa.RecordBatch) -> list[int]:
        """Sum over the dimensions of (n * x - S) squared, as whole numbers of any size."""
        y = _whole(batch) - self.base
        most, d = int(np.abs(y).max(initial=0)), len(self.sums)
        kind = np.int64 if max(most, self.n) * max(most, 1) * d < 1 << 62 else object
        y, rest = y.astype(kind), np.array(self.rest, kind)
        a, b, c = (y * y).sum(1).tolist(), (y * rest).sum(1).tolist(), sum(r * r for r in self.rest)
        return [self.n * self.n * p - 2 * self.n * q + c for p, q in zip(a, b, strict=True)]

    def whitened(self, batch: pa.RecordBatch) -> np.ndarray:
        return self.centred(batch) @ (self.vectors / np.sqrt(self.values))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each dimension and batch of rows, how many there are and the sum of their whole numbers."""
    for batch in batches:
        if batch.num_rows:
            x = _whole(batch)
            total = x.sum(0) if np.abs(x).max() < (1 << 62) // len(x) else x.astype(object).sum(0)
            names = ["dim", "n", "total"]
            yield pa.RecordBatch.from_arrays([pa.array(range(x.shape[1]), pa.int32()), pa.array([len(x)] * x.shape[1], pa.int64()), pa.array([str(t) for t in total.tolist()])], names)


def fit(vectors: DataFrame, components: int = 8) -> Whitening | None:
    """The whitening of vectors (vec_id, vec: see usable); None without any.

    Components have variance: there are fewer than asked for where the dimensions or the rank are fewer.  Reads
    vectors four times; nothing but sums, a matrix of the dimensions squared and the components comes to the driver.
    """
    sums = vectors.mapInArrow(_moments, "dim int, n long, total string").groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = sorted(sums.collect())
    if not found:
        return None
    model, sc = Whitening(found[0]["n"], [int(r["total"]) for r in found]), vectors.sparkSession.sparkContext
    shared = sc.broadcast(model)

    def centre(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = shared.value.centred(batch)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))], ["row"])

    def deviate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([float(sum(shared.value.deviations(batch)))])], ["total"])

    total = vectors.mapInArrow(deviate, "total double").agg(F.sum("total")).first()[0]
    model.total = total / model.n**3
    if not total:
        return model
    d = len(model.sums)
    rows = MLUtils.convertVectorColumnsFromML(vectors.mapInArrow(centre, "row array<double>").select(array_to_vector("row").alias("row")), "row")
    svd = RowMatrix(rows, model.n, d).computeSVD(d if d <= FULL else min(components, d), computeU=False)
    values = svd.s.toArray() ** 2 / model.n
    kept = min(components, int((values > RANK * values[0]).sum()))
    model.values, model.vectors = values[:kept], svd.V.toArray()[:, :kept]
    ready = sc.broadcast(model)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = ready.value.whitened(batch)
            w = np.column_stack([w, np.ones(len(w))])
            i, j = np.indices((w.shape[1], w.shape[1])).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array((w.T @ w).ravel())], ["i", "j", "total"])

    products = np.zeros((kept + 1, kept + 1))
    for r in vectors.mapInArrow(second, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        products[r["i"], r["j"]] = r["total"] / model.n
    means = products[:kept, kept]
    model.identity_error = float(np.abs(products[:kept, :kept] - np.outer(means, means) - np.eye(kept)).max(initial=0))
    return model


def apply(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """vec_id, component (from 1), n, deviation (decimal of 38 digits; null if it has more), whitened, explained and
    identity_error for each row and component; no rows without a component."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    shared = vectors.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = 0 if model is None else len(model.values)
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            n = batch.num_rows
            at = np.repeat(np.arange(n), k)
            deviation = pa.array([str(v) for v in model.deviations(batch)]).take(pa.array(at))
            columns = [
                batch.column("vec_id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)), pa.array(np.full(n * k, model.n)), deviation,
                pa.array(model.whitened(batch).ravel()), pa.array(np.tile(model.values / model.total, n)), pa.array(np.full(n * k, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    out = vectors.mapInArrow(work, f"vec_id {kind}, component int, n long, deviation string, whitened double, explained double, identity_error double")
    return out.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))


def whiten(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8) -> DataFrame:
    """apply() of fit() on the usable rows.  Repeated rows and ids count and are returned each; other columns are dropped."""
    vectors = usable(rows, id_col, vec_col)
    return apply(vectors, fit(vectors, components))
