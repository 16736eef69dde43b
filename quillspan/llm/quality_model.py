"""Quality classifier: random Fourier features, ridge by partition-summed normal equations, isotonic calibration.

A document's statistics (shares of character kinds, lengths, repetition, common words) are computed from its
whole text.  Random Fourier features of the standardised statistics approximate a Gaussian kernel.  Each
partition of the labelled rows sums its part of the normal equations, for two halves; the half that a row is
not in scores it for the calibration, both together make the final weights.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .quality_rules import VOCABULARY
from .runtime import cut

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:",
    "loud": b"!?",
    "quote": b"'\"()-",
    "sign": b"#*$%&",
    "bar": b"|<>",
    "other": b"@^~_=+{}[]\\/`",
    "line": b"\n",
}
_CODE = np.full(256, len(_KINDS) + 1, np.uint8)  # any other byte
for _k, _chars in enumerate(_KINDS.values()):
    _CODE[list(_chars)] = _k
_CODE[0x80:] = len(_KINDS)
N_KINDS = len(_KINDS) + 2
NAMES = [
    *_KINDS, "beyond", "rest", "log_words", "log_bytes", "word_length", "short_words", "long_words", "upper_words", "capital_words", "bare_words",
    "common_words", "distinct_words", "same_as_before", "repeated_five", "repeated_lines", "line_words", "empty",
]


def _common_hashes() -> np.ndarray:
    data = "\n".join(VOCABULARY).encode()
    w = words.Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    return np.sort(w.hashes(0, lower=True))


_common = _common_hashes()


def _repeated(h: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """How many of the hashes occurred before in the same document."""
    codes, _ = pd.factorize(words.mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    again = np.ones(len(codes), bool)
    first = np.empty(codes.max() + 1 if len(codes) else 0, np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    again[first] = False
    return np.bincount(doc[again], minlength=n_docs)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of NAMES for each text; an empty text has zeros but for ``empty``."""
    n_docs = len(offsets) - 1
    size = np.diff(offsets)
    w = words.Words(data, offsets)
    n = w.counts
    one, some = np.maximum(n, 1), np.maximum(size, 1)
    byte_doc = np.repeat(np.arange(n_docs), size)
    code = _CODE[data]
    kinds = np.bincount(byte_doc * N_KINDS + code, minlength=n_docs * N_KINDS).reshape(n_docs, N_KINDS)
    doc = w.doc

    def total(x: np.ndarray) -> np.ndarray:
        return np.bincount(doc, x, n_docs) / one

    length = w.end - w.first
    upper = np.concatenate([[0], np.cumsum(code == 0)])
    letters = np.concatenate([[0], np.cumsum((code <= 1) | (code == len(_KINDS)))])
    n_upper, n_letters = upper[w.end] - upper[w.first], letters[w.end] - letters[w.first]
    h = w.hashes(0, lower=True)
    bare = w.hashes(0, lower=False)
    at = np.searchsorted(_common, h)
    at[at == len(_common)] = 0
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    five, ok = w.grams(h, 5)
    lines = words.Words.__new__(words.Words)
    edge = np.zeros(len(data) + 1, bool)
    edge[1:] = np.concatenate([data == 10, [False]])[: len(data)]
    edge[offsets[:-1]] = True
    starts = np.flatnonzero(edge[: len(data)])
    starts = starts[data[starts] != 10]
    stops = np.sort(np.concatenate([np.flatnonzero(data == 10), offsets[1:]]))
    ends = stops[np.searchsorted(stops, starts, "right")] if len(starts) else starts
    lines.data, lines.first, lines.end = data, starts, ends
    line_doc = np.searchsorted(offsets, starts, "right") - 1
    n_lines = np.bincount(line_doc, minlength=n_docs)
    line_hash = lines.hashes(0)
    out = np.column_stack(
        [
            kinds / some[:, None],
            np.log1p(n), np.log1p(size), total(length), total(length <= 3), total(length >= 12), total((n_upper == n_letters) & (n_letters > 1)),
            total(code[w.first] == 0) if len(w.first) else np.zeros(n_docs), total(n_letters == 0), total(_common[at] == h) if len(h) else np.zeros(n_docs),
            1 - _repeated(bare, doc, n_docs) / one, total(same), _repeated(five[ok], doc[ok], n_docs) / one,
            _repeated(line_hash, line_doc, n_docs) / np.maximum(n_lines, 1), np.log1p(n / np.maximum(n_lines, 1)), n == 0,
        ]
    ).astype(np.float64)
    out[n == 0, :-1] = 0
    return out


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in words.pieces(batch, "text", 2 << 20):
            x = statistics(data, offsets)
            stats = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            others = [c for c in rows.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*rows.select(others).columns, stats], [*others, "stats"])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of keep and stats (see NAMES) of every row; nothing but the text goes in."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *keep, F.col(text_col).alias("text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("text").schema)
    return rows.mapInArrow(_measure, f"{kept}, stats array<double>")


class Model:
    """Standardisation, Fourier features, ridge weights and calibration; a few hundred numbers a side."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, features: int = 256, width: float = 1.0, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        d = len(mean)
        self.w = rng.normal(0, 1 / (width * np.sqrt(d)), (d, features))
        self.phase = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(1 + d + features)
        self.knots: tuple[np.ndarray, np.ndarray] = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def features(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        fourier = np.sqrt(2 / len(self.phase)) * np.cos(x @ self.w + self.phase)
        return np.column_stack([np.ones(len(x)), x, fourier])

    def raw(self, x: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return self.features(x) @ (self.weights if weights is None else weights)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.knots), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(NAMES))


def isotonic(at: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: rising places and values, between which scores are interpolated."""
    blocks: list[list[float]] = []  # weight, sum of y, sum of places
    for a, v, m in zip(at.tolist(), y.tolist(), weight.tolist(), strict=True):
        blocks.append([m, v * m, a * m])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            top = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], top, strict=True)]
    m = np.array(blocks)
    return m[:, 2] / m[:, 0], m[:, 1] / m[:, 0]


def fit(labelled: DataFrame, most_rows: int = 200_000, ridge: float = 1e-3, bins: int = 1024, **options) -> Model | None:
    """A model from labelled (doc_id, stats, label 0 to 1, half 0 or 1), or None without both kinds of label.

    Of more than most_rows rows a hash of the id picks about that many: the bound on what is fitted.
    """
    labelled = cut(labelled)
    n = labelled.count()
    if n > most_rows:
        labelled = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * most_rows / n))
    moments = [f(F.get("stats", F.lit(i))) for i in range(len(NAMES)) for f in (F.avg, F.stddev_pop)]
    first = labelled.agg(F.min("label"), F.max("label"), *moments).first()
    if first[0] is None or first[0] == first[1]:
        return None
    model = Model(np.array(first[2::2]), np.maximum(np.array(first[3::2]), 1e-6), **options)
    shared = labelled.sparkSession.sparkContext.broadcast(model)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            half = batch.column("half").to_numpy()
            z = shared.value.features(_matrix(batch.column("stats")))
            zy = np.column_stack([z, batch.column("label").to_numpy()])
            for k in np.unique(half).tolist():
                total[k] = total.get(k, 0) + z[half == k].T @ zy[half == k]
        for k, v in total.items():
            n = len(v)
            yield pa.RecordBatch.from_arrays([pa.array([k] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([r.tobytes() for r in v], pa.binary())], ["half", "line", "sums"])

    def add(table: pa.Table) -> pa.Table:
        """One line of the equations of a half, summed over the partitions."""
        line = np.sum([np.frombuffer(x) for x in table.column("sums").to_pylist()], axis=0)
        return table.slice(0, 1).set_column(2, "sums", pa.array([line.tobytes()], pa.binary()))

    halves: dict[int, np.ndarray | float] = {0: 0.0, 1: 0.0}
    schema, width = "half int, line int, sums binary", len(model.weights)
    for row in labelled.mapInArrow(sums, schema).groupBy("half", "line").applyInArrow(add, schema).collect():  # two for each weight
        if not np.ndim(halves[row["half"]]):
            halves[row["half"]] = np.zeros((width, width + 1))
        halves[row["half"]][row["line"]] = np.frombuffer(row["sums"])

    def solve(s: np.ndarray) -> np.ndarray:
        a = s[:, :-1] + ridge * max(s[0, 0], 1.0) * np.eye(len(s))
        return np.linalg.solve(a, s[:, -1])

    both = halves[0] + halves[1]
    model.weights = solve(both)
    other = [solve(halves[1 - k]) if np.ndim(halves[1 - k]) else model.weights for k in (0, 1)]
    rest = labelled.sparkSession.sparkContext.broadcast((model, other))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, other = rest.value
        for batch in batches:
            x, half = _matrix(batch.column("stats")), batch.column("half").to_numpy()
            z = model.features(x)
            raw = np.where(half == 0, z @ other[0], z @ other[1])
            place = np.clip(np.floor((raw + 0.5) / 2 * bins), 0, bins - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(raw), batch.column("label")], ["bin", "raw", "label"])

    found = labelled.mapInArrow(held, "bin int, raw double, label double").groupBy("bin").agg(F.avg("raw"), F.avg("label"), F.count("*")).collect()
    curve = np.array(sorted(tuple(r)[1:] for r in found))
    model.knots = isotonic(curve[:, 0], curve[:, 1], curve[:, 2])
    return model


def score(measured: DataFrame, model: Model | None, keep: list[str], threshold: float = 0.3) -> DataFrame:
    """keep columns of measured, score and predicted; without a model every score is 0.5."""
    shared = measured.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("stats"))
            s = shared.value.score(x) if shared.value is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.select(keep).columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))], [*keep, "score", "predicted"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in measured.select(*keep).schema)
    return measured.mapInArrow(work, f"{kept}, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", keep: tuple[str, ...] = (), **options) -> DataFrame:
    """doc_id, the columns of keep, held_out, score and predicted of every row.

    Labels come from the rows of ``labels`` whose crc32(doc_id as text) mod 5 is not 0; several labels of an
    id are averaged, null ones are no labels.  Without both kinds of label every score is 0.5.  Empty and null
    texts are scored too.  Repeated rows are scored each, and each counts as a labelled row.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    measured = cut(document_statistics(docs, id_col, text_col, keep))
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    known = known.where(fold != 0).groupBy("doc_id").agg(F.avg("label").alias("label"))
    labelled = measured.join(known, "doc_id").withColumn("half", (fold % 2).cast("int"))
    model = fit(labelled.select("doc_id", "stats", "label", "half"), **options)
    rows = measured.withColumn("held_out", F.coalesce(fold == 0, F.lit(False)))
    return score(rows, model, ["doc_id", *keep, "held_out"])
