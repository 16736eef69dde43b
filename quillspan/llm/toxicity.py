"""Toxicity: non-negative positive-unlabelled learning over words and their beginnings.

Confirmed toxic documents are the positives; all other documents that may be learned from are unlabelled, whatever
they hold.  With the share p of toxic documents, the risk of a classifier f is
p * E+[loss(f, 1)] + max(0, Eu[loss(f, 0)] - p * E+[loss(f, 0)]): the unlabelled part is corrected for the toxic
documents that hide in it, and held at zero from below, as a flexible classifier would drive it under.

Features are chosen by document frequencies over all documents; numpy classifiers are trained on shards of the rows,
and being linear over the same features their mean is one classifier again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .runtime import cut

BEGINNINGS = (4, 5, 6, 7, 8)  # bytes
_WORD = np.ones(256, bool)
_WORD[:0x80] = False
_WORD[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = True
_BLOCK = 1 << 18  # bytes
_LENGTH = words._LANE[0][62] * np.arange(max(BEGINNINGS) + 1, dtype=np.uint64)


def _tokens(data: np.ndarray, offsets: np.ndarray) -> words.Words:
    """Runs of letters, digits and bytes beyond ASCII, lower-cased in A-Z."""
    w = words.Words.__new__(words.Words)
    w.data, w.offsets, w.n_docs = words._LOWER[data], offsets, len(offsets) - 1
    inside, edge = _WORD[data], np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    w.first = np.flatnonzero(inside & (~before | edge[:-1]))
    w.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    w.bounds = np.searchsorted(w.first, offsets)
    return w


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, hash) of every word and of every beginning that is shorter than its word, block by block."""
    w = _tokens(data, offsets)
    doc, i = w.doc, 0
    while i < len(w.first):
        j = max(i + 1, int(np.searchsorted(w.end, w.first[i] + _BLOCK, "right")))
        lo, hi = int(w.first[i]), int(w.end[j - 1])
        up, down = words._power(0, hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(words._BYTE[0][w.data[lo:hi]] * up[:-1], dtype=np.uint64, out=sums[1:])
        first, end, own = w.first[i:j] - lo, w.end[i:j] - lo, doc[i:j]
        for n in (0, *BEGINNINGS):
            a, b, d = first, end, own
            if n:
                longer = end - first > n
                a, b, d = first[longer], first[longer] + n, own[longer]
            yield d, words.mix((sums[b] - sums[a]) * down[a] + _LENGTH[n])
        i = j


@dataclass
class Features:
    """Hashes in order; a table of their high bits keeps most words from being looked up."""

    keys: np.ndarray

    def __post_init__(self):
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self.keys >> np.uint64(44)] = True

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct (document, place of the feature) of some texts, in order."""
        found = [np.zeros(0, np.int64)]
        size = max(len(self.keys), 1)
        for doc, h in grams(data, offsets):
            maybe = np.flatnonzero(self.seen[h >> np.uint64(44)])
            h = h[maybe]
            at = np.minimum(np.searchsorted(self.keys, h), size - 1)
            hit = self.keys[at] == h if len(self.keys) else np.zeros(len(h), bool)
            found.append(doc[maybe[hit]] * size + at[hit])
        both = np.unique(np.concatenate(found))
        return both // size, both % size


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, x)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def risk(f_pos: np.ndarray, f_all: np.ndarray, prior: float) -> tuple[float, float]:
    """The positive part and the corrected negative part of the risk (logistic loss)."""
    return prior * float(_softplus(-f_pos).mean()), float(_softplus(f_all).mean()) - prior * float(_softplus(f_pos).mean())


def train(pos: tuple[np.ndarray, np.ndarray, int], unlabelled: tuple[np.ndarray, np.ndarray, int], n_features: int, prior: float, steps: int = 300, rate: float = 0.05, ridge: float = 1e-3) -> np.ndarray:
    """Weights, the bias last.  Rows are (row of each feature, feature, number of rows).

    Steps go down the risk; where its negative part is below zero they go up that part instead, which undoes what was
    fitted too far.  The second half of the steps is averaged.
    """
    w = np.zeros(n_features + 1)
    w[-1] = np.log(prior / (1 - prior))
    first, second, mean = np.zeros_like(w), np.zeros_like(w), np.zeros_like(w)
    (rp, ip, n_pos), (ru, iu, n_all) = pos, unlabelled

    def back(g: np.ndarray, row: np.ndarray, feature: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(feature, g[row], n_features), g.sum())

    for t in range(1, steps + 1):
        f_pos, f_all = (np.bincount(r, w[i], n) + w[-1] for r, i, n in (pos, unlabelled))
        below = risk(f_pos, f_all, prior)[1] < 0
        up = back(_sigmoid(f_all) / n_all, ru, iu) - back(prior * _sigmoid(f_pos) / n_pos, rp, ip)
        g = -up if below else up - back(prior * _sigmoid(-f_pos) / n_pos, rp, ip)
        g[:-1] += ridge * w[:-1]
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        w = w - rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
        if 2 * t > steps:
            mean += w
    return mean / (steps - steps // 2)


@dataclass
class Model:
    features: Features
    weights: np.ndarray

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        doc, at = self.features.of(data, offsets)
        return _sigmoid(np.bincount(doc, self.weights[at], len(offsets) - 1) + self.weights[-1])


def _sampled(key: Column, share: float) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int((1 << 20) * min(share, 1.0)) if share < 1 else F.lit(True)


def fit(docs: DataFrame, known: DataFrame, most_rows: int = 200_000, least_docs: int = 5, most_candidates: int = 1 << 17, n_features: int = 2048, ridge: float = 0.1) -> Model | None:
    """A model from docs (doc_id, text: what may be learned from) and known (doc_id, label 0 to 1), or None without positives.

    Of more than most_rows positives or unlabelled documents a hash of the id picks about that many to be fitted: the
    bound.  How many documents have a feature is counted over all of docs.  Features occur in least_docs positives
    (more if these are over 2500) and differ most, in standard deviations, from their share of all documents.  The
    weights' penalty is ``ridge`` for all positives together, so that few of them say little.
    """
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    n_known, positive = known.agg(F.count("*"), F.sum(F.when(F.col("label") > 0.5, 1))).first()
    if not positive:
        return None
    prior = min(positive / n_known, 0.95)
    toxic = known.where("label > 0.5").where(_sampled(F.col("doc_id"), most_rows / positive)).select("doc_id")
    confirmed = cut(docs.join(F.broadcast(toxic), "doc_id", "left_semi"))  # ids, about most_rows at most
    n_pos = confirmed.count()
    if not n_pos:
        return None

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each hash once for a document."""
        for batch in batches:
            for rows, data, offsets in words.pieces(batch, "text", 1 << 20):
                seen = pd.DataFrame({"d": np.concatenate([d for d, _ in grams(data, offsets)] or [np.zeros(0, int)]), "h": np.concatenate([h for _, h in grams(data, offsets)] or [np.zeros(0, np.uint64)])})
                yield pa.RecordBatch.from_arrays([pa.array(seen.drop_duplicates()["h"].to_numpy().view(np.int64))], ["h"])

    least = max(least_docs, n_pos // 500)
    often = confirmed.select("text").mapInArrow(spelled, "h long").groupBy("h").count().where(F.col("count") >= least)
    often = often.orderBy(F.desc("count"), "h").limit(most_candidates).collect()
    keys = np.array([r["h"] for r in often], np.int64).view(np.uint64)
    share = np.array([r["count"] for r in often], float)
    order = np.argsort(keys)
    candidates, share = Features(keys[order]), share[order] / n_pos
    shared = sc.broadcast(candidates)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many of a task's documents have each candidate; the number of documents under the number of candidates."""
        count = np.zeros(len(shared.value.keys) + 1, np.int64)
        for batch in batches:
            for rows, data, offsets in words.pieces(batch, "text", 2 << 20):
                count[:-1] += np.bincount(shared.value.of(data, offsets)[1], minlength=len(count) - 1)
                count[-1] += rows.num_rows
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at])], ["place", "n"])

    found = docs.select("text").mapInArrow(frequencies, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    count = np.zeros(len(candidates.keys) + 1)
    for r in found:
        count[r["place"]] = r["n"]
    n_all = max(count[-1], 1)
    among = (count[:-1] + 1) / (n_all + 2)
    far = np.abs(share - among) / np.sqrt(among * (1 - among) / n_pos)
    chosen = np.sort(np.argsort(-far, kind="stable")[:n_features])
    features = Features(candidates.keys[chosen])
    chosen_ones = sc.broadcast(features)
    shards = int(max(1, min(64, n_pos // 500)))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in words.pieces(batch, "text", 2 << 20):
                doc, at = chosen_ones.value.of(data, offsets)
                ends = np.searchsorted(doc, np.arange(rows.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([rows.column("shard"), rows.column("positive"), pa.ListArray.from_arrays(pa.array(ends), pa.array(at.astype(np.int32)))], ["shard", "positive", "features"])

    shard = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).cast("int").alias("shard")
    rows = confirmed.select(shard, F.lit(True).alias("positive"), "text").union(docs.where(_sampled(F.coalesce("doc_id", F.lit(0)), most_rows / n_all)).select(shard, F.lit(False), "text"))
    rows = cut(rows.mapInArrow(measured, "shard int, positive boolean, features array<int>"))

    def learn(table: pa.Table) -> pa.Table:
        side = table.column("positive").to_numpy()

        def rows_of(which: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
            lists = table.column("features").filter(pa.array(which)).combine_chunks()
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            return np.repeat(np.arange(len(size)), size), lists.flatten().to_numpy(zero_copy_only=False), len(size)

        pos, rest = rows_of(side), rows_of(~side)
        if not pos[2] or not rest[2]:
            return pa.table({"weights": pa.array([], pa.binary())})
        return pa.table({"weights": pa.array([train(pos, rest, len(chosen_ones.value.keys), prior, ridge=ridge / pos[2]).tobytes()], pa.binary())})

    fitted = [np.frombuffer(r["weights"]) for r in rows.groupBy("shard").applyInArrow(learn, "weights binary").collect()]  # 64 at most
    return Model(features, np.mean(fitted, axis=0)) if fitted else None


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", threshold: float = 0.5, **options) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; other columns are not read.

    Confirmed are the rows of ``labels`` whose crc32(doc_id as text) mod 5 is not 0; several labels of an id are averaged,
    null ones are no labels.  Documents of the other fold are held out of the unlabelled ones, too.  Without a
    confirmed toxic document every score is 0.  Empty and null texts have the score of no word; repeated rows are
    scored each, and each counts.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label")).where("doc_id IS NOT NULL AND label IS NOT NULL")
    known = known.where(fold != 0).groupBy("doc_id").agg(F.avg("label").alias("label"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    held = F.coalesce(fold == 0, F.lit(False))
    model = fit(rows.where(~held), known, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in words.pieces(batch, "text", 2 << 20):
                s = shared.value.score(data, offsets) if shared.value is not None else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return rows.select("doc_id", held.alias("held_out"), "text").mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
