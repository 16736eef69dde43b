"""Substring duplicates by difference-cover anchors.

A difference cover of a period holds, for every distance, two members that far apart.  So two equal runs of words,
wherever they start, have an offset below the period at which both are at cover positions: hashing the
windows of ``length - period + 1`` words at cover positions alone, three words in seven, loses no match.  First
those anchors that occur twice are found; only windows around one of them are then extended to the full length
and compared, 128 bits of hash each, for the smallest document that holds them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .exchange import ask, bucket_count

#: The perfect difference cover of period 7.
PERIOD, COVER = 7, (1, 2, 4)
_AT = np.isin(np.arange(PERIOD), COVER)


def _anchor_places(w: words.Words, length: int) -> np.ndarray:
    """The words at which anchors start."""
    start = np.repeat(w.bounds[:-1], w.counts)
    n = np.repeat(w.counts, w.counts)
    place = np.arange(len(w.first)) - start
    return np.flatnonzero(_AT[place % PERIOD] & (place + length <= n))


def _candidates(w: words.Words, bits: pa.Array, window: int) -> np.ndarray:
    """The words at which windows start that hold an anchor known to be shared."""
    anchors = _anchor_places(w, window - PERIOD + 1)
    doc = w.doc[anchors]
    have = np.bincount(doc, minlength=w.n_docs)
    parts = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) if b else np.zeros(n, np.uint8) for b, n in zip(bits.to_pylist(), have.tolist(), strict=True)]
    marked = np.zeros(len(w.first) + PERIOD + 1, np.int32)
    if parts:
        marked[anchors + 1] = np.concatenate(parts)
    sums = np.cumsum(marked)
    start = np.repeat(w.bounds[:-1], w.counts)
    n = np.repeat(w.counts, w.counts)
    i = np.arange(len(w.first))
    return np.flatnonzero((i - start + window <= n) & (sums[i + PERIOD] > sums[i]))


def _make_anchors(window: int):
    def make(rows, data, offsets):
        w = words.Words(data, offsets)
        h, _ = w.grams(w.hashes(0), window - PERIOD + 1)
        at = _anchor_places(w, window - PERIOD + 1)
        return w.doc[at], h[at], None, None

    return make


def _make_windows(window: int):
    def make(rows, data, offsets):
        w = words.Words(data, offsets)
        at = _candidates(w, rows.column("bits"), window)
        h, _ = w.grams(w.hashes(0), window, 0)
        h2, _ = w.grams(w.hashes(1), window, 1)
        return w.doc[at], h[at], h2[at], rows.column("bits")

    return make


def _drop_words(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in words.pieces(batch, "text"):
                carry, bits = rows.column("carry"), rows.column("bits").to_pylist()
                lists = [data[a:b].tobytes().split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                n = [len(x) for x in lists]
                removed = [0] * len(n)
                hit = [d for d, b in enumerate(bits) if b is not None]
                if hit:
                    w = words.Words(data, offsets)
                    at = _candidates(w, carry, window)
                    ends = np.searchsorted(at, w.bounds)
                    for d in hit:
                        mine = at[ends[d] : ends[d + 1]] - w.bounds[d]
                        mine = mine[np.unpackbits(np.frombuffer(bits[d], np.uint8), count=len(mine)).astype(bool)]
                        cover = np.zeros(n[d] + 1, np.int64)
                        np.add.at(cover, mine, 1)
                        np.add.at(cover, mine + window, -1)
                        keep = np.cumsum(cover[:-1]) == 0
                        removed[d] = n[d] - int(keep.sum())
                        lists[d] = list(compress(lists[d], keep.tolist()))
                text = [b" ".join(x) for x in lists]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(text, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept_text"],
                )

    return work


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sha = [hashlib.sha256(x.as_buffer()).hexdigest() for x in batch.column("kept_text")]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13, buckets: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by one space) of each row.

    A word goes if a window of ``window`` words over it also starts in a document with a smaller id; windows are
    judged on the input.  Null texts are empty; a null id is larger than any other, and rows of one id don't take
    from each other.  Every row gets a result, repeated ones the same.
    """
    if window <= PERIOD:
        raise ValueError(f"windows must be over {PERIOD} words")
    buckets = buckets or bucket_count(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    shared = ask(rows, _make_anchors(window), "shared", buckets).select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "bits")

    def same(other: DataFrame):
        return rows["doc_id"].eqNullSafe(other["_id"]) & rows["th"].eqNullSafe(other["_th"])

    # a join's rows may come in another order when a task runs again; in this one they are the same
    around = rows.join(shared, same(shared)).select("doc_id", "th", "text", "bits").sortWithinPartitions("doc_id", "th")
    taken = ask(around, _make_windows(window), "smaller", buckets).select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "bits", "carry")
    final = rows.join(taken, same(taken), "left").select("doc_id", "text", "bits", "carry")
    return final.mapInArrow(_drop_words(window), "doc_id long, n_words long, n_removed long, kept_text string")


def digest(kept: DataFrame) -> DataFrame:
    """remove_repeats() with kept_sha256 in place of the text."""
    return kept.mapInArrow(_digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")
