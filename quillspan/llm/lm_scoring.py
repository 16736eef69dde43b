"""Cross-entropy difference by two bigram models that share one vocabulary.

Words and bigrams are counted as themselves, by two independent 64-bit hashes, in a table that is spread over
buckets and grows with the corpus.  Documents are dealt to batches; a batch sends each distinct word and bigram once,
packed in arrays, to the bucket that its high bits name; a bucket adds up the counts of all batches and answers each;
the answers meet the batch's documents again, which are scored there.  So no task and no driver holds a model, and
a word that every document has costs one entry for each batch.

Every document counts for the background model and those of the target for the target model too.  A document's score is
the mean over its words of target loss less background loss: the lower, the nearer to the target.  Both models leave
out the counts of the document that is being scored, so none is judged by its own text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .runtime import power_of_two, small

#: Each word is expected as half a word more than it was seen, as if of 2^18 equally likely ones.
WORD_BITS = 18
#: Bytes of text for each batch and for each bucket.
BATCH, BUCKET = 12 << 20, 8 << 20


def _hashes(w: words.Words, lane: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = w.hashes(lane, lower=True)
    h[h == 0] = 1
    doc = w.doc
    before = np.zeros_like(h)
    before[1:] = np.where(doc[1:] == doc[:-1], h[:-1], np.uint64(0))
    return h, before, words.mix(h * words._LANE[lane][40] + before)


def cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each word: its document, its hash, the hash of the word before (0 at a start) and the pair's hash.

    A-Z are folded.
    """
    w = words.Words(data, offsets)
    return w.doc, *_hashes(w, 0)


class Grams(NamedTuple):
    """The distinct words and bigrams of some texts, in the order of their first hash."""

    doc: np.ndarray
    word: np.ndarray  # for each word its place among them
    pair: np.ndarray
    key: np.ndarray
    check: np.ndarray


def grams(data: np.ndarray, offsets: np.ndarray, check: bool = True) -> Grams:
    w = words.Words(data, offsets)
    h, _, pair = _hashes(w, 0)
    codes, key = pd.factorize(np.concatenate([h, pair]))
    order = np.argsort(key)
    place = np.empty(len(key), np.int64)
    place[order] = np.arange(len(key))
    at = place[codes]
    second = np.zeros(0, np.uint64)
    if check:
        first = np.empty(len(key), np.int64)
        first[at[::-1]] = np.arange(len(at) - 1, -1, -1)
        h, _, pair = _hashes(w, 1)
        second = np.concatenate([h, pair])[first]
    return Grams(w.doc, at[: len(h)], at[len(h) :], key[order], second)


def _pack_keys(key: np.ndarray, check: np.ndarray, bits: int) -> bytes:
    """The second hashes; then the 32 bits after the bucket's as differences, byte by byte, which compresses."""
    low = ((key << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
    step = np.diff(low, prepend=np.uint32(0)).astype("<u4")
    return check.astype("<u8").tobytes() + zlib.compress(step.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpack_keys(raw: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    step = np.frombuffer(zlib.decompress(raw[8 * n :]), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(step.T).view("<u4").ravel(), dtype=np.uint64), np.frombuffer(raw, "<u8", n)


def _pack(counts: np.ndarray) -> bytes:
    """A byte for each count; those of 255 and more follow in full."""
    return zlib.compress(np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes(), 1)


def _unpack(raw: bytes, n: int) -> np.ndarray:
    raw = zlib.decompress(raw)
    counts = np.frombuffer(raw, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, "<i8", -1, n) if len(raw) > n else 0
    return counts


_ROW = "bucket int, batch int, n int, keys binary, background binary, target binary"
_COLUMNS = pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("background", pa.binary()), ("target", pa.binary())])


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(_COLUMNS)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, _COLUMNS, strict=True)], schema=_COLUMNS)


def _wanted(table: pa.Table) -> np.ndarray:
    return table.column("target").to_numpy().astype(bool)


def _sender(bits: int):
    def send(key, table):
        """For one batch: its counts, a row for each bucket."""
        g = grams(*words.text_bytes(table.column("text")))
        mine = _wanted(table)[g.doc]
        size = len(g.key)
        background = np.bincount(g.word, minlength=size) + np.bincount(g.pair, minlength=size)
        target = np.bincount(g.word[mine], minlength=size) + np.bincount(g.pair[mine], minlength=size)
        bucket = (g.key >> np.uint64(64 - bits)).astype(np.int32)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=1 << bits))
        out = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            out.append((int(bucket[a]), key[0].as_py(), b - a, _pack_keys(g.key[a:b], g.check[a:b], bits), _pack(background[a:b]), _pack(target[a:b])))
        words.trim()
        return _table(out)

    return send


def _add(key, table):
    """For one bucket: the sums over all batches of what each batch has."""
    sizes = table.column("n").to_pylist()
    parts = [_unpack_keys(x, n) for x, n in zip(table.column("keys").to_pylist(), sizes, strict=True)]
    low, check = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    order = np.lexsort((low, check))
    low, check = low[order], check[order]
    new = np.concatenate([[True], (low[1:] != low[:-1]) | (check[1:] != check[:-1])])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    ends = np.cumsum(sizes).tolist()
    sums = []
    for name in ("background", "target"):
        counts = np.concatenate([_unpack(x, n) for x, n in zip(table.column(name).to_pylist(), sizes, strict=True)])
        total = np.zeros(int(new.sum()), np.int64)
        np.add.at(total, group, counts)
        every = total[group]
        sums.append([_pack(every[e - n : e]) for e, n in zip(ends, sizes, strict=True)])
    words.trim()
    return _table([(key[0].as_py(), batch, n, b"", x, y) for batch, n, x, y in zip(table.column("batch").to_pylist(), sizes, *sums, strict=True)])


def losses(doc: np.ndarray, word: np.ndarray, pair: np.ndarray, counts: np.ndarray, total: int, own: np.ndarray, trust: float = 8.0) -> np.ndarray:
    """The loss of each word in nats by interpolated bigrams; counts: of each of Grams.key in the model, total: its
    words; own: 1 where the word's document is in the model, which then leaves it out."""

    def others(x: np.ndarray) -> np.ndarray:
        """How often each of x occurs in the model, outside its own document."""
        codes, _ = pd.factorize(doc * len(counts) + x)
        return counts[x] - np.bincount(codes)[codes] * own

    if not len(doc):
        return np.zeros(0)
    c_word, c_pair = others(word), others(pair)
    c_left = np.zeros_like(c_word)
    c_left[1:] = np.where(doc[1:] == doc[:-1], c_word[:-1], 0)
    p_word = (c_word + 0.5) / (total - np.bincount(doc)[doc] * own + 0.5 * (1 << WORD_BITS))
    weight = c_left / (c_left + trust)
    return -np.log(weight * (c_pair / np.maximum(c_left, 1)) + (1 - weight) * p_word)


def _scorer(totals: tuple[int, int]):
    def score(key, replies, table):
        """For one batch: the scores of its documents, by the answers to its words and bigrams."""
        g = grams(*words.text_bytes(table.column("text")), check=False)
        replies = replies.sort_by("bucket")
        sizes = replies.column("n").to_pylist()
        if sum(sizes) != len(g.key):
            raise RuntimeError("the answers of a batch don't fit its words")
        own = _wanted(table).astype(np.int64)[g.doc]
        n = np.bincount(g.doc, minlength=table.num_rows)
        sums = []
        for name, total, o in (("target", totals[1], own), ("background", totals[0], np.ones_like(own))):
            counts = np.concatenate([np.zeros(0, np.int64), *(_unpack(x, k) for x, k in zip(replies.column(name).to_pylist(), sizes, strict=True))])
            sums.append(np.bincount(g.doc, losses(g.doc, g.word, g.pair, counts, total, o), table.num_rows) / np.maximum(n, 1))
        words.trim()
        return pa.table(
            [table.column("doc_id"), pa.array(n, pa.int64()), *[pa.array(x, pa.float64(), mask=n == 0) for x in (*sums, sums[0] - sums[1])]],
            ["doc_id", "n_words", "target_loss", "background_loss", "score"],
        )

    return score


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, data, offsets in words.pieces(batch, "text"):
            n = words.Words(data, offsets).counts
            wanted = rows.column("target").to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_pydict({"n": pa.array([n.sum()], pa.int64()), "wanted": pa.array([n[wanted].sum()], pa.int64()), "size": pa.array([len(data)], pa.int64())})


def lm_scores(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_bytes: int = BATCH, bucket_bytes: int = BUCKET) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss and score (their difference a word) of each row.

    target_ids: the doc_id of each document of the target.  Texts without words have null losses and score.
    With an empty target its model is uniform.  Repeated rows are counted and scored each; null ids are background.
    """
    wanted = target_ids.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct().withColumn("target", F.lit(True))
    wanted = small(wanted, 500_000)  # a larger target is joined by a shuffle
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = ids.join(wanted, "doc_id", "left").select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    n, n_target, size = (x or 0 for x in rows.mapInArrow(_measure, "n long, wanted long, size long").agg(F.sum("n"), F.sum("wanted"), F.sum("size")).first())
    bits = power_of_two(size / bucket_bytes, 64, 1 << 20).bit_length() - 1
    batches = max(32, size // batch_bytes + 1)
    dealt = rows.withColumn("batch", F.pmod(F.xxhash64("doc_id", "text"), F.lit(batches)).cast("int"))
    sent = dealt.groupBy("batch").applyInArrow(_sender(bits), _ROW)
    replies = sent.groupBy("bucket").applyInArrow(_add, _ROW)
    out = "doc_id long, n_words long, target_loss double, background_loss double, score double"
    return replies.groupBy("batch").cogroup(dealt.groupBy("batch")).applyInArrow(_scorer((n, n_target)), out)
