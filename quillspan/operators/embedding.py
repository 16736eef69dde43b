"""Vectors of names, learned from texts.

Pieces of words (the word, and its trigrams with borders) are counted with the words around them; the positive pointwise
mutual information of pieces and surroundings is cut to its largest singular directions by a randomised SVD.  Pieces and
surroundings are hashed to a fixed number of buckets, so the matrix and the model have a size that the parameters bound,
however long the texts are; all texts are counted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.words import Words, stretches
from ..session import materialise, ship

PIECES, CONTEXTS = 1 << 15, 1 << 11
_MORE = 10  # directions beside those asked for, as a randomised SVD wants
_SHARES = 32
_WORD = regex.compile(r"[\p{L}\p{N}]+")


def words(text: Column) -> Column:
    """The runs of letters and digits of a text in lower case; none of a null one."""
    return F.filter(F.split(F.coalesce(F.lower(text), F.lit("")), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _bucket(text: Column, n: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")


def pieces(word: Column, n: int = PIECES) -> Column:
    """The distinct buckets of a word and of its trigrams, the word's borders marked."""
    marked = F.concat(F.lit("<"), word, F.lit(">"))
    grams = F.transform(F.sequence(F.lit(1), F.char_length(word)), lambda i: F.substring(marked, i, F.lit(3)))
    return F.array_distinct(F.transform(F.array_append(grams, marked), lambda x: _bucket(x, n)))


def _md5_bucket(text: str, n: int) -> int:
    return int(hashlib.md5(text.encode("utf-8", "replace")).hexdigest()[:8], 16) % n


_gram_bucket, _context_bucket = lru_cache(1 << 16)(_md5_bucket), lru_cache(1 << 17)(_md5_bucket)


@lru_cache(1 << 17)
def _word_buckets(word: str, n: int) -> tuple[int, ...]:
    """What pieces() gives, for Python tasks."""
    marked = f"<{word}>"
    return tuple(dict.fromkeys([*[_gram_bucket(marked[i : i + 3], n) for i in range(len(word))], _md5_bucket(marked, n)]))


def _buckets(name: str, n: int) -> list[int]:
    return [b for word in _WORD.findall(name.lower()) for b in _word_buckets(word, n)]


def cooccurrence(texts: DataFrame, column: str = "text", window: int = 2, n_pieces: int = PIECES, n_contexts: int = CONTEXTS) -> DataFrame:
    """piece, context and n: how often a word of the piece has a word of the context at most ``window`` places away.

    Each task counts its texts into a matrix of n_pieces times n_contexts numbers (268 MB of Python's memory as they are by default), so pairs of
    words are neither rows nor shuffled.
    """

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = np.zeros(n_pieces * n_contexts, np.uint32), 0
        for frame in frames:
            listed = frame.column(0).to_pylist()
            for part in stretches(listed, 1 << 22):  # the longer, the fewer words are met again
                found = Words.of(listed[part])
                held += 2 * window * len(found.s)  # as much as one number can have grown
                if held >= 1 << 32:
                    yield from _counted(total, n_contexts)
                    total, held = np.zeros_like(total), 2 * window * len(found.s)
                _add_neighbours(total, found, window, n_pieces, n_contexts)
        yield from _counted(total, n_contexts)

    ship(texts.sparkSession)
    lowered = texts.where(F.col(column).isNotNull()).select(F.lower(F.col(column)).alias("text"))
    some = lowered.coalesce(texts.sparkSession.sparkContext.defaultParallelism)  # a matrix for each task, so as many as there are cores
    return some.mapInArrow(count, "piece int, context int, n long").groupBy("piece", "context").agg(F.sum("n").alias("n"))


def _add_neighbours(total: np.ndarray, found: Words, window: int, n_pieces: int, n_contexts: int) -> None:
    """Adds what cooccurrence() counts in some texts; each distinct word is hashed once, each distinct meeting of a word and a context is dealt to its pieces once."""
    number: dict[str, int] = {}
    ids = np.array([number.setdefault(found.joined[s:e], len(number)) for s, e in zip(found.s.tolist(), found.e.tolist(), strict=True)], np.int64)
    if len(ids) < 2:
        return
    context = np.array([_context_bucket(w, n_contexts) for w in number], np.int64)
    listed = [_word_buckets(w, n_pieces) for w in number]
    sizes = np.fromiter(map(len, listed), np.int64, len(listed))
    flat, starts = np.concatenate(listed).astype(np.int64), np.cumsum(sizes) - sizes
    met = []
    for d in range(1, window + 1):
        near = np.flatnonzero(found.row[d:] == found.row[:-d])
        a, b = ids[near], ids[near + d]
        met += [a * n_contexts + context[b], b * n_contexts + context[a]]
    keys = np.sort(np.concatenate(met))
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    times, keys = np.diff(np.append(first, len(keys))), keys[first]
    word, at = keys // n_contexts, keys % n_contexts
    many = sizes[word]
    place = np.arange(many.sum()) + np.repeat(starts[word] - (np.cumsum(many) - many), many)
    np.add.at(total, flat[place] * n_contexts + np.repeat(at, many), np.repeat(times.astype(np.uint32), many))


def _counted(total: np.ndarray, n_contexts: int) -> Iterator[pa.RecordBatch]:
    step = 1 << 22
    for i in range(0, len(total), step):
        some = np.flatnonzero(total[i : i + step])
        columns = [((some + i) // n_contexts).astype(np.int32), ((some + i) % n_contexts).astype(np.int32), total[some + i].astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["piece", "context", "n"])


def mutual_information(counts: DataFrame) -> DataFrame:
    """counts with ppmi: ln(n * all / (n of the piece * n of the context)), where it is positive.

    counts is read three times; the sums by piece and by context have at most as many rows as there are buckets.
    """
    by_piece = counts.groupBy("piece").agg(F.sum("n").alias("n_piece"))
    by_context = counts.groupBy("context").agg(F.sum("n").alias("n_context"))
    total = by_context.agg(F.sum("n_context").alias("n_all"))  # one row
    out = counts.join(F.broadcast(by_piece), "piece").join(F.broadcast(by_context), "context").join(F.broadcast(total))
    ratio = F.col("n").cast("double") * F.col("n_all") / (F.col("n_piece").cast("double") * F.col("n_context"))
    return out.select("piece", "context", "n", F.log(ratio).alias("ppmi")).where("ppmi > 0")


@dataclass
class LearnedVectors:
    vectors: DataFrame  # piece, vec; at most a row for each bucket
    singular: np.ndarray
    size: int
    n_pieces: int

    def embedder(self):
        """A function from a column of names to vectors of unit length: the sum of the vectors of all pieces of the
        name's words.  A name of unknown pieces has a zero vector, a null one none.  The vectors are sent to each
        executor once: n_pieces times size floats at most."""
        spark = self.vectors.sparkSession
        ship(spark)
        table = np.zeros((self.n_pieces, self.size), np.float32)
        for batch in self.vectors.toArrow().to_batches():
            if batch.num_rows:
                table[batch["piece"].to_numpy()] = batch["vec"].flatten().to_numpy().reshape(-1, self.size)
        sent, n = spark.sparkContext.broadcast(table), self.n_pieces

        @F.pandas_udf("array<float>")
        def embed(names: pd.Series) -> pd.Series:
            out = []
            for name in names:
                v = None if name is None else sent.value[_buckets(name, n)].sum(0)
                out.append(v if v is None or not v.any() else v / np.linalg.norm(v))
            return pd.Series(out, index=names.index, dtype=object)

        return embed


def _dense(frame: pd.DataFrame, width: int) -> np.ndarray:
    out = np.zeros((len(frame), width))
    for k, (at, values) in enumerate(zip(frame["at"], frame["values"], strict=True)):
        out[k, np.asarray(at, np.int64)] = values
    return out


def _gram_times(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """A'(Aq) of the matrix A whose rows are given: a sketch of each partition, summed on the cluster, in the partitions' order."""
    width, k = q.shape
    sent = rows.sparkSession.sparkContext.broadcast(q)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        z, part = np.zeros((width, k)), 0
        for frame in frames:
            for i in range(0, len(frame), 512):
                a = _dense(frame.iloc[i : i + 512], width)
                z += a.T @ (a @ sent.value)
                part = int(frame["part"].iloc[0])
        yield pd.DataFrame({"row": np.arange(width), "part": part, "z": list(z)})

    parts = rows.withColumn("part", F.spark_partition_id()).mapInPandas(work, "row int, part int, z array<double>")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("part", "z"))), lambda x: x["z"])  # of _SHARES at most
    zero = F.array_repeat(F.lit(0.0), k)
    summed = parts.groupBy("row").agg(F.reduce(listed, zero, lambda s, x: F.zip_with(s, x, lambda u, v: u + v)).alias("z"))
    out = np.zeros((width, k))
    for r in summed.collect():  # width rows of k numbers
        out[r["row"]] = r["z"]
    return out


def learn_vectors(
    texts: DataFrame, column: str = "text", size: int = 64, window: int = 2, n_pieces: int = PIECES, n_contexts: int = CONTEXTS, rounds: int = 4, seed: int = 1
) -> LearnedVectors:
    """Learns vectors of ``size`` numbers from all texts; null and empty texts add nothing.

    The rows of the matrix are dealt to at most 32 tasks, for it has n_pieces rows at most.  Each of the ``rounds`` multiplies a
    block of size + 10 directions by the matrix and its transpose; the driver has this block (n_contexts rows) alone
    and makes it orthogonal.
    """
    ship(texts.sparkSession)
    counts = materialise(cooccurrence(texts, column, window, n_pieces, n_contexts))
    entry = F.array_sort(F.collect_list(F.struct("context", "ppmi")))  # at most n_contexts of a piece
    grouped = mutual_information(counts).groupBy("piece").agg(entry.alias("e")).select("piece", F.col("e.context").alias("at"), F.col("e.ppmi").alias("values"))
    rows = materialise(grouped.repartition(_SHARES, "piece").sortWithinPartitions("piece"))
    size = min(size, n_contexts)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_contexts, min(size + _MORE, n_contexts))))
    for _ in range(rounds):
        q, _ = np.linalg.qr(_gram_times(rows, q))
    small = q.T @ _gram_times(rows, q)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-values, kind="stable")[:size]
    singular = np.sqrt(np.maximum(values[best], 0))
    known = singular > 1e-9 * max(singular.max(initial=0), 1e-300)
    scale = np.where(known, 1 / np.sqrt(np.where(known, singular, 1)), 0)
    sent = rows.sparkSession.sparkContext.broadcast(q @ turn[:, best] * scale)

    def project(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in range(0, len(frame), 512):
                some = frame.iloc[i : i + 512]
                yield pd.DataFrame({"piece": some["piece"], "vec": list((_dense(some, n_contexts) @ sent.value).astype(np.float32))})

    return LearnedVectors(materialise(rows.mapInPandas(project, "piece int, vec array<float>")), singular, size, n_pieces)
