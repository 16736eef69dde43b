"""Best-fit packing of token sequences, in bulk-synchronous sweeps.

Pieces are range-sorted by length over the cluster.  A piece and a gap are whole numbers up to the sequence
length, so either sorted order is a few thousand runs of equal values, whatever the number of rows: a sweep
matches whole runs (piece run, longest first, with the successor run among the gaps: the smallest gaps that hold
it), resolves who takes which gap by rank within the runs, updates the gaps and goes on until all are placed.
Every piece then finds its sequence from its own rank in its run.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .runtime import cut, input_bytes

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of each document: its ids and end_id, cut only where they exceed capacity.

    Null and empty texts are one piece of one id.  Every row gives pieces, repeated ids too.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = words.encoder(tokenizer)
        for batch in batches:
            for rows, data, offsets in words.pieces(batch, "text"):
                ids, sizes = coder(data, offsets)
                whole = np.full(len(ids) + len(sizes), end_id, "<u4")
                whole[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
                sizes = sizes + 1
                at = np.cumsum(sizes) - sizes
                n = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, sizes[doc] - start)
                lo = (at[doc] + start).tolist()
                crc = np.fromiter((zlib.crc32(whole[a : a + m]) for a, m in zip(lo, length.tolist(), strict=True)), np.int64, len(lo))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start.astype(np.int64)), pa.array(length.astype(np.int64)), pa.array(crc)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(work, PIECES)


def sweep(counts: dict[int, int], capacity: int) -> tuple[dict[int, list[tuple[int, int, int]]], int]:
    """Places counts[n] pieces of each length n.

    Returns for each length its runs (rank of the first piece, first sequence, offset there), where one piece
    goes to each sequence of a run, and the number of sequences.  Its size depends on capacity alone.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs of sequences (first, how many)
    order: list[int] = []  # the gaps there are, ascending
    runs: dict[int, list[tuple[int, int, int]]] = {}
    opened = 0

    def add(gap: int, first: int, n: int) -> None:
        if gap:
            if gap not in gaps:
                bisect.insort(order, gap)
                gaps[gap] = []
            if gaps[gap] and sum(gaps[gap][-1]) == first:
                first, n = gaps[gap][-1][0], gaps[gap].pop()[1] + n
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        out = runs.setdefault(length, [])
        while left:
            i = bisect.bisect_left(order, length)
            if i == len(order):
                n = -(-left // (capacity // length))
                add(capacity - length, opened, n)
                out.append((rank, opened, 0))
                opened, rank, left = opened + n, rank + n, left - n
                continue
            gap = order[i]
            taken = []
            while left and gaps[gap]:  # all gaps of this size at once: a round
                first, n = gaps[gap].pop(0)
                if n > left:
                    gaps[gap].insert(0, (first + left, n - left))
                    n = left
                out.append((rank, first, capacity - gap))
                taken.append((first, n))
                rank, left = rank + n, left - n
            if not gaps[gap]:
                del gaps[gap], order[i]
            for first, n in sorted(taken):
                add(gap - length, first, n)
    return runs, opened


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Adds sequence_id and offset to pieces (columns doc_id, piece, length and any others).

    Each sequence is gapless from 0 and holds at most capacity ids; pieces are never cut here, and lengths
    outside 1..capacity are an error.  Ties are broken by doc_id and piece; repeated rows are placed each.
    """
    pieces = pieces.drop("sequence_id", "offset", "_part")
    parts = max(1, min(65536, input_bytes(pieces) // (8 << 20), 8 * int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    pieces = cut(pieces)  # else the sampling for the ranges would make every piece once more
    ordered = pieces.repartitionByRange(parts, F.desc("length"), "doc_id", "piece").sortWithinPartitions(F.desc("length"), "doc_id", "piece")
    ordered = cut(ordered.withColumn("_part", F.spark_partition_id()))
    # sorted by length, a partition holds few lengths: at most one row for each partition and length border
    seen = ordered.groupBy("_part", "length").count().collect()
    counts: dict[int, int] = {}
    base: dict[tuple[int, int], int] = {}
    for row in sorted(seen, key=lambda r: r["_part"]):
        if not 1 <= row["length"] <= capacity:
            raise ValueError(f"a piece of {row['length']} ids can't be in a sequence of {capacity}")
        base[row["_part"], row["length"]] = counts.get(row["length"], 0)
        counts[row["length"]] = counts.get(row["length"], 0) + row["count"]
    runs, _ = sweep(counts, capacity)
    plan = {n: np.array(r, np.int64).reshape(-1, 3) for n, r in runs.items()}
    spark = pieces.sparkSession
    shared = spark.sparkContext.broadcast((plan, base))
    keep = [c for c in ordered.columns if c != "_part"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, base = shared.value
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            length = batch.column("length").to_numpy()
            part = batch.column("_part").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            edges = np.flatnonzero((np.diff(length) != 0) | (np.diff(part) != 0)) + 1
            for rows in np.split(np.arange(len(length)), edges) if len(length) else []:
                key = int(part[rows[0]]), int(length[rows[0]])
                rank = base[key] + seen.get(key, 0) + np.arange(len(rows))
                seen[key] = seen.get(key, 0) + len(rows)
                table = plan[key[1]]
                run = np.searchsorted(table[:, 0], rank, "right") - 1
                sequence[rows] = table[run, 1] + rank - table[run, 0]
                offset[rows] = table[run, 2]
            kept = batch.select(keep)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.select(*keep).schema) + ", sequence_id long, offset long"
    return ordered.mapInArrow(place, schema)
