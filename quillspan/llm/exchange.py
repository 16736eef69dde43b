"""Questions about hashes of a whole corpus, answered for each document: how often, or where first.

A document's tokens are 64-bit hashes of something in it (word windows, shingles).  Chunks of documents send
each distinct hash once, packed in arrays, to the bucket that its high bits name; a bucket answers for all
chunks; the answers go back to the chunk's key and from there to the documents.  So a hash that millions of
documents share costs one entry for each chunk, no group is larger than a bucket, and rows are arrays of
thousands of hashes rather than single ones.  Buckets grow in number with the input.  Where there are too many for a
chunk to have enough for each, the exchange has two levels: chunks send to coarse buckets, there some chunks together
are dealt to the fine ones, and the answers go back the same way; so rows don't get shorter as buckets get more.

Modes: ``shared`` answers a bit, set if the hash occurs twice or more anywhere (32 bits of it within the
bucket are compared, so once in some thousands of cases a single one counts as shared); ``count`` answers the
number of occurrences, 255 for more; ``smaller`` answers a bit, set if a document with a smaller id has the same
128-bit hash (a null id is larger than any other).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .runtime import input_bytes, power_of_two

ASKED = "bucket int, batch long, payload binary, aux binary"
LAST = np.iinfo(np.int64).max

#: rows, bytes, offsets -> document of each token (ascending), hash, second hash or None, what each document carries or None
Make = Callable[[pa.RecordBatch, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray | None, pa.Array | None]]


def bucket_count(df: DataFrame, bytes_each: int = 8 << 20) -> int:
    return power_of_two(input_bytes(df) / bytes_each, 64, 1 << 20)


def _blob(*arrays: np.ndarray) -> bytes:
    """Some arrays in one value."""
    head = np.array([len(arrays), *[x.nbytes for x in arrays]], "<i8").tobytes()
    return head + b"".join(np.ascontiguousarray(x).tobytes() for x in arrays)


def _arrays(raw: bytes, *kinds: str) -> list[np.ndarray]:
    sizes = np.frombuffer(raw, "<i8", len(kinds), 8).tolist()
    at, out = 8 * (len(kinds) + 1), []
    for size, kind in zip(sizes, kinds, strict=True):
        out.append(np.frombuffer(raw, np.dtype(kind), size // np.dtype(kind).itemsize, at))
        at += size
    return out


def _first(codes: np.ndarray, n: int) -> np.ndarray:
    first = np.empty(n, np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    return first


def _table(schema: list[tuple[str, pa.DataType]], rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.table({name: pa.array(c, kind) for (name, kind), c in zip(schema, columns, strict=True)})


_ASKED = [("bucket", pa.int32()), ("batch", pa.int64()), ("payload", pa.binary()), ("aux", pa.binary())]




def _packed(mode: str, low: np.ndarray, more: np.ndarray, h2: np.ndarray | None) -> tuple[bytes, bytes]:
    """Payload and aux of a row of hashes; more: for each its document id, its count, or whether it is known as shared."""
    if mode == "smaller":
        starts = np.flatnonzero(np.concatenate([[True], more[1:] != more[:-1]]))
        return _blob(low, h2), _blob(more[starts], np.diff(np.append(starts, len(more))).astype(np.uint32))
    return low.tobytes(), more.astype(np.uint8).tobytes() if mode == "count" else np.packbits(more).tobytes()


def _unpacked(mode: str, payload: bytes, aux: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    if mode == "smaller":
        low, h2 = _arrays(payload, "<u4", "<u8")
        who, runs = _arrays(aux, "<i8", "<u4")
        return low, np.repeat(who, runs), h2
    low = np.frombuffer(payload, "<u4")
    return low, np.frombuffer(aux, np.uint8) if mode == "count" else np.unpackbits(np.frombuffer(aux, np.uint8), count=len(low)), None


def _flags(mode: str, flag: np.ndarray) -> bytes:
    return flag.tobytes() if mode == "count" else np.packbits(flag).tobytes()


def _unflag(mode: str, raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8) if mode == "count" else np.unpackbits(np.frombuffer(raw, np.uint8), count=n)


def _sender(make: Make, mode: str, buckets: int, chunk: int, fine: int = 1):
    """fine: how many buckets one row is for; it then starts with how many hashes it has for each."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            for rows, data, offsets in words.pieces(batch, "text", chunk):
                doc, h, h2, carry = make(rows, data, offsets)
                ids = rows.column("doc_id").fill_null(LAST).to_numpy(zero_copy_only=False)
                th = rows.column("th").to_numpy(zero_copy_only=False)
                null = rows.column("doc_id").is_null().to_numpy(zero_copy_only=False)
                bucket = (h >> shift).astype(np.int32)
                codes, unique = pd.factorize(h)
                ref = np.zeros(0, np.int32)
                if mode == "smaller":
                    least = np.full(len(unique), LAST, np.int64)
                    np.minimum.at(least, codes, ids[doc])
                    sent = ids[doc] == least[codes]
                else:
                    first = _first(codes, len(unique))
                    sent = np.zeros(len(h), bool)
                    sent[first] = True
                    times = np.bincount(codes, minlength=len(unique))
                    if mode == "count":
                        ref = first[codes[~sent]].astype(np.int32)
                size = np.bincount(doc, minlength=rows.num_rows).astype(np.uint32)
                key = xxhash.xxh64_intdigest(_blob(np.array([TaskContext.get().partitionId(), turn]), ids, th, size))
                key -= (key >> 63) << 64
                turn += 1
                at = np.flatnonzero(sent)
                order = at[np.argsort(bucket[at], kind="stable")]
                edges = np.searchsorted(bucket[order], np.arange(0, buckets + 1, fine))
                out = []
                for b in np.flatnonzero(np.diff(edges)).tolist():
                    o = order[edges[b] : edges[b + 1]]
                    more = ids[doc[o]] if mode == "smaller" else np.minimum(times[codes[o]], 255) if mode == "count" else times[codes[o]] > 1
                    payload, aux = _packed(mode, h[o].astype(np.uint32), more, None if h2 is None else h2[o])
                    if fine > 1:
                        payload = _blob(np.bincount(bucket[o] - b * fine, minlength=fine).astype(np.uint32), np.frombuffer(payload, np.uint8))
                    out.append((b, key, payload, aux))
                kind = np.uint8 if buckets <= 256 else np.uint16 if buckets <= 1 << 16 else np.uint32
                loads = [] if carry is None else carry.fill_null(b"").to_pylist()
                ends = np.cumsum([len(x) for x in loads], dtype=np.int64)
                table = _blob(ids, null, th, size, bucket.astype(kind), np.packbits(sent), ref, ends, np.frombuffer(b"".join(loads), np.uint8))
                out.append((-1 - key % 4096, key, table, b""))
                yield _table(_ASKED, out).combine_chunks().to_batches()[0]

    return send


def _judge(mode: str):
    """For one bucket: the answer to every chunk."""

    def judge(key, table):
        if key[0].as_py() < 0:
            return table
        batch = table.column("batch").to_pylist()
        parts = [_unpacked(mode, p, a) for p, a in zip(table.column("payload").to_pylist(), table.column("aux").to_pylist(), strict=True)]
        sizes = [len(x) for x, _, _ in parts]
        low, more = (np.concatenate([x[k] for x in parts]) for k in (0, 1))
        if mode == "smaller":
            high = np.concatenate([x for _, _, x in parts])
            order = np.lexsort((more, high, low))
            low, high = low[order], high[order]
            new = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
            least = more[order][np.flatnonzero(new)][np.cumsum(new) - 1]
            flag = np.empty(len(more), bool)
            flag[order] = more[order] > least
        else:
            codes, unique = pd.factorize(low)
            total = np.bincount(codes, more, len(unique))
            if mode == "count":
                flag = np.minimum(total[codes], 255).astype(np.uint8)
            else:
                flag = ((np.bincount(codes, minlength=len(unique)) > 1) | (total > 0))[codes]
        ends = np.cumsum(sizes).tolist()
        replies = [_flags(mode, flag[e - n : e]) for e, n in zip(ends, sizes, strict=True)]
        words.trim()
        return _table(_ASKED, [(key[0].as_py(), b, r, np.int64(n).tobytes()) for b, r, n in zip(batch, replies, sizes, strict=True)])

    return judge


def _regroup(mode: str, fine: int):
    """For one coarse bucket and some chunks: their hashes by fine bucket, as if they were one chunk's."""

    def regroup(key, table):
        coarse, group = (k.as_py() for k in key)
        if coarse < 0:
            return table.select([n for n, _ in _ASKED])
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("batch", "payload", "aux")), strict=True))
        counts, parts = [], []
        for _, payload, aux in rows:
            n, inner = _arrays(payload, "<u4", "u1")
            counts.append(n)
            parts.append(_unpacked(mode, inner.tobytes(), aux))
        at = np.concatenate([np.repeat(np.arange(fine), n) for n in counts])
        order = np.argsort(at, kind="stable")
        low, more = (np.concatenate([x[k] for x in parts])[order] for k in (0, 1))
        h2 = np.concatenate([x[2] for x in parts])[order] if mode == "smaller" else None
        edges = np.searchsorted(at[order], np.arange(fine + 1))
        name = xxhash.xxh64_intdigest(_blob(np.array([coarse, group, fine])))
        name -= (name >> 63) << 64
        out = [(-1 - name % 4096, name, _blob(np.array([r[0] for r in rows], np.int64), np.array([len(x[0]) for x in parts], np.int64), at.astype(np.uint32)), np.int64(coarse).tobytes())]
        for t in np.flatnonzero(np.diff(edges)).tolist():
            a, b = edges[t], edges[t + 1]
            out.append((coarse * fine + t, name, *_packed(mode, low[a:b], more[a:b], None if h2 is None else h2[a:b])))
        words.trim()
        return _table(_ASKED, out)

    return regroup


def _ungroup(mode: str):
    """The answers of fine buckets to some chunks, as answers of the coarse bucket to each; a chunk's own row as it is."""

    def ungroup(key, table):
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("bucket", "payload", "aux")), strict=True), key=lambda r: r[0])
        if len(rows) == 1 and rows[0][0] < 0:
            return table
        batches, sizes, at = _arrays(rows[0][1], "<i8", "<i8", "<u4")
        flag = np.zeros(len(at), np.uint8)
        flag[np.argsort(at, kind="stable")] = np.concatenate([_unflag(mode, p, int(np.frombuffer(a, "<i8")[0])) for _, p, a in rows[1:]])
        coarse = int(np.frombuffer(rows[0][2], "<i8")[0])
        ends = np.cumsum(sizes).tolist()
        return _table(_ASKED, [(coarse, b, _flags(mode, flag[e - n : e]), np.int64(n).tobytes()) for b, e, n in zip(batches.tolist(), ends, sizes.tolist(), strict=True)])

    return ungroup


_ANSWER = [("doc_id", pa.int64()), ("th", pa.int64()), ("n", pa.int32()), ("n_set", pa.int32()), ("bits", pa.binary()), ("carry", pa.binary())]
ANSWER = "doc_id long, th long, n int, n_set int, bits binary, carry binary"


def _collect(mode: str, buckets: int, every: bool):
    """For one chunk: its documents with the answers to their tokens, in the order that make() gave them."""
    kind = "u1" if buckets <= 256 else "<u2" if buckets <= 1 << 16 else "<u4"

    def collect(key, table):
        rows = sorted(zip(table.column("bucket").to_pylist(), table.column("payload").to_pylist(), table.column("aux").to_pylist(), strict=True), key=lambda r: r[0])
        ids, null, th, size, bucket, sent, ref, ends, loads = _arrays(rows[0][1], "<i8", "?", "<i8", "<u4", kind, "u1", "<i4", "<i8", "u1")
        at = np.flatnonzero(np.unpackbits(sent, count=len(bucket)))
        order = at[np.argsort(bucket[at], kind="stable")]
        counts = [int(np.frombuffer(a, "<i8")[0]) for _, _, a in rows[1:]]
        if rows[0][0] >= 0 or sum(counts) != len(order):
            raise RuntimeError("the answers of a chunk don't fit its tokens: its rows came in another order on a second run")
        packed = np.ones(len(bucket), np.uint8)
        if counts:
            packed[order] = np.concatenate([_unflag(mode, p, n) for (_, p, _), n in zip(rows[1:], counts, strict=True)])
        if mode == "count":
            known = np.ones(len(bucket), bool)
            known[at] = False
            packed[known] = packed[ref]
        stop = np.cumsum(size, dtype=np.int64)
        sums = np.concatenate([[0], np.cumsum(packed > (1 if mode == "count" else 0))])
        n_set = sums[stop] - sums[stop - size]
        out = []
        for d in range(len(ids)) if every else np.flatnonzero(n_set).tolist():
            a, b = int(stop[d] - size[d]), int(stop[d])
            bits = packed[a:b].tobytes() if mode == "count" else np.packbits(packed[a:b]).tobytes()
            load = loads[ends[d - 1] if d else 0 : ends[d]].tobytes() if len(ends) else None
            out.append((None if null[d] else int(ids[d]), int(th[d]), b - a, int(n_set[d]), bits, load))
        return _table(_ANSWER, out)

    return collect


def ask(rows: DataFrame, make: Make, mode: str, buckets: int, every: bool = False, unique: bool = True, chunk: int = 4 << 20, coarse: int = 4096, together: int | None = None) -> DataFrame:
    """doc_id, th, n (tokens), n_set (those shared, or with a smaller document), bits and carry of each document.

    rows has doc_id, th (a hash of the text; rows that repeat both are alike and get one answer) and
    text (string or binary).  bits: a packed bit for each token, or a byte in ``count`` mode.
    every: also documents of which no token is set; without unique, repeated rows get an answer each.  rows must come in the same order if a task runs again, as
    those of a scan or of a sort by doc_id and th do; answers that don't fit are an error, never a wrong result.

    More than ``coarse`` buckets are reached in two levels, ``together`` chunks at once: by default half as many as a
    coarse bucket has fine ones.
    """
    if buckets <= coarse:
        asked = rows.mapInArrow(_sender(make, mode, buckets, chunk), ASKED)
        replies = asked.groupBy("bucket").applyInArrow(_judge(mode), ASKED)
    else:
        top = min(coarse, 256)
        fine = buckets // top
        groups = max(1, buckets * (8 << 20) // (chunk * (together or max(8, fine // 2))))
        asked = rows.mapInArrow(_sender(make, mode, buckets, chunk, fine), ASKED).withColumn("grp", F.pmod(F.xxhash64("batch"), F.lit(groups)))
        dealt = asked.groupBy("bucket", "grp").applyInArrow(_regroup(mode, fine), ASKED)
        judged = dealt.groupBy("bucket").applyInArrow(_judge(mode), ASKED)
        replies = judged.groupBy("batch").applyInArrow(_ungroup(mode), ASKED)
    answers = replies.groupBy("batch").applyInArrow(_collect(mode, buckets, every), ANSWER)
    return answers.dropDuplicates(["doc_id", "th"]) if unique else answers
