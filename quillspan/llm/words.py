"""Words, hashes and token ids of whole Arrow batches, computed on the bytes with numpy.

A word is a run of bytes other than space and tab to carriage return.  No byte of a multi-byte UTF-8
character is below 0x80, so cutting bytes is the same as cutting characters.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, (2, 256), dtype=np.uint64)
_BASE = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)
_LANE = _RNG.integers(1, 2**63, (2, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_HASHED = 1 << 18  # bytes
_powers: list[list[np.ndarray]] = [[], []]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (in place where it can)."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


def _power(lane: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept between calls."""
    have = _powers[lane]
    if not have or len(have[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for base in (int(_BASE[lane]), _inverse(int(_BASE[lane]))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        _powers[lane] = have = out
    return have[0][:n], have[1][:n]


class Words:
    """The words of some texts: ``doc`` of each word, ``first`` and ``end`` byte, ``bounds`` by text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        space = _IS_SPACE[data]
        starts = np.empty(len(data), bool)
        if len(data):
            starts[0] = True
            starts[1:] = space[:-1]
            at = offsets[:-1]
            starts[at[at < len(data)]] = True
        starts &= ~space
        ends = np.empty(len(data), bool)
        if len(data):
            ends[-1] = True
            ends[:-1] = space[1:]
            at = offsets[1:]
            ends[at[at > 0] - 1] = True
        ends &= ~space
        self.first = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.first, offsets)
        self.n_docs = len(offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts)

    def hashes(self, lane: int = 0, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; ``lower`` folds A-Z first.  Lanes are independent."""
        if not len(self.first):
            return np.zeros(0, np.uint64)
        table = _BYTE[lane][_LOWER] if lower else _BYTE[lane]
        out = np.empty(len(self.first), np.uint64)
        i = 0
        while i < len(out):  # in blocks, which bounds the memory that the sums take
            j = max(i + 1, int(np.searchsorted(self.end, self.first[i] + _HASHED, "right")))
            lo, hi = int(self.first[i]), int(self.end[j - 1])
            up, down = _power(lane, hi - lo + 1)
            sums = np.empty(hi - lo + 1, np.uint64)
            sums[0] = 0
            np.cumsum(table[self.data[lo:hi]] * up[:-1], dtype=np.uint64, out=sums[1:])
            first, end = self.first[i:j] - lo, self.end[i:j] - lo
            out[i:j] = (sums[end] - sums[first]) * down[first] + (end - first).astype(np.uint64) * _LANE[lane][63]
            i = j
        return mix(out)

    def word(self, i: int) -> bytes:
        return self.data[self.first[i] : self.end[i]].tobytes()

    def grams(self, h: np.ndarray, n: int, lane: int = 0, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n consecutive words from each word on, and which of them stay within a text.

        short: the first word of a text of fewer words stands for the whole text.
        """
        total = np.zeros(len(h), np.uint64)
        for j in range(min(n, len(h))):
            total[: len(h) - j] += h[j:] * _LANE[lane][j]
        left = np.repeat(self.bounds[1:], self.counts) - np.arange(len(h))
        ok = left >= n
        if short:
            few = (self.counts > 0) & (self.counts < n)
            for d in np.flatnonzero(few):
                a, b = self.bounds[d], self.bounds[d + 1]
                total[a : a + 1] = (h[a:b] * _LANE[lane][: b - a]).sum(dtype=np.uint64)
                total[a : a + 1] += _LANE[lane][32 + b - a]
                ok[a] = True
        return mix(total), ok


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string() if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else pa.large_binary())
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def trim() -> None:
    """Gives memory that is free back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # no glibc
        pass


def pieces(batch: pa.RecordBatch, text: str, most: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows with up to ``most`` bytes of text each, or one row if that has more."""
    if not batch.num_rows:
        return
    data, offsets = text_bytes(batch.column(text))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield batch.slice(a, b - a), data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b
    trim()


_KIND = np.full(256, 4, np.uint8)  # 0 letter, 1 digit, 2 other ASCII, 3 white space, 4 any other byte
_KIND[:0x80] = 2
_KIND[ord("0") : ord("9") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = _KIND[ord("a") : ord("z") + 1] = 0
_KIND[[*range(0x09, 0x0E), 0x20]] = 3


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, Words]:
    """The lowered bytes, and as words the runs that the tokenizers file never merges across.

    Its pattern takes letters, single digits and other characters apart, but for contractions, so a unit
    ends where these meet.  No cut next to an apostrophe that letters follow, in a word with "<|" (a special
    token may start there) or beside characters above U+024F, which may combine with their neighbours;
    words with either keep their case.
    """
    kind = _KIND[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC9))
    if len(lead):
        lead = lead[lead + 1 < len(data)]
        after = data[lead + 1]
        plain = ~((data[lead] == 0xC3) & ((after == 0x97) | (after == 0xB7))) & ~((data[lead] == 0xC4) & (after == 0xB0))
        kind[lead[plain]] = 0
        kind[lead[plain] + 1] = 0
    w = Words(data, offsets)
    lowered = _LOWER[data]
    odd = kind == 4
    odd[:-1] |= (data[:-1] == ord("<")) & (data[1:] == ord("|"))
    at = np.flatnonzero(odd)
    cut = (kind[1:] != kind[:-1]) | (kind[1:] == 1)
    cut &= (kind[1:] != 3) & (kind[:-1] != 3)
    cut &= ~((data[:-1] == ord("'")) & (kind[1:] == 0))
    if len(at):
        for i in np.unique(np.searchsorted(w.first, at, "right") - 1).tolist():
            lowered[w.first[i] : w.end[i]] = data[w.first[i] : w.end[i]]
            cut[w.first[i] : w.end[i] - 1] = False
    inner = np.flatnonzero(cut) + 1
    edges = np.zeros(len(data) + 1, bool)
    edges[inner] = True
    first, end = edges[:-1].copy(), edges.copy()
    first[w.first] = True
    end[w.end] = True
    for at in offsets[1:-1]:  # a text may start where the one before it has no space
        if 0 < at < len(data) and kind[at] != 3 and not first[at]:
            first[at] = True
    w.data, w.first, w.end = lowered, np.flatnonzero(first), np.flatnonzero(end)
    w.bounds = np.searchsorted(w.first, offsets)
    return lowered, w


class Encoder:
    """Token ids by a tokenizers file, unit by unit (see units()); exact, for no merge spans two units.

    Units met before come from a table of at most ``keep``, found by two independent 64-bit hashes.
    """

    def __init__(self, path: str, keep: int = 1 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.keep = Tokenizer.from_file(path), keep
        self.forget()

    def forget(self) -> None:
        self.key = np.zeros(0, np.uint64)
        self.check = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum())), size

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids as uint32, and the number of ids of each text."""
        data, w = units(data, offsets)
        back, key = pd.factorize(w.hashes(0))
        first = np.empty(len(key), np.int64)
        first[back[::-1]] = np.arange(len(back) - 1, -1, -1)
        only = Words.__new__(Words)
        size = w.end[first] - w.first[first]
        ends = np.cumsum(size)
        only.data = data[np.repeat(w.first[first] - (ends - size), size) + np.arange(int(size.sum()))]
        only.first, only.end = ends - size, ends
        check = only.hashes(1)
        spot = np.searchsorted(self.key, key)
        spot[spot == len(self.key)] = 0
        known = (self.key[spot] == key) & (self.check[spot] == check) if len(self.key) else np.zeros(len(key), bool)
        new = np.flatnonzero(~known)
        size = np.zeros(len(key), np.int64)
        at = np.zeros(len(key), np.int64)
        size[known], at[known] = self.size[spot[known]], self.at[spot[known]]
        flat, size[new] = self._encode([only.word(i).decode() for i in new.tolist()])
        at[new] = len(self.ids) + np.cumsum(size[new]) - size[new]
        ids = np.concatenate([self.ids, flat])
        n = size[back]
        ends = np.cumsum(n)
        out = ids[np.repeat(at[back] - (ends - n), n) + np.arange(int(ends[-1]) if len(n) else 0)]
        if len(self.key) + len(new) > self.keep:
            self.forget()
        elif len(new):
            order = np.argsort(np.concatenate([self.key, key[new]]), kind="stable")
            for name, more in (("key", key[new]), ("check", check[new]), ("at", at[new]), ("size", size[new])):
                setattr(self, name, np.concatenate([getattr(self, name), more])[order])
            self.ids = ids
        return out, np.diff(np.concatenate([[0], ends])[w.bounds])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each path and Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
