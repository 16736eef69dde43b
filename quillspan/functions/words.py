"""Words of many texts at once, for Python tasks: where they are, and checksums of them, by place over whole batches."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import regex

_LONG = 64  # bytes; longer words are rare and are hashed one by one
_BATCH = 1 << 20  # characters that are worked on at once; a longer text is a batch of its own


@lru_cache(1)
def _in_words() -> np.ndarray:
    """Of each code point, whether it is a letter or digit."""
    out = np.zeros(0x110000, bool)
    for m in regex.finditer(r"[\p{L}\p{N}]+", "".join(map(chr, range(0x110000)))):
        out[m.start() : m.end()] = True
    return out


@lru_cache(1)
def _table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


def stretches(texts: list[str], most: int = _BATCH) -> Iterator[slice]:
    """Neighbouring texts that have ``most`` characters together, or one longer text."""
    begin = size = 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > most:
            yield slice(begin, i)
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield slice(begin, len(texts))


@dataclass
class Words:
    """The runs of letters and digits of some texts, behind each other."""

    joined: str  # the texts, with line breaks between
    begin: np.ndarray  # of each text in joined
    s: np.ndarray  # of each word in joined
    e: np.ndarray
    row: np.ndarray  # the text of each word
    data: np.ndarray  # joined in UTF-8
    at: np.ndarray  # of each word in data
    size: np.ndarray

    @staticmethod
    def of(texts: list[str]) -> Words:
        joined = "\n".join(texts)
        begin = np.cumsum([0, *[len(t) + 1 for t in texts]], dtype=np.int64)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        inside = np.zeros(len(codes) + 2, np.int8)
        inside[1:-1] = _in_words()[codes]
        edges = np.flatnonzero(np.diff(inside))
        s, e = edges[::2], edges[1::2]
        row = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(s, begin)))
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        if len(data) == len(codes):
            return Words(joined, begin[:-1], s, e, row, data, s, e - s)
        place = np.cumsum(np.concatenate([[0], 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)]))
        return Words(joined, begin[:-1], s, e, row, data, place[s], place[e] - place[s])


def crc32_each(data: np.ndarray, at: np.ndarray, size: np.ndarray, before: np.ndarray | int = 0) -> np.ndarray:
    """zlib.crc32(data[at : at + size], before) of many pieces of bytes: one step for each place of the longest."""
    order = np.argsort(np.minimum(size, _LONG + 1).astype(np.uint8), kind="stable")
    sizes, starts, table = size[order], at[order], _table()
    state = (np.broadcast_to(np.asarray(before, np.uint32), size.shape) ^ np.uint32(0xFFFFFFFF))[order]
    short = int((sizes <= _LONG).sum())
    sizes = sizes[:short]
    for j in range(int(sizes[-1]) if short else 0):
        k = np.searchsorted(sizes, j, "right")
        now = state[k:short]
        state[k:short] = table[(now ^ data[starts[k:short] + j]) & np.uint32(0xFF)] ^ (now >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    for i in range(short, len(starts)):
        state[i] = zlib.crc32(data[starts[i] : starts[i] + size[order[i]]].tobytes(), int(state[i]))
    out = np.empty_like(state)
    out[order] = state
    return out
