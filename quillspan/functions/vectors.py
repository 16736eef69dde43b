"""Vector functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity, null for a zero vector."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def embed_names(names: list[str], size: int = 64) -> np.ndarray:
    """A row for each name: signed counts of hashed character trigrams, of unit length; the same for the same text anywhere."""
    padded = [f"  {name.lower()} " for name in names]
    lengths = np.fromiter(map(len, padded), np.int64, len(padded))
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    row = np.repeat(np.arange(len(padded)), lengths)
    at = np.flatnonzero(np.arange(len(codes)) + 2 < np.repeat(np.cumsum(lengths), lengths)) if len(codes) else np.zeros(0, np.int64)
    h = codes[at] * _ODD[0] + codes[at + 1] * _ODD[1] + codes[at + 2] * _ODD[2]
    h = (h ^ (h >> np.uint64(29))) * _ODD[3]
    h ^= h >> np.uint64(32)
    out = np.zeros((len(padded), size), np.float32)
    np.add.at(out, (row[at], (h % np.uint64(size)).astype(np.int64)), np.where(h >> np.uint64(40) & np.uint64(1), 1, -1))
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


def embed_name(text: str, size: int = 64) -> np.ndarray:
    return embed_names([text], size)[0]


def embedder(size: int = 64):
    """A vectorised function from names to vectors, by embed_names(); null names have no vector."""

    @F.pandas_udf("array<float>")
    def embed(names: pd.Series) -> pd.Series:
        vectors = iter(embed_names(names.dropna().tolist(), size))
        return pd.Series([next(vectors) if known else None for known in names.notna()], index=names.index, dtype=object)

    return embed
