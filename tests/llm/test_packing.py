import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspan.llm import packing, words
from quillspan.llm.queries import tokenizer_path


def best_fit_decreasing(sizes, capacity):
    gaps = []
    for n in sorted(sizes, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(capacity - n)
        else:
            gaps[gaps.index(fit)] -= n
    return len(gaps)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_sweep_places_each_piece_once(sizes):
    counts = defaultdict(int)
    for n in sizes:
        counts[n] += 1
    runs, opened = packing.sweep(dict(counts), 40)
    filled = defaultdict(list)
    for n, table in runs.items():
        ends = [r[0] for r in table[1:]] + [counts[n]]
        for (rank, first, offset), end in zip(table, ends, strict=True):
            for k in range(end - rank):
                filled[first + k].append((offset, n))
    assert sum(map(len, filled.values())) == len(sizes) and set(filled) == set(range(opened))
    for places in filled.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 40
    assert opened <= best_fit_decreasing(sizes, 40) + 1


def test_plan_does_not_grow_with_rows():
    rng = np.random.default_rng(1)
    lengths, weight = np.arange(1, 2049), rng.random(2048)
    sizes = [sum(len(r) for r in packing.sweep({int(n): int(c) for n, c in zip(lengths, weight * m, strict=True) if c >= 1}, 2048)[0].values()) for m in (1e3, 1e9)]
    assert sizes[1] < 3 * sizes[0] + 10_000


def test_pieces_and_packing(spark):
    texts = [(i, "one two three four " * (i % 40)) for i in range(300)] + [(300, "word " * 9000), (301, None), (302, ""), (None, "x"), (5, "again")]
    df = spark.createDataFrame([(a, b, 1, "z") for a, b in texts], "doc_id long, text string, piece int, `offset` string").repartition(4)
    rows = packing.pack(packing.cut_pieces(df, tokenizer_path(), 0, 64), 64).collect()
    t = words.encoder(tokenizer_path()).tokenizer
    expected = []
    for doc, text in texts:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        expected += [(doc, k // 64, k, len(ids[k : k + 64]), zlib.crc32(ids[k : k + 64])) for k in range(0, len(ids), 64)]
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(expected, key=repr)
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        assert [a for a, _ in sorted(places)] == np.concatenate([[0], np.cumsum([n for _, n in sorted(places)])[:-1]]).tolist()
        assert sum(n for _, n in places) <= 64
    assert len(by) <= best_fit_decreasing([r["length"] for r in rows], 64) + 1


def test_empty_and_wrong_lengths(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.cut_pieces(none, tokenizer_path())).count() == 0
    wrong = spark.createDataFrame([(1, 0, 0, 99, 0)], packing.PIECES)
    with pytest.raises(ValueError):
        packing.pack(wrong, 64)
