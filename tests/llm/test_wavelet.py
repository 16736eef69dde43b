import zlib

import numpy as np
import pytest
from pyspark.sql import Row

from quillspan.llm import wavelet, words
from quillspan.llm.queries import tokenizer_path
from quillspan.session import shared_dir


@pytest.mark.parametrize("n,width", [(0, 5), (1, 1), (700, 3), (3000, 16), (1500, 20)])
def test_access_rank_select_count(n, width):
    x = np.random.default_rng(n).integers(0, 1 << min(width, 4), n) * (1 << max(0, width - 4))
    m = wavelet.WaveletMatrix.build(x, width)
    assert (m.decode() == x).all()
    for i in range(0, n, 97):
        assert m.access(i) == x[i]
    for symbol in {*x[:5].tolist(), 0, (1 << width) - 1}:
        places = np.flatnonzero(x == symbol)
        assert m.count(symbol) == len(places)
        assert m.count(symbol, n // 3, n // 2) == ((places >= n // 3) & (places < n // 2)).sum()
        for i in range(0, n + 1, 251):
            assert m.rank(symbol, i) == (places < i).sum()
        for k in range(0, len(places), 41):
            assert m.select(symbol, k) == places[k]
        with pytest.raises(IndexError):
            m.select(symbol, len(places))
    if n:
        assert list(m.occurrences(int(x[0]))) == np.flatnonzero(x == x[0]).tolist()


def test_file_round_trip():
    ids = np.array([5, 5, 2, 7, 2])
    file = wavelet.Shard(wavelet.dump(ids, np.array([3, 9]), np.array([False, True]), np.array([3, 2]), 4, 6, 11))
    assert (file.shard, file.first) == (6, 11)
    assert file.matrix.decode().tolist() == ids.tolist() and file.doc_ids.tolist() == [3, 9] and file.null.tolist() == [False, True]
    with pytest.raises(ValueError):
        wavelet.Shard(b"else" + bytes(60))


def brute(rows, end=2):
    t = words.encoder(tokenizer_path()).tokenizer
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, end], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"shard_bytes": 1, "file_ids": 40}])
def test_token_table(spark, options):
    rows = [(i * 7 % 60, f"word{i} the end, again " * (i % 5)) for i in range(60)] + [(None, "no id"), (100, None), (101, ""), (102, "x " * 30000)]
    df = spark.createDataFrame([Row(doc_id=a, text=b, start=1, shard="x", ids="y") for a, b in rows], "doc_id long, text string, start int, shard string, ids string")
    got = wavelet.token_table(df.repartition(3), tokenizer_path(), 2, **options).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_repeated_ids_and_empty_table(spark):
    rows = [(1, "a b"), (1, "a b"), (0, "c")]
    got = wavelet.token_table(spark.createDataFrame(rows, "doc_id long, text string"), tokenizer_path(), 2).collect()
    assert sorted(r["start"] for r in got) == [0, 2, 5] and sum(r["n_tokens"] for r in got) == 8
    none = spark.createDataFrame([], "doc_id long, text string")
    assert wavelet.token_table(none, tokenizer_path(), 2, folder=f"{shared_dir(spark)}/none").count() == 0


def test_a_lookup_reads_few_blocks_of_the_file(tmp_path):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 1 << 12, 40_000)
    raw = wavelet.dump(x, np.array([1]), np.array([False]), np.array([len(x)]), 12, block=2048)
    read = []

    def reader(at, size):
        read.append(size)
        return raw[at : at + size]

    file = wavelet.Shard(reader)
    opened = len(read)
    assert opened == 3 and sum(read) < len(raw) / 5  # head, table, directory
    assert [file.matrix.access(i) for i in (0, 2047, 2048, 39_999)] == [x[i] for i in (0, 2047, 2048, 39_999)]
    assert len(read) - opened <= 4 * 2 * 12
    del read[:]
    symbol = int(x[777])
    places = np.flatnonzero(x == symbol)
    assert file.matrix.rank(symbol, 30_000) == (places < 30_000).sum() and file.matrix.select(symbol, len(places) - 1) == places[-1]
    assert len(read) <= 5 * 2 * 12
    (tmp_path / "one.qwm").write_bytes(raw)
    assert (wavelet.Shard.open(str(tmp_path / "one.qwm")).matrix.decode() == x).all()
