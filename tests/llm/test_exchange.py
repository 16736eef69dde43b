"""The hash exchange against plain counting, in one level and in two."""

from collections import Counter

import numpy as np
import pytest

from quillspan.llm import exchange

ROWS = [(i, [int(x) for x in np.random.default_rng(i).integers(0, 1 << 62, 60)] + [7, 7, 1 << 63, (1 << 64) - 1, 5 * (i % 3) + 13]) for i in range(400)] + [(None, [7, 9, 9]), (3, [11])]


def maker():
    def tokens(rows, data, offsets):  # a closure goes to the workers whole
        size = np.diff(offsets) // 8
        h = np.frombuffer(data.tobytes(), "<u8")
        return np.repeat(np.arange(len(size)), size), h, h * np.uint64(3), None

    return tokens


def frame(spark, order=1):
    rows = [(doc, k, np.array(t, "<u8").tobytes()) for k, (doc, t) in enumerate(ROWS)][::order]
    return spark.createDataFrame([(d, k, bytearray(t)) for d, k, t in rows], "doc_id long, th long, text binary").repartition(4)


def expected(mode):
    times = Counter(x for _, t in ROWS for x in t)
    first = {}
    for doc, t in ROWS:
        for x in t:
            first[x] = min(first.get(x, exchange.LAST), exchange.LAST if doc is None else doc)
    out = {}
    for k, (doc, t) in enumerate(ROWS):
        me = exchange.LAST if doc is None else doc
        out[k] = [min(times[x], 255) if mode == "count" else times[x] > 1 if mode == "shared" else first[x] < me for x in t]
    return out


@pytest.mark.parametrize("mode", ["shared", "count", "smaller"])
@pytest.mark.parametrize("buckets,coarse,order", [(64, 4096, 1), (64, 4096, -1), (512, 64, 1), (512, 64, -1)])
def test_answers(spark, mode, buckets, coarse, order):
    got = exchange.ask(frame(spark, order), maker(), mode, buckets, every=True, chunk=6000, coarse=coarse, together=8).collect()
    wanted = expected(mode)
    assert sorted(r["th"] for r in got) == sorted(wanted)
    for r in got:
        bits = np.frombuffer(r["bits"], np.uint8)
        flags = bits.tolist() if mode == "count" else np.unpackbits(bits, count=r["n"]).astype(bool).tolist()
        assert flags == wanted[r["th"]]


def test_rows_stay_long_as_buckets_get_more():
    """Hashes a row of the exchange, with 64 and with 131,072 buckets: two levels keep them together."""
    import pyarrow as pa

    rng = np.random.default_rng(0)

    class Context:
        def partitionId(self):
            return 0

    exchange.TaskContext.get, kept = staticmethod(lambda: Context()), exchange.TaskContext.get
    try:
        batches = [pa.RecordBatch.from_pydict({"doc_id": pa.array([k]), "th": pa.array([k]), "text": pa.array([rng.integers(0, 1 << 64, 60_000, dtype=np.uint64).astype("<u8").tobytes()], pa.binary())}) for k in range(64)]
        one = [r for b in exchange._sender(maker(), "count", 64, 1 << 19)(iter(batches)) for r in b.to_pylist() if r["bucket"] >= 0]
        fine = 131_072 // 256
        two = [r for b in exchange._sender(maker(), "count", 131_072, 1 << 19, fine)(iter(batches)) for r in b.to_pylist() if r["bucket"] >= 0]
    finally:
        exchange.TaskContext.get = kept
    n = 64 * 60_000
    assert n / len(one) > 900 and n / len(two) > 200
    regroup = exchange._regroup("count", fine)
    made = []
    for c in range(256):
        table = exchange._table(exchange._ASKED, [tuple(r[k] for k, _ in exchange._ASKED) for r in two if r["bucket"] == c])
        made.append(regroup((pa.scalar(c), pa.scalar(0)), table).num_rows - 1 if table.num_rows else 0)
    assert sum(made) <= 131_072  # a row for each fine bucket, whatever the number of chunks, where one level has one for each of both
