"""Token ids on disk: one wavelet matrix per shard file, with access, rank, select and counting.

File format, little-endian: the magic ``QWM2``; seven int64 (ids, documents, bit planes, shard, first id's place
in the shard, length of the table that follows, bits in a block); a zstd block with document ids, null flags and lengths; the
directory: for each plane the ones before each block and in all, then where each block and the last one end; then the
blocks, a zstd block of packed bits each.  Plane 0 holds the highest bit; the next plane holds the same ids after a
stable partition by that bit, zeros first.  Whoever looks up a place or a symbol reads the directory and one block, or
two, of each plane.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .runtime import input_bytes, shared_dir

MAGIC = b"QWM2"
_HEAD = 4 + 7 * 8
BLOCK = 1 << 16  # bits
_KEEP = 4  # blocks of a plane that stay in memory


class Plane:
    """n bits with a rank directory: ``ones`` before each block, and in all; load() gives a block's packed bits."""

    def __init__(self, n: int, ones: np.ndarray, load: Callable[[int], np.ndarray], block: int = BLOCK):
        self.n, self.ones, self.block, self._load = n, ones, block, load
        self.zeros = n - int(ones[-1])
        self._held: dict[int, np.ndarray] = {}

    @classmethod
    def of(cls, bits: np.ndarray, block: int = BLOCK) -> Plane:
        packed = np.packbits(bits, bitorder="little")
        sums = np.add.reduceat(bits, np.arange(0, len(bits), block), dtype=np.int64) if len(bits) else np.zeros(0, np.int64)
        return cls(len(bits), np.concatenate([[0], np.cumsum(sums)]), lambda k: packed[k * block // 8 : (k + 1) * block // 8], block)

    def part(self, k: int) -> np.ndarray:
        if k not in self._held:
            while len(self._held) >= _KEEP:
                self._held.pop(next(iter(self._held)))
            self._held[k] = self._load(k)
        return self._held[k]

    def rank1(self, i: int) -> int:
        """Ones before i."""
        k, rest = divmod(i, self.block)
        if not rest:
            return int(self.ones[k])
        return int(self.ones[k]) + int(np.unpackbits(self.part(k)[: (rest + 7) // 8], count=rest, bitorder="little").sum())

    def select(self, bit: int, k: int) -> int:
        """The position of the k-th (from 0) such bit."""
        ranks = self.ones if bit else np.minimum(np.arange(len(self.ones)) * self.block, self.n) - self.ones
        a = int(np.searchsorted(ranks, k, "right")) - 1
        bits = np.unpackbits(self.part(a), count=min(self.block, self.n - a * self.block), bitorder="little")
        return a * self.block + int(np.flatnonzero(bits == bit)[k - int(ranks[a])])

    def all(self) -> np.ndarray:
        if not self.n:
            return np.zeros(0, bool)
        return np.unpackbits(np.concatenate([self._load(k) for k in range(len(self.ones) - 1)]), count=self.n, bitorder="little").view(bool)


class WaveletMatrix:
    """A sequence of ids below 2**width as bit planes; positions count from 0, ranges are half open."""

    def __init__(self, planes: list[Plane], n: int):
        self.planes, self.n, self.width = planes, n, len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, width: int, block: int = BLOCK) -> WaveletMatrix:
        x = np.asarray(ids).astype(np.uint16 if width <= 16 else np.uint32)
        planes = []
        for bit in range(width - 1, -1, -1):
            one = ((x >> x.dtype.type(bit)) & x.dtype.type(1)).astype(bool)
            planes.append(Plane.of(one, block))
            x = np.concatenate([x[~one], x[one]])
        return cls(planes, len(ids))

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for plane in self.planes:
            ones = plane.rank1(i)
            bit = plane.rank1(i + 1) - ones
            out = out << 1 | bit
            i = plane.zeros + ones if bit else i - ones
        return out

    def _range(self, symbol: int, a: int, b: int) -> tuple[int, int]:
        for k, plane in enumerate(self.planes):
            if a >= b:
                return 0, 0
            x, y = plane.rank1(a), plane.rank1(b)
            if symbol >> (self.width - 1 - k) & 1:
                a, b = plane.zeros + x, plane.zeros + y
            else:
                a, b = a - x, b - y
        return a, b

    def count(self, symbol: int, a: int = 0, b: int | None = None) -> int:
        """Occurrences of symbol in [a, b)."""
        b = self.n if b is None else min(b, self.n)
        if symbol < 0 or symbol >> self.width:
            return 0
        lo, hi = self._range(symbol, max(a, 0), b)
        return hi - lo

    def rank(self, symbol: int, i: int) -> int:
        """Occurrences of symbol before position i."""
        return self.count(symbol, 0, i)

    def select(self, symbol: int, k: int) -> int:
        """The position of the k-th (from 0) occurrence of symbol; IndexError if there are fewer."""
        if k < 0 or k >= self.count(symbol):
            raise IndexError(k)
        i = self._range(symbol, 0, self.n)[0] + k
        for k in range(self.width - 1, -1, -1):
            plane, bit = self.planes[k], symbol >> (self.width - 1 - k) & 1
            i = plane.select(bit, i - plane.zeros if bit else i)
        return i

    def occurrences(self, symbol: int) -> Iterator[int]:
        for k in range(self.count(symbol)):
            yield self.select(symbol, k)

    def decode(self) -> np.ndarray:
        """All ids in order: the partitions undone from the last plane up."""
        x = np.zeros(self.n, np.uint16 if self.width <= 16 else np.uint32)
        for plane in range(self.width - 1, -1, -1):
            one, zeros = self.planes[plane].all(), self.planes[plane].zeros
            out = np.empty_like(x)
            out[~one] = x[:zeros]
            out[one] = x[zeros:] | x.dtype.type(1 << (self.width - 1 - plane))
            x = out
        return x


def dump(ids: np.ndarray, doc_ids: np.ndarray, null: np.ndarray, lengths: np.ndarray, width: int, shard: int = 0, first: int = 0, block: int = BLOCK) -> bytes:
    """A shard file's bytes."""
    press = zstandard.ZstdCompressor(level=3).compress
    table = press(doc_ids.astype("<i8").tobytes() + null.astype(np.uint8).tobytes() + lengths.astype("<i8").tobytes())
    ones, blocks = [], []
    for plane in WaveletMatrix.build(ids, width, block).planes:
        ones.append(plane.ones)
        blocks += [press(plane.part(k).tobytes()) for k in range(len(plane.ones) - 1)]
    ends = np.cumsum([0, *map(len, blocks)])
    head = np.array([len(ids), len(doc_ids), width, shard, first, len(table), block], "<i8")
    return b"".join([MAGIC, head.tobytes(), table, np.concatenate(ones).astype("<i8").tobytes(), ends.astype("<i8").tobytes(), *blocks])


class Shard:
    """A shard file, from its bytes or from read(place, size): only the table and the directory are read at once."""

    def __init__(self, raw: bytes | Callable[[int, int], bytes]):
        read = raw if callable(raw) else lambda at, size: raw[at : at + size]
        head = read(0, _HEAD)
        if head[:4] != MAGIC:
            raise ValueError("not a token shard")
        n, docs, width, self.shard, self.first, size, block = np.frombuffer(head, "<i8", 7, 4).tolist()
        table = zstandard.decompress(read(_HEAD, size))
        self.doc_ids = np.frombuffer(table, "<i8", docs)
        self.null = np.frombuffer(table, np.uint8, docs, 8 * docs).astype(bool)
        self.lengths = np.frombuffer(table, "<i8", docs, 9 * docs)
        each = -(-n // block)
        at = _HEAD + size
        directory = np.frombuffer(read(at, 8 * (width * (each + 1) + width * each + 1)), "<i8")
        ones = directory[: width * (each + 1)].reshape(width, each + 1)
        places = directory[width * (each + 1) :] + at + directory.nbytes

        def loader(plane: int) -> Callable[[int], np.ndarray]:
            def load(k: int) -> np.ndarray:
                a, b = places[plane * each + k : plane * each + k + 2].tolist()
                return np.frombuffer(zstandard.decompress(read(a, b - a)), np.uint8)

            return load

        self.matrix = WaveletMatrix([Plane(n, ones[k], loader(k), block) for k in range(width)], n)

    @classmethod
    def open(cls, uri: str) -> Shard:
        """A file in any store that pyarrow reaches; it stays open while the shard is in use."""
        store, path = fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)
        file = store.open_input_file(path)
        return cls(lambda at, size: file.read_at(size, at))


def _put(folder: str, name: str, raw: bytes) -> None:
    """Writes a file whole or not at all; a task that runs again writes the same bytes."""
    store, path = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
    store.create_dir(path, recursive=True)
    part = f"{path}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as f:
        f.write(raw)
    if not isinstance(store, fs.LocalFileSystem) and store.get_file_info(f"{path}/{name}").type != fs.FileType.NotFound:
        store.delete_file(f"{path}/{name}")
    store.move(part, f"{path}/{name}")


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", file_ids: int = 4 << 20, shard_bytes: int = 8 << 20, most_shards: int = 1 << 16) -> list[int]:
    """Writes the ids of every text, each followed by end_id, in ascending document id into shard files.

    Shards are ranges of document ids; one task streams a shard into files of about file_ids ids (more only if a
    single document is longer).  Returns the number of ids of each shard (at most most_shards numbers).
    Null texts are empty; null ids come last; rows that repeat an id follow each other, by their ids' bytes.
    """
    spark = docs.sparkSession
    shards = max(1, min(most_shards, input_bytes(docs) // shard_bytes))
    bounds = np.zeros(0, np.int64)
    if shards > 1:  # ranges of ids alone, each with its largest: a row for each shard
        ids = docs.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL")
        ranges = ids.repartitionByRange(int(shards), "id").groupBy(F.spark_partition_id()).agg(F.max("id"))
        bounds = np.array(sorted(r[1] for r in ranges.collect())[:-1], np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = words.encoder(tokenizer)
        for batch in batches:
            for rows, data, offsets in words.pieces(batch, "text"):
                ids, sizes = coder(data, offsets)
                ends = np.cumsum(sizes)
                out = np.full(len(ids) + len(sizes), end_id, np.uint32)
                out[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), sizes)] = ids
                wide = out.astype("<u2" if narrow else "<u4")
                at = np.concatenate([[0], ends + np.arange(1, len(sizes) + 1)]) * wide.itemsize
                blob = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(wide)])
                key = rows.column("doc_id")
                shard = np.searchsorted(bounds, key.fill_null(0).to_numpy(zero_copy_only=False), "left").astype(np.int32)
                shard[key.is_null().to_numpy(zero_copy_only=False)] = len(bounds)
                yield pa.RecordBatch.from_arrays([pa.array(shard), key, blob.cast(pa.binary())], ["shard", "doc_id", "ids"])

    from tokenizers import Tokenizer

    top = max(Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True) - 1, end_id)
    narrow, width = top < 1 << 16, max(1, top.bit_length())

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {"shard": None}

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            if state["shard"] is not None and (state["ids"] or final):
                ids = np.frombuffer(b"".join(state["ids"]), "<u2" if narrow else "<u4")
                lengths = np.array([len(x) // (2 if narrow else 4) for x in state["ids"]], np.int64)
                null = np.array([x is None for x in state["docs"]], bool)
                keys = np.array([0 if x is None else x for x in state["docs"]], np.int64)
                if len(keys):
                    _put(folder, f"{state['shard']:06d}-{state['file']:06d}.qwm", dump(ids, keys, null, lengths, width, state["shard"], state["first"]))
                state.update(first=state["first"] + len(ids), file=state["file"] + 1, ids=[], docs=[], held=0)
                if final:
                    yield pa.RecordBatch.from_arrays([pa.array([state["shard"]], pa.int32()), pa.array([state["first"]], pa.int64())], ["shard", "n"])

        for batch in batches:
            for shard, key, ids in zip(batch.column("shard").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if shard != state["shard"]:
                    yield from flush(True)
                    state.update(shard=shard, first=0, file=0, ids=[], docs=[], held=0)
                state["ids"].append(ids)
                state["docs"].append(key)
                state["held"] += len(ids) // (2 if narrow else 4)
                if state["held"] >= file_ids:
                    yield from flush(False)
        yield from flush(True)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    coded = rows.mapInArrow(encode, "shard int, doc_id long, ids binary")
    told = coded.repartition(len(bounds) + 1, "shard").sortWithinPartitions("shard", F.asc_nulls_last("doc_id"), "ids").mapInArrow(store, "shard int, n long")
    sizes = [0] * (len(bounds) + 1)
    for row in told.collect():  # a row for each shard
        sizes[row["shard"]] = row["n"]
    return sizes


def read_tokens(spark, folder: str, sizes: list[int]) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of each document, from the files."""
    before = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("content"):
                file = Shard(raw.as_py())
                ids = file.matrix.decode().astype("<u4")
                ends = np.cumsum(file.lengths)
                starts = ends - file.lengths
                crc = np.fromiter((zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.int64, len(ends))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids, mask=file.null), pa.array(before[file.shard] + file.first + starts), pa.array(file.lengths), pa.array(crc)],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not sum(sizes):
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.qwm").load(folder).select("content")
    return files.mapInArrow(load, schema)


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None, **options) -> DataFrame:
    """Writes the documents' token files (into a new folder of the shared one by default) and reads them back."""
    folder = folder or f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    return read_tokens(docs.sparkSession, folder, write_tokens(docs, tokenizer, folder, end_id, **options))
