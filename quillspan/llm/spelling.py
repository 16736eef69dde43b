"""Spelling variants: words that differ by one character, by errata-trie merging.

The sorted words are a trie, each range of them a part of it in one task.  At every node the child with most words is
heavy.  Each word of a light child is merged into what is beside it with one character replaced or skipped: under
the node with any other character in its place (a wild key, where light children of the node meet each other), under
the heavy child, and under the node itself; for skipped characters of the heavy child, the light words are merged
with the heavy character put in.  A word is in a light child at most log2(words) times, so that many small merges
replace the pairs of all subtrees.  Terminals that coincide are equal hashes, met in one shuffle.

Every pair is met once, at the node where its words part: hashes of a word with one character changed come from its
prefix sums, so no changed word is ever written out.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .runtime import cut

PERIOD = 97
WILD, END = 0x110000, -1  # stand for any character, and for the end of a word
_BASE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_SEED = np.array([0x8CB92BA72F3D8DD7, 0xA0761D6478BD642F], np.uint64)
_SLOW = 256  # longer runs have their checksum from zlib, one by one


# ---------- runs of letters ----------


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), 0xC3]] = True


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[words.Words, np.ndarray]:
    """The maximal runs of A-Z, a-z and U+00C0 to U+00FF as words, lower-cased in A-Z, and their code points."""
    letter = _LETTER[data]
    wide = data == 0xC3  # leads the two bytes of U+00C0 to U+00FF, and nothing else
    letter[1:] |= wide[:-1]
    w = words.Words.__new__(words.Words)
    w.data, w.offsets, w.n_docs = words._LOWER[data], offsets, len(offsets) - 1
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:] = letter[:-1]
    after[:-1] = letter[1:]
    w.first = np.flatnonzero(letter & (~before | edge[:-1]))
    w.end = np.flatnonzero(letter & (~after | edge[1:])) + 1
    w.bounds = np.searchsorted(w.first, offsets)
    leads = np.concatenate([[0], np.cumsum(wide)])
    return w, (w.end - w.first) - (leads[w.end] - leads[w.first])


def checksums(w: words.Words, prefix: list[bytes]) -> np.ndarray:
    """crc32 of each run after its document's prefix, byte by byte for all runs at once."""
    size = w.end - w.first
    register = np.array([zlib.crc32(p) ^ 0xFFFFFFFF for p in prefix], np.uint32)[w.doc]
    order = np.argsort(-size, kind="stable")
    at, left = w.first[order], size[order]
    r = register[order]
    few = int((left > _SLOW).sum())
    for i in range(few):
        r[i] = zlib.crc32(w.data[at[i] : at[i] + left[i]].tobytes(), int(r[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    for j in range(int(left[few]) if few < len(left) else 0):
        k = int(np.searchsorted(-left, -j, "left"))  # runs of more than j bytes
        r[few:k] = _CRC[(r[few:k] ^ w.data[at[few:k] + j]) & np.uint32(255)] ^ (r[few:k] >> np.uint32(8))
    out = np.empty(len(r), np.uint32)
    out[order] = r ^ np.uint32(0xFFFFFFFF)
    return out


def _strings(w: words.Words, which: np.ndarray) -> pa.Array:
    size = w.end[which] - w.first[which]
    ends = np.cumsum(size)
    flat = w.data[np.repeat(w.first[which] - (ends - size), size) + np.arange(int(size.sum()))]
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(which), pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes()))


def _counter(least: int, period: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in words.pieces(batch, "text", 8 << 20):
                w, points = letter_runs(data, offsets)
                long = points >= least
                w.first, w.end, points = w.first[long], w.end[long], points[long]
                w.bounds = np.searchsorted(w.first, offsets)
                if not len(w.first):
                    continue
                h = checksums(w, [f"{'' if i is None else i}:".encode() for i in rows.column("doc_id").to_pylist()])
                hit = h % np.uint32(period) == 0
                shorter: Counter[str] = Counter()
                for i in np.flatnonzero(hit & (points > least)).tolist():
                    word, gone = w.word(i).decode(), int(h[i]) % int(points[i])
                    shorter[word[:gone] + word[gone + 1 :]] += 1
                w.first, w.end = w.first[~hit], w.end[~hit]
                codes, unique = pd.factorize(w.hashes(0))
                first = np.empty(len(unique), np.int64)
                first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
                yield pa.RecordBatch.from_arrays([_strings(w, first), pa.array(np.bincount(codes, minlength=len(unique)), pa.int64())], ["word", "n"])
                if shorter:
                    yield pa.RecordBatch.from_arrays([pa.array(shorter.keys(), pa.string()), pa.array(shorter.values(), pa.int64())], ["word", "n"])

    return count


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 5, occurrences: int = 3, period: int = PERIOD) -> DataFrame:
    """word and n of the words with at least ``least`` code points and ``occurrences``.

    Words are runs of letters (see letter_runs).  Of a run whose crc32 of "<doc_id>:<run>" is a multiple of period the
    code point at that crc32 modulo its length is deleted.  Null texts have no runs; a null id is written as nothing.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_counter(least, period), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


# ---------- hashes of changed words ----------


class Part:
    """Some sorted words with the prefix sums that give the hash of any of them with one character changed."""

    def __init__(self, texts: list[str]):
        self.size = np.array([len(t) for t in texts], np.int64)
        self.code = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        deep = int(self.size.max(initial=0)) + 2
        place = np.arange(len(self.code)) - np.repeat(self.start, self.size)
        self.up, self.back, self.sums = [], [], []
        for lane in (0, 1):
            p = np.full(deep, _BASE[lane], np.uint64)
            p[0] = 1
            self.up.append(np.cumprod(p, dtype=np.uint64))
            self.back.append(np.uint64(pow(int(_BASE[lane]), -1, 1 << 64)))
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.sign(self.code, lane) * self.up[lane][place], dtype=np.uint64)]))

    @staticmethod
    def sign(code: np.ndarray, lane: int) -> np.ndarray:
        return words.mix(np.asarray(code).astype(np.uint64) * _SEED[1 - lane] + _SEED[lane])

    def at(self, i: np.ndarray, d: int) -> np.ndarray:
        """The character of words i at depth d, END after the last."""
        inside = self.size[i] > d
        return np.where(inside, self.code[np.where(inside, self.start[i] + d, 0)] if len(self.code) else END, END)

    def _close(self, raw: list[np.ndarray], size: np.ndarray) -> np.ndarray:
        return np.stack([words.mix(r + size.astype(np.uint64) * _SEED[lane]) for lane, r in enumerate(raw)]).view(np.int64)

    def _parts(self, i: np.ndarray, d: int, lane: int) -> tuple[np.ndarray, np.ndarray]:
        """Sum up to depth d, and from there on."""
        s, a = self.sums[lane], self.start[i]
        return s[a + d] - s[a], s[a + self.size[i]] - s[a + d]

    def whole(self, i: np.ndarray) -> np.ndarray:
        return self._close([self._parts(i, 0, lane)[1] for lane in (0, 1)], self.size[i])

    def prefix(self, i: np.ndarray, d: int) -> np.ndarray:
        return self._close([self._parts(i, d, lane)[0] for lane in (0, 1)], np.full(len(i), d))

    def replaced(self, i: np.ndarray, d: int, by: np.ndarray) -> np.ndarray:
        code = self.at(i, d)
        raw = [sum(self._parts(i, d, lane)) + (self.sign(by, lane) - self.sign(code, lane)) * self.up[lane][d] for lane in (0, 1)]
        return self._close(raw, self.size[i])

    def skipped(self, i: np.ndarray, d: int) -> np.ndarray:
        raw = [self._parts(i, d, lane)[0] + self._parts(i, d + 1, lane)[1] * self.back[lane] for lane in (0, 1)]
        return self._close(raw, self.size[i] - 1)

    def inserted(self, i: np.ndarray, d: int, by: np.ndarray) -> np.ndarray:
        raw = [a + self.sign(by, lane) * self.up[lane][d] + b * _BASE[lane] for lane in (0, 1) for a, b in (self._parts(i, d, lane),)]
        return self._close(raw, self.size[i] + 1)


# ---------- the trie, a range of words in each task ----------


@dataclass
class Edges:
    """What tasks share: for each one how many characters its first and its last word share with the neighbour's."""

    left: dict[int, int]
    right: dict[int, int]
    heavy: dict[tuple[int, int], int]  # of the nodes that lie on such borders: hash to heavy character


def _levels(part: Part, left: int, right: int) -> Iterator[tuple]:
    """For each depth: the words below nodes that part or go on in a neighbour, their node, their character, and for
    the nodes the first word, whether they are on the left or right border, and all children (node, character, words)."""
    active, node, d = np.arange(len(part.size)), np.zeros(len(part.size), np.int64), 0
    while len(active):
        char = part.at(active, d)
        new = np.ones(len(active), bool)
        new[1:] = (node[1:] != node[:-1]) | (char[1:] != char[:-1])
        first = np.flatnonzero(new)
        child = np.cumsum(new) - 1
        count = np.diff(np.append(first, len(active)))
        n_nodes = int(node[-1]) + 1
        border = np.zeros(n_nodes, bool)
        border[0] |= d <= left
        border[-1] |= d <= right
        yield d, active, node, char, border, (node[first], char[first], count)
        goes = (count > 1) & (char[first] != END)
        goes[0] |= d + 1 <= left
        goes[-1] |= d + 1 <= right
        keep = goes[child]
        active, child = active[keep], child[keep]
        node = np.unique(child, return_inverse=True)[1] if len(child) else child
        left, right = (left, right) if len(active) else (-1, -1)
        d += 1


def _read(batches: Iterator[pa.RecordBatch]) -> tuple[pa.Array, pa.Array]:
    got = pa.Table.from_batches(batches, pa.schema([("word", pa.string()), ("n", pa.int64())])).combine_chunks()
    return tuple(got.column(c).combine_chunks() if got.num_rows else pa.array([], got.schema.field(c).type) for c in ("word", "n"))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last word of each task."""
    first = last = None
    for batch in batches:
        if batch.num_rows:
            first = batch.column("word")[0].as_py() if first is None else first
            last = batch.column("word")[batch.num_rows - 1].as_py()
    if first is not None:
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([first]), pa.array([last])], ["part", "first", "last"])


def _border_children(shared):
    """Children of the nodes on a task's borders, with their words in this task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, k = shared.value, TaskContext.get().partitionId()
        word, _ = _read(batches)
        left, right = edges.left.get(k, -1), edges.right.get(k, -1)
        if not len(word) or max(left, right) < 0:
            return
        part = Part(word.to_pylist())
        for d, active, node, _, border, (owner, code, count) in _levels(part, left, right):
            if d > max(left, right):
                return
            on = np.flatnonzero(border[owner])
            start = active[np.searchsorted(node, owner[on])]
            h = part.prefix(start, d)
            yield pa.RecordBatch.from_arrays([pa.array(h[0]), pa.array(h[1]), pa.array(code[on], pa.int32()), pa.array(count[on], pa.int64())], ["h1", "h2", "char", "n"])

    return work


KEYED = "h1 long, h2 long, wild boolean, word string, n long"


def _merge(shared):
    """The errata entries of a task's words: keys under which they meet others, wild ones and those of whole words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, k = shared.value, TaskContext.get().partitionId()
        word, n = _read(batches)
        if not len(word):
            return
        part = Part(word.to_pylist())
        for d, active, node, char, border, (owner, code, count) in _levels(part, edges.left.get(k, -1), edges.right.get(k, -1)):
            begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            rank = np.where(code == END, -1, (count << 21) + (WILD - code))  # most words, then the smaller character
            best = np.maximum.reduceat(rank, begin)
            heavy = np.where(best < 0, END, WILD - (best & 0x1FFFFF))
            parts = np.diff(np.append(begin, len(owner))) > 1
            for g in np.flatnonzero(border).tolist():
                h = part.prefix(active[np.searchsorted(node, [g])], d)
                heavy[g], parts[g] = edges.heavy.get((int(h[0, 0]), int(h[1, 0])), END), True
            light = (parts & (heavy != END))[node] & (char != heavy[node])
            if not light.any():
                continue
            i, by, own = active[light], heavy[node][light], char[light]
            inner = own != END
            j = i[inner]
            ahead = part.at(j, d + 1) != own[inner]
            met = [(part.inserted(i, d, by), i, False)]
            if len(j):
                met += [(part.replaced(j, d, np.full(len(j), WILD)), j, True), (part.replaced(j, d, by[inner]), j, False), (part.skipped(j[ahead], d), j[ahead], False)]
            for h, who, wild in met:
                at = pa.array(who)
                yield pa.RecordBatch.from_arrays([pa.array(h[0]), pa.array(h[1]), pa.array(np.full(len(who), wild)), word.take(at), n.take(at)], ["h1", "h2", "wild", "word", "n"])
        words.trim()

    return work


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            h = Part(batch.column("word").to_pylist()).whole(np.arange(batch.num_rows))
            yield pa.RecordBatch.from_arrays([pa.array(h[0]), pa.array(h[1]), *batch.select(["word", "n"]).columns], ["h1", "h2", "near", "near_n"])


def _shared(a: str, b: str) -> int:
    k = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        k += 1
    return k


def near_counts(counted: DataFrame, each: int = 20_000) -> DataFrame:
    """word, n, n_near and best (less_n: minus n, word: the near word of largest n, then smallest) of the words that have a near word.

    counted: distinct words that are not null, and n.  Sorted, about ``each`` of them are one task's part of the trie;
    nodes that several tasks share have their children's sizes summed over these.  Of each task the driver gets the
    first and last word, and a heavy character for each node that a border between two tasks runs through.
    """
    sc = counted.sparkSession.sparkContext
    tasks = max(1, -(-counted.count() // each))
    ranged = cut(counted.select("word", "n").repartitionByRange(tasks, "word").sortWithinPartitions("word"))
    ends = sorted(tuple(r) for r in ranged.mapInArrow(_ends, "part int, first string, last string").collect())
    edges = Edges({}, {}, {})
    for (a, _, last), (b, first, _) in zip(ends, ends[1:], strict=False):
        edges.right[a] = edges.left[b] = _shared(last, first)
    children = ranged.mapInArrow(_border_children(sc.broadcast(edges)), "h1 long, h2 long, char int, n long").where(F.col("char") >= 0)
    sizes = children.groupBy("h1", "h2", "char").agg(F.sum("n").alias("n"))
    for r in sizes.groupBy("h1", "h2").agg(F.max_by("char", F.struct("n", -F.col("char"))).alias("char")).collect() if edges.left else []:
        edges.heavy[r["h1"], r["h2"]] = r["char"]
    entries = cut(ranged.mapInArrow(_merge(sc.broadcast(edges)), KEYED))
    keys = ranged.mapInArrow(_keys, "h1 long, h2 long, near string, near_n long")
    met = entries.where("NOT wild").join(keys, ["h1", "h2"])
    as_best = lambda n, w: F.struct((-F.col(n)).alias("less_n"), F.col(w).alias("word"))
    one = F.lit(1).cast("long").alias("n_near")
    there = met.select("word", "n", one, as_best("near_n", "near").alias("best"))
    back = met.select(F.col("near").alias("word"), F.col("near_n").alias("n"), one, as_best("n", "word").alias("best"))
    # words that are alike but for one place: as many at most as there are characters
    sides = entries.where("wild").groupBy("h1", "h2").agg(F.sort_array(F.collect_list(as_best("n", "word"))).alias("all")).where(F.size("all") > 1)
    others = F.transform("all", lambda x, i: F.struct(x["word"].alias("word"), (-x["less_n"]).alias("n"), F.get("all", F.when(i == 0, 1).otherwise(0)).alias("best")))
    beside = sides.select((F.size("all") - 1).cast("long").alias("n_near"), F.explode(others).alias("x")).select("x.word", "x.n", "n_near", "x.best")
    return there.union(back).union(beside).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root of forms (word, form; no circles): the last word on each way, by doubling the steps in written rounds."""
    ways = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut(ways.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        ways = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return ways


def group_variants(counted: DataFrame, factor: int = 2, each: int = 20_000) -> DataFrame:
    """word, form, root, n, n_near and form_n of each of counted (distinct words that are not null, and n).

    Words are near if they differ by one inserted, deleted or replaced code point.  The form is the near word of
    largest n (of equal ones the smallest in code-point order) if it occurs ``factor`` times as often or more; root
    follows forms to the last.  Words are equal if two independent 64-bit hashes are.
    """
    counted = cut(counted.select("word", "n"))
    near = near_counts(counted, each)
    found = counted.join(near.select("word", "n_near", "best"), "word", "left")
    takes = -F.col("best.less_n") >= factor * F.col("n")
    found = cut(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(takes, F.col("best.word")).alias("form"), F.when(takes, -F.col("best.less_n")).alias("form_n")))
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """group_variants() of count_words(): empty for tables without such words; repeated rows count each."""
    return group_variants(count_words(docs, id_col, text_col), **options)
