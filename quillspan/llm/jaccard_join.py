"""Similarity self-join of word-shingle sets, by a token-group matrix; no link is lost.

1. Equal sets are one: what follows works on one document for each set.
2. Two sets of similarity t share at least that part of either, so a document can only have a link if that part
   of its shingles occurs elsewhere (see exchange.ask).  Most documents end here.
3. The others are partitioned into groups: a minhash brings a document to a pivot, and those that are
   verified as linked to the pivot form its group, which is connected whatever its size.
4. The matrix has, for each shingle, the groups whose union holds it, with the groups' bounds.  Shingles are in
   one order, rare ones first, and only prefixes are looked up: a query meets a group through its smallest common
   shingle, where positions and sizes bound the overlap.  A group that may qualify is then bounded by the query's
   overlap with its whole union; only groups that qualify are opened and their members compared.
5. Links give connected components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .components import components
from .exchange import LAST, ask, bucket_count
from .runtime import cut

#: Minhashes of each set.
ROUNDS = 4
_PERM = np.random.default_rng(9).integers(1, 2**63, ROUNDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of each distinct shingle, by document and hash.  A-Z are folded; fewer than n words are
    one shingle."""
    w = words.Words(data, offsets)
    h, ok = w.grams(w.hashes(0, lower=True), n, short=True)
    at = np.flatnonzero(ok)
    h, doc = h[at], w.doc[at]
    order = np.argsort(h)
    doc = doc[order]
    order = order[np.argsort(doc.astype(np.uint16) if w.n_docs < 1 << 16 else doc, kind="stable")]
    h, doc = h[order], np.sort(doc)
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def _blobs(doc: np.ndarray, h: np.ndarray, n_docs: int) -> list[bytes]:
    ends = np.searchsorted(doc, np.arange(1, n_docs + 1)) * 8
    raw = h.astype("<u8").tobytes()
    return [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _make_texts(n: int):
    def make(rows, data, offsets):
        doc, h = shingle_sets(data, offsets, n)
        names = [xxhash.xxh3_128_digest(b) for b in _blobs(doc, h, rows.num_rows)]
        return doc, h, None, pa.array(names, pa.binary())

    return make


def _make_sets(rows, data, offsets):
    size = np.diff(offsets) // 8
    return np.repeat(np.arange(len(size)), size), np.frombuffer(data.tobytes(), "<u8"), None, None


def _to_sets(n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in words.pieces(batch, "text"):
                blobs = _blobs(*shingle_sets(data, offsets, n), rows.num_rows)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("th"), pa.array(blobs, pa.binary())], ["doc_id", "th", "text"])

    return work


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds how many shingles occur nowhere else, and the minhashes."""
    for batch in batches:
        alone, keys = [], []
        for blob, times in zip(batch.column("text").to_pylist(), batch.column("times").to_pylist(), strict=True):
            h = np.frombuffer(blob, "<u8")
            alone.append(int((np.frombuffer(times, np.uint8) < 2).sum()))
            keys.append([int(words.mix(h * p).min().astype(np.int64)) for p in _PERM])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(alone, pa.int32()), pa.array(keys, pa.list_(pa.int64()))], [*batch.schema.names, "alone", "keys"])


def _similar(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return work


def _prefixes(percent: int, whole: bool):
    """The shingles of a set that occur elsewhere, with their places in the order: those of the prefix, or all."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_node, out_h, out_at = [], [], []
            for node, blob, times in zip(batch.column("node").to_pylist(), batch.column("text"), batch.column("times"), strict=True):
                h, t = np.frombuffer(blob.as_buffer(), "<u8"), np.frombuffer(times.as_buffer(), np.uint8)
                n = len(h)
                stop = n if whole else n - -(-percent * n // 100) + 1
                order = np.lexsort((h, t))
                places = np.arange(int((t < 2).sum()), stop)
                out_at.append(places)
                out_h.append(h[order[places]])
                out_node.append(np.full(len(places), node))
            if out_at:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_node), pa.int64()), pa.array(np.concatenate(out_h).view("<i8")), pa.array(np.concatenate(out_at), pa.int32())],
                    ["node", "token", "at"],
                )

    return work


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes whose sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("text").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("text").alias("sb"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(_similar(percent), "a long, b long")


def _sizes_fit(x: Column, y: Column, percent: int) -> Column:
    return (100 * x >= percent * y) & (100 * y >= percent * x)


def _stars(family: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of documents to the pivots that minhashes bring them to: first by one minhash, then, for those
    that are not linked yet, by all others at once.

    A key's pivot is the one with most links, then the one with the fewest shingles of its own (the likely
    original of a family of copies), then the smallest id.  Pivots are found among ids and numbers; a set meets its
    pivots once, whatever the number of keys that bring it there.
    """
    links = None
    for keys in ([0], list(range(1, ROUNDS))):
        active = family.select("node", "n", "alone", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.get("keys", F.lit(k)).alias("key")) for k in keys])).alias("by"))
        if links is None:
            active = active.withColumn("held", F.lit(0).cast("long"))
        else:
            held = links.groupBy(F.col("b").alias("node")).agg(F.count("*").alias("held"))
            active = active.join(links.select(F.col("a").alias("node")).distinct(), "node", "left_anti").join(held, "node", "left").withColumn("held", F.coalesce("held", F.lit(0).cast("long")))
        turn = F.struct((-F.col("held")).alias("h"), "alone", "node")
        pivots = active.groupBy("by").agg(F.min_by(F.struct("node", "n"), turn).alias("p"), F.count("*").alias("m")).where("m > 1")
        pivots = cut(pivots)  # a plain table: the join can split a frequent key's rows
        pairs = active.join(pivots, "by").where((F.col("node") != F.col("p.node")) & _sizes_fit(F.col("n"), F.col("p.n"), percent))
        pairs = cut(pairs.select(F.col("node").alias("a"), F.col("p.node").alias("b")).distinct())
        found = cut(_verified(pairs, family, percent).distinct())
        links = found if links is None else links.unionByName(found)
    return links


def _matrix_pairs(nodes: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of documents of different groups that may be linked, by the token-group matrix."""
    grouped = nodes.select("node", "n").join(labels, "node", "left").select("node", "n", F.coalesce("label", "node").alias("grp"))
    sizes = cut(grouped.groupBy("grp").agg(F.count("*").alias("m")))  # plain, so that a large group's rows can be split
    grouped = cut(grouped.join(sizes, "grp"))

    def reach(n: Column, rest: Column, least: Column) -> Column:
        """An overlap of at most ``rest`` is enough for a partner of at least ``least`` shingles."""
        return (100 + percent) * rest >= percent * (n + F.greatest(least, F.ceil(percent * n / F.lit(100))))

    rows = sets.mapInArrow(_prefixes(percent, False), "node long, token long, at int").join(grouped, "node").withColumn("rest", F.col("n") - F.col("at"))
    rows = cut(rows)
    by_token = cut(rows.groupBy("token").agg(F.min("grp").alias("g0"), F.max("grp").alias("g1"), F.min("n").alias("least")).where("g0 <> g1"))
    rows = cut(rows.join(by_token.select("token", "least"), "token").where(reach(F.col("n"), F.col("rest"), F.col("least"))).drop("least", "at"))
    matrix = rows.groupBy("token", "grp").agg(F.min("n").alias("n0"), F.max("n").alias("n1"), F.max("rest").alias("rest1"), F.first("m").alias("m1")).withColumnRenamed("grp", "grp1")
    meets = rows.join(matrix, "token").where(
        (F.struct("m", "grp") < F.struct(F.col("m1"), F.col("grp1")))
        & (100 * F.col("n1") >= percent * F.col("n"))
        & (percent * F.col("n0") <= 100 * F.col("n"))
        & reach(F.col("n"), F.least("rest", "rest1"), F.col("n0"))
    )
    may = cut(meets.groupBy("node", "n", "grp1", "m1").agg(F.min("n0").alias("n0")))
    # a group of one is its own union: its only member is compared at once
    large = may.where("m1 > 1")
    all_tokens = sets.mapInArrow(_prefixes(percent, True), "node long, token long, at int")
    wanted = large.select(F.col("grp1").alias("grp")).distinct()
    union = all_tokens.join(grouped.join(wanted, "grp", "left_semi"), "node").select(F.col("grp").alias("grp1"), "token").distinct()
    overlap = large.join(all_tokens, "node").join(union, ["grp1", "token"]).groupBy("node", "n", "grp1", "n0").agg(F.count("*").alias("common"))
    qualify = overlap.where(reach(F.col("n"), F.col("common"), F.col("n0"))).select("node", "grp1").unionByName(may.where("m1 = 1").select("node", "grp1"))
    qualify = cut(qualify)
    asked = qualify.join(rows.select("node", "token", "n", "rest"), "node")
    members = rows.select(F.col("grp").alias("grp1"), "token", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("rest").alias("restb"))
    opened = asked.join(members, ["grp1", "token"]).where(
        _sizes_fit(F.col("n"), F.col("nb"), percent) & ((100 + percent) * F.least("rest", "restb") >= percent * (F.col("n") + F.col("nb")))
    )
    return opened.select(F.col("node").alias("a"), "b").distinct()


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, percent: int = 85, buckets: int | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of each row.

    Two rows link when 100 * overlap >= percent * union of their shingle sets.  Texts without words have an
    empty set and no links (a null id gives a null component then).  A null id counts as larger than all
    others.  Rows that repeat an id each get the component of their own text; only texts for whose copies that id
    is the smallest share one.
    """
    buckets = buckets or bucket_count(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    rows = given.withColumn("doc_id", F.coalesce("doc_id", F.lit(LAST)))
    told = ask(given, _make_texts(shingle), "shared", buckets, every=True, unique=False).select(F.col("doc_id").alias("given"), "th", "n", "n_set", F.col("carry").alias("name"))
    told = cut(told.withColumn("doc_id", F.coalesce("given", F.lit(LAST))))
    alive = told.where((F.col("n") > 0) & (100 * F.col("n_set") >= percent * F.col("n")))
    reps = cut(alive.groupBy("name").agg(F.min(F.struct("doc_id", "th")).alias("rep")).select("name", "rep.doc_id", "rep.th"))
    sets = rows.join(reps.select("doc_id", "th").distinct(), ["doc_id", "th"]).mapInArrow(_to_sets(shingle), "doc_id long, th long, text binary")
    sets = cut(sets)
    counted = ask(sets, _make_sets, "count", buckets).where(100 * F.col("n_set") >= percent * F.col("n"))
    counted = counted.select("doc_id", "th", F.col("n").cast("long").alias("n"), F.col("bits").alias("times"))
    family = sets.dropDuplicates(["doc_id", "th"]).join(counted, ["doc_id", "th"]).select(F.col("doc_id").alias("node"), "n", "text", "times")
    family = cut(family.mapInArrow(_measure, "node long, n long, text binary, times binary, alone int, keys array<bigint>"))
    nodes = family.select("node", "n", "alone", "keys")
    links = _stars(family, percent)
    labels = components(links)
    more = cut(_verified(_matrix_pairs(nodes, family, labels, percent), family, percent))
    # links, and each set's copies: all by document id
    final = labels if more.isEmpty() else components(links.unionByName(more))
    named = reps.join(final, reps["doc_id"] == final["node"], "left").select("name", F.coalesce("label", "doc_id").alias("label"))
    label = F.coalesce("label", "doc_id")
    label = F.when(label == LAST, F.col("given")).otherwise(label)  # a null id stands in the place of the largest
    return told.join(named, "name", "left").select(F.col("given").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), label.alias("component_id"))
