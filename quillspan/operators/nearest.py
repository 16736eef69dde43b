"""The nearest term of each entity by cosine: exact, by cells that are left out where they cannot win.

The terms of a space are dealt to cells around k-means centres, each with the radius that holds all its terms.  An entity
first visits the cell of the nearest centre; with the best term found there, the triangle inequality rules out each cell
whose centre is farther than the best distance and its radius together.  The cells that are left are visited, too, so
the result is that of comparing everything with everything, ties included.

For the second visits cells stand on shelves and entities in blocks, both as large as a task can hold; each block meets
each shelf of its space once, and cells are ruled out there.  So vectors travel as often as there are shelves and blocks,
which is no more where nothing can be ruled out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship, written

BLOCK = 2048  # rows that are packed in one
WHOLE = 1024  # spaces of so many terms are one cell
MOST_CELLS = 4096
SAMPLED = 8  # packs of a space that its centres are fitted on
SLACK = 1e-6  # of distance, for rounding
TIE = 1e-13  # of cosine: what is closer is equal
TASK = 1 << 23  # numbers of the vectors of a shelf, and of a block of entities
SPLIT = 8  # blocks that the entities of a space are dealt to if they are some thousands
NONE = np.iinfo(np.int64).min


def _unit(flat: pa.Array, n: int) -> np.ndarray:
    """Vectors of length 1; those of length 0 stay."""
    x = flat.to_numpy(zero_copy_only=False).reshape(n, -1)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0))


def _packs(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """About BLOCK rows of a space in each row: lists of columns and the vectors behind each other in flat; n: rows of the space."""
    n = rows.groupBy("space").agg(F.count("*").alias("n"))
    dealt = rows.join(n, "space").withColumn("pack", F.pmod(F.xxhash64(key), F.ceil(F.col("n") / BLOCK)))
    one = F.struct(*columns, F.col("vec").cast("array<double>").alias("vec"))
    packed = dealt.groupBy("space", "pack").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(one)).alias("rows"))
    return packed.select("space", "pack", "n", *[F.col(f"rows.{c}").alias(c) for c in columns], F.flatten("rows.vec").alias("flat"))


def centres_of(x: np.ndarray, k: int, steps: int = 12) -> np.ndarray:
    """k-means centres of some unit vectors, from rows that are far from each other; fewer if there are fewer distinct ones."""
    order = np.random.default_rng(7).permutation(len(x))
    x = x[order]
    c, near = x[:1], _far(x, x[:1])[:, 0]
    while len(c) < k and near.max() > 1e-9:
        more = np.argsort(-near, kind="stable")[: max(1, min(k - len(c), len(c)))]
        more = more[near[more] > 1e-9]
        c = np.concatenate([c, x[more]])
        near = np.minimum(near, _far(x, x[more]).min(1))
    for _ in range(steps):
        own = _far(x, c).argmin(1)
        n = np.bincount(own, minlength=len(c))
        sums = np.stack([np.bincount(own, x[:, j], len(c)) for j in range(x.shape[1])], axis=1)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c)
    return c


def _fit(key: tuple, table: pa.Table) -> pa.Table:
    n = table.column("n")[0].as_py()
    x = np.concatenate([_unit(f.values, len(r)) for f, r in zip(table.column("flat"), table.column("row_idx"), strict=True)])
    c = x.mean(0, keepdims=True) if n <= WHOLE else centres_of(x, min(MOST_CELLS, int(np.ceil(np.sqrt(n)))))
    return pa.table({"space": pa.array([key[0].as_py()], table.column("space").type), "centres": pa.array([c.ravel().tolist()], pa.list_(pa.float64())), "cells": pa.array([len(c)], pa.int32())})


def _assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each term's cell, the one of the nearest centre, and how far that is."""
    for batch in batches:
        for space, rows, banned, flat, centres, cells in zip(*(batch.column(c) for c in ("space", "row_idx", "not_for", "flat", "centres", "cells")), strict=True):
            n = len(rows)
            far = _far(_unit(flat.values, n), centres.values.to_numpy().reshape(cells.as_py(), -1))
            cell = far.argmin(1)
            d = len(flat) // n
            vec = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * d, pa.int32()), flat.values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([space.as_py()] * n, space.type), pa.array(cell.astype(np.int32)), rows.values, banned.values, vec, pa.array(far[np.arange(n), cell])], ["space", "cell", "row_idx", "not_for", "vec", "far"]
            )


def _route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entities of a pack to the first chunk of the nearest cell."""
    names = ["space", "entity_id", "flat", "centres", "cells", "cell"]
    for batch in batches:
        for space, ids, flat, centres, cells, cell in zip(*(batch.column(c) for c in names), strict=True):
            n = len(ids)
            raw, there = flat.values.to_numpy().reshape(n, -1), np.array(cell.as_py())
            far = _far(_unit(flat.values, n), centres.values.to_numpy().reshape(cells.as_py(), -1))
            nearest, out = far[:, there].argmin(1), []  # of the cells that hold terms
            for k in np.unique(nearest).tolist():
                who = np.flatnonzero(nearest == k)
                out.append((space.as_py(), int(there[k]), 0, ids.values.take(pa.array(who)).to_pylist(), raw[who].ravel().tolist()))
                if len(out) >= 64:
                    yield _visits(out, space.type)
                    out = []
            if out:
                yield _visits(out, space.type)


def _visits(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    kinds = [kind, pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.float64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["space", "cell", "chunk", "entity_id", "mine"])


class _Best:
    """The best term so far of some entities (ids, vectors of length 1 or 0), the first of equals."""

    def __init__(self, ids: np.ndarray, unit: np.ndarray):
        self.ids, self.unit, self.zero = ids, unit, ~unit.any(1)
        self.order = np.argsort(ids, kind="stable")
        self.sorted = ids[self.order]
        self.score, self.row, self.pairs = np.full(len(ids), -np.inf), np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)

    def compare(self, who: np.ndarray, rows: np.ndarray, banned: np.ndarray, unit: np.ndarray) -> None:
        """Entities ``who`` (ascending) with terms by ascending row_idx."""
        none = ~unit.any(1)
        first, last = np.searchsorted(self.sorted, banned, "left"), np.searchsorted(self.sorted, banned, "right")
        out = [(at, c) for c in np.flatnonzero((last > first) & (banned != NONE)).tolist() for at in self.order[first[c] : last[c]].tolist()]
        barred, terms = np.array(sorted(out), np.int64).reshape(-1, 2), unit.T
        for some in np.split(who, range(0, len(who), max(1, (1 << 22) // len(rows)))[1:]):
            score = self.unit[some] @ terms
            score[:, none] = -np.inf
            mine = barred[np.searchsorted(barred[:, 0], some[0]) : np.searchsorted(barred[:, 0], some[-1], "right")] if len(some) else barred[:0]
            mine = mine[np.isin(mine[:, 0], some)]
            score[np.searchsorted(some, mine[:, 0]), mine[:, 1]] = -np.inf
            top = score.max(1)
            row = rows[(score >= (top - TIE)[:, None]).argmax(1)]
            had, was = self.score[some], self.row[some]
            with np.errstate(invalid="ignore"):
                better = np.isfinite(top) & ~self.zero[some] & ((top > had + TIE) | ((top >= had - TIE) & (row < was)))
            self.score[some[better]], self.row[some[better]] = top[better], row[better]
            self.pairs[some] += len(rows)

    def found(self, space, kind: pa.DataType, cell: int | None = None) -> pa.Table:
        ok = np.isfinite(self.score)
        n = int(ok.sum())
        columns = [pa.array(self.ids[ok], pa.int64()), pa.array([space] * n, kind), pa.array(self.row[ok]), pa.array(self.score[ok]), pa.array(self.pairs[ok]), pa.array([cell] * n, pa.int32())]
        return pa.table(columns, ["entity_id", "space", "row_idx", "score", "pairs", "near"])


def _banned(values: list) -> np.ndarray:
    return np.array([NONE if x is None else x for x in values], np.int64)


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best term of a chunk for each entity that visits it, the first of equals; ``pairs`` counts what was compared."""
    for batch in batches:
        for space, cell, ids, mine, rows, banned, flat in zip(*(batch.column(c) for c in ("space", "cell", "entity_id", "mine", "row_idx", "not_for", "flat")), strict=True):
            best = _Best(np.array(ids.as_py()), _unit(mine.values, len(ids)))
            best.compare(np.arange(len(ids)), np.array(rows.as_py()), _banned(banned.as_py()), _unit(flat.values, len(rows)))
            yield from best.found(space.as_py(), space.type, cell.as_py()).to_batches()


def _meet(key: tuple, entities: pa.Table, shelf: pa.Table) -> pa.Table:
    """A block of entities with a shelf: each chunk is ruled out or compared, but the one that an entity has seen."""
    kind = entities.schema.field("space").type
    ids = np.concatenate([np.zeros(0, np.int64), *[x.values.to_numpy() for x in entities.column("entity_id")]])
    if not len(ids) or not shelf.num_rows:
        return _Best(ids[:0], np.zeros((0, 1))).found(None, kind)
    known = np.concatenate([x.values.to_numpy(zero_copy_only=False) for x in entities.column("best")]).astype(float)
    seen = np.concatenate([x.values.to_numpy(zero_copy_only=False) for x in entities.column("near")]).astype(float)
    best = _Best(ids, np.concatenate([_unit(x.values, len(r)) for x, r in zip(entities.column("flat"), entities.column("entity_id"), strict=True)]))
    reach = np.where(np.isnan(known), np.inf, np.sqrt(np.maximum(2 - 2 * known, 0))) + SLACK
    for cell, chunk, rows, banned, flat in zip(*(shelf.column(c) for c in ("cell", "chunk", "row_idx", "not_for", "flat")), strict=True):
        unit = _unit(flat.values, len(rows))
        centre = unit.mean(0, keepdims=True)
        near = _far(best.unit, centre)[:, 0] - _far(unit, centre).max() <= reach
        if chunk.as_py() == 0:
            near &= seen != cell.as_py()
        who = np.flatnonzero(near)
        if len(who):
            best.compare(who, np.array(rows.as_py()), _banned(banned.as_py()), unit)
    return best.found(key[0].as_py(), kind)


def nearest_terms(entities: DataFrame, terms: DataFrame, counted: bool = False) -> DataFrame:
    """entity_id, space, row_idx and score of the term of the same space with the largest cosine, the first of equals;
    if ``counted``, also pairs: how many terms the entity was compared with.

    entities: entity_id, space, vec; terms: row_idx, space, vec, and not_for (an entity_id that the term may not be
    matched with, or null).  Rows without a space or a vector, and vectors of length 0, match nothing.  Centres are
    fitted on some thousand terms of a space, cells hold all; a cell of many terms is met in chunks, so neither a
    space nor a cell is one key.  Vectors are shuffled as often as a space has shelves (entities) or blocks (terms).
    """
    ship(entities.sparkSession)
    kind = dict(terms.dtypes)["space"]
    packed = written(_packs(terms.where("vec IS NOT NULL AND space IS NOT NULL"), "row_idx", "row_idx", "not_for"))
    fitted = written(packed.where(F.col("pack") < SAMPLED).groupBy("space").applyInArrow(_fit, f"space {kind}, centres array<double>, cells int"))
    placed = written(packed.join(fitted, "space").mapInArrow(_assign, f"space {kind}, cell int, row_idx long, not_for long, vec array<double>, far double"))
    cells = placed.groupBy("space", "cell").agg(F.max("far").alias("radius"), F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    index = fitted.join(cells.groupBy("space").agg(F.sort_array(F.collect_list(F.struct("cell", "radius", "chunks"))).alias("x")), "space")
    index = written(index.select("space", "centres", "cells", F.col("x.cell").alias("cell"), F.col("x.radius").alias("radius"), F.col("x.chunks").alias("chunks")))
    dealt = placed.join(cells.select("space", "cell", "chunks"), ["space", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("row_idx"), F.col("chunks")).cast("int"))
    chunks = dealt.groupBy("space", "cell", "chunk").agg(F.sort_array(F.collect_list(F.struct("row_idx", "not_for", "vec"))).alias("rows"))
    chunks = written(chunks.select("space", "cell", "chunk", F.col("rows.row_idx").alias("row_idx"), F.col("rows.not_for").alias("not_for"), F.flatten("rows.vec").alias("flat")))

    result = f"entity_id long, space {kind}, row_idx long, score double, pairs long, near int"
    asked = entities.where("vec IS NOT NULL AND space IS NOT NULL").select("entity_id", "space", "vec")
    routed = _packs(asked, "entity_id", "entity_id").join(index, "space").mapInArrow(_route, f"space {kind}, cell int, chunk int, entity_id array<long>, mine array<double>")
    met = routed.join(chunks, ["space", "cell", "chunk"]).select("space", "cell", "entity_id", "mine", "row_idx", "not_for", "flat")
    start = written(met.mapInArrow(_match, result).groupBy("entity_id", "space").agg(*_least()))

    # all blocks with all shelves
    again = asked.join(start.select("entity_id", "space", F.col("score").alias("best"), "near"), ["entity_id", "space"], "left")
    blocks = written(_packs(again, "entity_id", "entity_id", "best", "near"))
    parts = lambda name: F.ceil(F.sum(F.size("flat").cast("long")) / TASK).cast("int").alias(name)
    shelves = chunks.groupBy("space").agg(parts("shelves"))
    deals = blocks.groupBy("space").agg(F.greatest(parts("n"), F.least(F.lit(SPLIT), F.count("*"))).cast("int").alias("deals"))
    sizes = written(shelves.join(deals, "space"))
    left = blocks.join(sizes, "space").withColumns({"deal": F.pmod("pack", "deals").cast("int"), "shelf": F.explode(F.sequence(F.lit(0), F.col("shelves") - 1))})
    right = chunks.join(sizes, "space").withColumns({"shelf": F.pmod(F.xxhash64("cell", "chunk"), "shelves").cast("int"), "deal": F.explode(F.sequence(F.lit(0), F.col("deals") - 1))})
    left = left.select("space", "shelf", "deal", "entity_id", "best", "near", "flat").groupBy("space", "shelf", "deal")
    right = right.select("space", "shelf", "deal", "cell", "chunk", "row_idx", "not_for", "flat").groupBy("space", "shelf", "deal")
    out = start.unionByName(left.cogroup(right).applyInArrow(_meet, result)).groupBy("entity_id", "space").agg(*_least())
    return out.select("entity_id", "space", "row_idx", "score", *(["pairs"] if counted else []))


def _least() -> list[Column]:
    """The best score, the first row that has it, and how many were compared."""
    top = F.max_by(F.struct("score", "row_idx"), F.struct(F.round("score", 12), -F.col("row_idx")))
    return [top["row_idx"].alias("row_idx"), top["score"].alias("score"), F.sum("pairs").alias("pairs"), F.max("near").alias("near")]
