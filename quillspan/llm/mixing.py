"""Mixing sources to target weights: built-in functions only.

Every source is dealt into blocks of documents by a hash.  How many blocks of each source the mix takes is its
quota; a binary tree over the output shards splits the vector of quotas again and again by multivariate
hypergeometric draws, so each shard's share of each source is exact and random.  A leaf's quota is then a range
of the source's blocks in permuted order, disjoint from every other leaf's: what no leaf names is not taken.
Within a shard rows are ordered by a hash.

Decisions are made on blocks, of which there is a bounded number, and on ids and sizes of the rows of one small part of one block of a source,
which is taken in part; texts meet them by joins with tables of checked size.  Sources may be many: they are ranked in
ranges, levelled by aggregates, and split in groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import cut, power_of_two, small

ROUNDS = 40


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def uniform(*parts: Column) -> Column:
    """A double in [0, 1) that depends on the parts alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)).cast("double") / F.lit(float(1 << 53))


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """The place of x < n in a pseudo-random permutation of 0..n-1: swap-or-not rounds, a bijection for any n."""

    def swap(at: Column, turn: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, turn), n) - at, n)
        return F.when(F.xxhash64(*key, turn, F.greatest(at, other)).bitwiseAND(F.lit(1)) == 1, other).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("long"), swap)


def _log_factorial(x: Column) -> Column:
    """Stirling's series for ln(x!), shifted by four, good to 1e-9."""
    y = x + 4.0
    series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y)
    return series - F.log((x + 1.0) * (x + 2.0) * (x + 3.0))


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` out of ``total`` are among the ``marked``, by inversion at the uniform u.

    Terms over ten standard deviations off the mean (in all less than 1e-20) are left out.
    """

    def sample(s: Column) -> Column:
        n, k, m = s["total"], s["marked"], s["drawn"]
        mean = m * k / F.greatest(n, F.lit(1.0))
        spread = 10 * F.sqrt(F.greatest(mean * (n - k) / F.greatest(n, F.lit(1.0)) * (n - m) / F.greatest(n - 1, F.lit(1.0)), F.lit(0.0))) + 2
        lo = F.greatest(F.lit(0.0), m - (n - k), F.floor(mean - spread)).cast("long")
        hi = F.least(k, m, F.ceil(mean + spread)).cast("long")

        def weights(j: Column) -> Column:
            x = j.cast("double")
            return -(_log_factorial(x) + _log_factorial(k - x) + _log_factorial(m - x) + _log_factorial(n - k - m + x))

        def pick(logs: Column) -> Column:
            def choose(w: Column) -> Column:
                aim = s["u"] * F.aggregate(w, F.lit(0.0), lambda a, x: a + x)
                start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("i"))

                def step(a: Column, x: Column) -> Column:
                    on = a["sum"] + x <= aim
                    return F.struct(F.when(on, a["sum"] + x).otherwise(F.lit(1e300)).alias("sum"), F.when(on, a["i"] + 1).otherwise(a["i"]).alias("i"))

                return F.least(lo + F.aggregate(w, start, step, lambda a: a["i"]), hi)

            return let(F.transform(logs, lambda x: F.exp(x - F.array_max(logs))), choose)

        return let(F.transform(F.sequence(lo, hi), weights), pick)

    drawn_from = F.struct(total.cast("double").alias("total"), marked.cast("double").alias("marked"), drawn.cast("double").alias("drawn"), u.alias("u"))
    return let(drawn_from, sample)


def split(quotas: Column, drawn: Column, *key: Column) -> Column:
    """A multivariate hypergeometric draw: an array that takes ``drawn`` in all from the quotas."""
    start = F.struct(
        F.aggregate(quotas, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"),
        drawn.cast("long").alias("drawn"),
        F.lit(0).cast("long").alias("i"),
        F.array().cast("array<bigint>").alias("out"),
    )

    def step(a: Column, quota: Column) -> Column:
        x = hypergeometric(a["total"], quota, a["drawn"], uniform(*key, a["i"]))
        return let(
            x,
            lambda got: F.struct(
                (a["total"] - quota).alias("total"), (a["drawn"] - got).alias("drawn"), (a["i"] + 1).alias("i"), F.concat(a["out"], F.array(got)).alias("out")
            ),
        )

    return F.aggregate(quotas, start, step, lambda a: a["out"])


def targets(sized: DataFrame, source_col: str, size_col: str, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """source, source_size, rank (from 0) and target of each source.

    Sources in code point order, null last, have the weights in turn and share the sum of all sizes by them;
    no target exceeds ``cap`` times its source's size, and what is over goes to the others by weight, until none is
    above.  Sources are ranked by a distributed sort and its partitions' sizes; each turn of resharing is an aggregate.
    """
    by = sized.groupBy(F.col(source_col).alias("source")).agg(F.sum(size_col).cast("long").alias("source_size"))
    ordered = cut(by.orderBy(F.asc_nulls_last("source")).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    before, seen = [], 0
    for row in ordered.groupBy(part.alias("part")).count().orderBy("part").collect():  # a row for each partition
        before.append((row["part"], seen))
        seen += row["count"]
    base = F.broadcast(ordered.sparkSession.createDataFrame(before, "part long, base long"))
    ranked = ordered.withColumn("part", part.cast("long")).join(base, "part").withColumn("rank", F.col("base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    table = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    ranked = ranked.select("source", "source_size", "rank", F.get(table, F.pmod("rank", F.lit(len(weights))).cast("int")).alias("weight"), (F.col("source_size") * cap).alias("most"))
    wide = lambda x: x.cast("decimal(19,0)")
    left, weight, full = 0, 0, -1
    while True:  # the level only rises, so those that are full only get more
        over = wide(F.col("most")) * wide(F.lit(weight)) <= wide(F.lit(left)) * wide(F.col("weight")) if weight else F.lit(False)
        n, sums, rest, every = ranked.agg(
            F.count_if(over), F.sum(F.when(over, F.col("most")).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight"))), F.sum("source_size")
        ).first()
        if n == full:
            break
        full, left, weight = n, (every or 0) - (sums or 0), rest or 0
        if not weight:
            break
    over = wide(F.col("most")) * wide(F.lit(weight)) <= wide(F.lit(left)) * wide(F.col("weight")) if weight else F.lit(True)
    target = F.when(over, F.col("most").cast("double")).otherwise(F.least(F.lit(float(left)) * F.col("weight") / F.lit(float(max(weight, 1))), F.col("most").cast("double")))
    return ranked.select("source", "source_size", "rank", F.coalesce(target, F.lit(0.0)).alias("target"))


def _blocks(sums: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """For each block (rank, block, words, n_rows): the draws it is in, and whether the last pass takes a part of it."""
    by_source = Window.partitionBy("rank")
    blocks = sums.select("*", (F.row_number().over(by_source.orderBy("block")) - 1).cast("long").alias("i"), F.count("*").over(by_source).alias("n"))
    blocks = blocks.join(small(plan), "rank")
    key = F.lit(seed), F.col("rank")
    blocks = blocks.withColumn("at", permuted(F.col("i"), F.col("n"), *key, F.col("passes")))
    before = F.coalesce(F.sum("words").over(by_source.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = F.when(F.col("passes") > 0, F.transform(F.sequence(F.lit(0), F.col("passes").cast("int") - 1), lambda p: p.cast("long") * F.col("n") + permuted(F.col("i"), F.col("n"), *key, p.cast("long"))))
    blocks = blocks.withColumn("before", before).withColumn("whole", F.coalesce(whole, F.array().cast("array<bigint>")))
    last = F.col("passes") * F.col("n") + F.col("at")
    return blocks.select(
        "rank",
        "block",
        "n_rows",
        F.when(F.col("before") + F.col("words") <= F.col("rest"), F.concat("whole", F.array(last))).otherwise(F.col("whole")).alias("draws"),
        F.when((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")), last).alias("part"),
        (F.col("rest") - F.col("before")).alias("room"),
    )


def _descend(nodes: DataFrame, shards: int, seed: int) -> DataFrame:
    """key, leaf, name and quota: the splitting tree over the leaves of each row of nodes.

    nodes: key, items (name, quota) and leaves (leaf, quota), in order, whose quotas have the same sum.  A node's left child has
    the first half of its leaves and what a multivariate hypergeometric draw of their sum takes of its items; what has no
    quota is left out, so no level has more entries than there are draws.
    """
    half = F.shiftright(F.size("leaves") + 1, 1)
    left = F.slice("leaves", 1, half)
    drawn = F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x["quota"])
    took = split(F.transform("items", lambda x: x["quota"]), drawn, F.lit(seed), F.col("key"), F.get("leaves", F.lit(0))["leaf"], F.size("leaves"))
    some = lambda a: F.filter(a, lambda x: x["quota"] > 0)

    def children(got: Column) -> Column:
        pairs = F.zip_with("items", got, lambda x, n: F.struct(x["name"].alias("name"), x["quota"].alias("quota"), n.alias("n")))
        return let(
            pairs,
            lambda p: F.array(
                F.struct(F.transform(p, lambda x: F.struct(x["name"].alias("name"), x["n"].alias("quota"))).alias("items"), left.alias("leaves")),
                F.struct(F.transform(p, lambda x: F.struct(x["name"].alias("name"), (x["quota"] - x["n"]).alias("quota"))).alias("items"), F.slice("leaves", half + 1, F.size("leaves")).alias("leaves")),
            ),
        )

    both = F.when(F.size("leaves") > 1, let(took, children)).otherwise(F.array(F.struct("items", "leaves")))
    nodes = nodes.where(F.size("leaves") > 0)
    for _ in range((shards - 1).bit_length()):
        nodes = nodes.select("key", F.explode(both).alias("c")).select("key", some(F.col("c.items")).alias("items"), "c.leaves").where(F.size("items") > 0)
    return nodes.select("key", F.get("leaves", F.lit(0))["leaf"].alias("leaf"), F.explode("items").alias("x")).select("key", "leaf", "x.name", "x.quota")


def _leaves(quotas: DataFrame, shards: int, seed: int, group: int = 1024) -> DataFrame:
    """rank, shard and quota: each shard's share of each source's quota (rank, quota).

    Sources are split as ``group`` of them together first, then each group by itself, which is the same draw; so no row
    holds more than a group, or a total for each group.
    """
    entry = F.array_sort(F.collect_list(F.struct(F.col("rank").alias("name"), "quota")))
    groups = cut(quotas.where("quota > 0").groupBy(F.floor(F.col("rank") / group).alias("key")).agg(entry.alias("items"), F.sum("quota").alias("quota")))
    tops = groups.agg(F.array_sort(F.collect_list(F.struct(F.col("key").alias("name"), "quota"))).alias("items"))
    total = F.aggregate("items", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
    upto = lambda k: F.floor(total * k.cast("double") / shards)
    leaves = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda k: F.struct(k.alias("leaf"), (upto(k + 1) - upto(k)).alias("quota")))
    top = tops.select(F.lit(-1).cast("long").alias("key"), "items", F.filter(leaves, lambda x: x["quota"] > 0).alias("leaves"))
    if groups.count() > 1:
        ends = cut(_descend(top, shards, seed)).groupBy(F.col("name").alias("key")).agg(F.array_sort(F.collect_list(F.struct("leaf", "quota"))).alias("leaves"))
    else:  # all of every leaf is the one group's
        ends = top.select(F.lit(0).cast("long").alias("key"), "leaves")
    return _descend(groups.select("key", "items").join(ends, "key"), shards, seed + 1).select(F.col("name").alias("rank"), F.col("leaf").alias("shard"), "quota")


def _drawn(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """For each block that is taken: its draws and its last one, if that takes a part, as (shard, place)."""
    each = blocks.select("rank", "block", F.explode(F.concat(F.transform("draws", lambda d: F.struct(d.alias("d"), F.lit(False).alias("part"))), F.transform(F.array_compact(F.array("part")), lambda d: F.struct(d.alias("d"), F.lit(True).alias("part"))))).alias("x"))
    each = each.select("rank", "block", "x.d", "x.part")
    leaves = _leaves(each.groupBy("rank").agg(F.count("*").alias("quota")), shards, seed)
    end = F.sum("quota").over(Window.partitionBy("rank").orderBy("shard"))
    places = leaves.withColumn("end", end).select("rank", "shard", F.explode(F.sequence(F.col("end") - F.col("quota"), F.col("end") - 1)).alias("d"))
    draw = F.struct("shard", F.col("d").alias("place"))
    # a source's draws are numbered without a gap: full passes first, then the last one in permuted order
    met = each.join(places, ["rank", "d"])
    return met.groupBy("rank", "block").agg(
        F.array_sort(F.collect_list(F.when(~F.col("part"), draw))).alias("draws"), F.array_sort(F.collect_list(F.when(F.col("part"), draw))).alias("last")
    )


def _fill(part: DataFrame, seed: int, tries: int = 8) -> DataFrame:
    """Which rows of a part the mix takes: rank, id, size, taken.

    part: rank, id, size, n (rows that are equal in these) and gap, the words that are still to come.  In hash order
    what fits, then three times the largest of those that still fit, then the row nearest to the last gap if that
    brings the sum closer; of several hash orders the one that ends nearest counts.
    """
    part = part.withColumn("try", F.explode(F.sequence(F.lit(1), F.lit(tries))))
    part = part.withColumns({"got": F.lit(False), "all": F.col("size") * F.col("n"), "left": F.col("gap")})
    by = Window.partitionBy("rank", "try")
    turns = [F.xxhash64("id", "try", F.lit(seed)), *[F.desc("all")] * 3]
    for first in turns:
        order = by.orderBy(first, "id", "size")
        fits = ~F.col("got") & (F.col("all") <= F.col("left"))
        part = part.withColumn("sum", F.sum(F.when(fits, F.col("all")).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        part = part.withColumn("take", fits & (F.col("sum") <= F.col("left")))
        part = part.withColumns({"got": F.col("got") | F.col("take"), "left": F.col("left") - F.max(F.when(F.col("take"), F.col("sum")).otherwise(0)).over(by)})
    miss = F.when(~F.col("got") & (F.col("all") < 2 * F.col("left")), F.abs(F.col("all") - F.col("left")))
    part = part.withColumns({"miss": miss, "near": F.row_number().over(by.orderBy(F.asc_nulls_last(miss), "id", "size"))})
    part = part.withColumn("taken", F.col("got") | ((F.col("near") == 1) & F.col("miss").isNotNull()))
    off = F.abs(F.col("gap") - F.sum(F.when(F.col("taken"), F.col("all")).otherwise(0)).over(by))
    best = F.min(F.struct("off", "try")).over(Window.partitionBy("rank"))
    part = part.withColumn("off", off).withColumn("best", best)
    return part.where(F.col("try") == F.col("best.try")).select("rank", "id", "size", "taken")


def mix(
    sized: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    size_col: str = "size",
    weights: tuple[int, ...] = (1, 2, 3),
    cap: int = 3,
    shards: int | None = None,
    most_blocks: int = 16_384,
    least_words: int = 65_536,
    shard_words: int = 1 << 24,
    part_rows: int = 4096,
    seed: int = 7,
) -> DataFrame:
    """sized with source_size, target and draws: the (shard, place) of each copy of a row that the mix takes.

    A source's words come to its target but for less than half of its smallest documents, as a rule.  A row is in no more than ``cap`` draws
    (cap - 1 whole passes and a partial one, or cap whole ones).  By default there is a shard for every shard_words, 8 at
    least.  Null sources are one source; null sizes count as 0; rows that repeat an id and a size are taken together; null ids are
    dealt by size.  The three new columns replace given ones of the same name.  The same rows give the same draws.
    """
    given = [c for c in sized.columns if c.lower() not in ("source_size", "target", "draws")]
    # the columns that came travel in one, so none of their names can clash with those used here
    size = F.coalesce(F.col(size_col), F.lit(0)).cast("long")
    keys = F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size")
    lean = cut(sized.select(*keys))
    goals = targets(lean, "source", "size", weights, cap)
    total = goals.agg(F.sum("source_size")).first()[0] or 0
    shards = shards or power_of_two(total / shard_words, 8, 1 << 12)
    words = max(least_words, -(-total // max(most_blocks, 4 * shards)))
    passes = F.floor(F.try_divide(F.col("target"), F.col("source_size")) + 1e-12)
    plan = goals.select(
        "*",
        F.greatest(F.lit(1), F.ceil(F.col("source_size") / words)).cast("long").alias("deal"),
        F.coalesce(passes, F.lit(0)).cast("long").alias("passes"),
    ).withColumn("rest", F.greatest(F.col("target") - F.col("passes") * F.col("source_size"), F.lit(0.0)))
    plan = small(plan.withColumnRenamed("source", "of"))

    def deal(rows: DataFrame) -> DataFrame:
        block = F.pmod(F.xxhash64("id", F.when(F.col("id").isNull(), F.col("size")), F.lit(seed)), F.col("deal"))
        return rows.join(plan, F.col("source").eqNullSafe(F.col("of"))).withColumn("block", block)

    dealt = deal(lean)
    blocks = cut(_blocks(dealt.groupBy("rank", "block").agg(F.sum("size").cast("long").alias("words"), F.count("*").alias("n_rows")), plan.select("rank", "passes", "rest"), seed))
    drawn = small(cut(_drawn(blocks, shards, seed)), 8 * most_blocks)
    # the one block of a source that is taken in part is cut once more: into parts that fit in whole, one that is
    # filled by rows, and others that stay out; only ids and sizes of the middle one are ranked
    torn = small(blocks.where("part IS NOT NULL").select("rank", F.col("block").alias("torn"), "room", F.ceil(F.col("n_rows") / part_rows).alias("parts")))
    sub = F.pmod(F.xxhash64("id", "size", F.lit(seed + 1)), F.col("parts"))
    inside = dealt.select("rank", "block", "id", "size").join(torn, "rank").where("block = torn").withColumn("sub", sub)
    counted = cut(inside.groupBy("rank", "sub", "room", "id", "size").agg(F.count("*").alias("n")))
    by_sub = counted.groupBy("rank", "sub", "room").agg(F.sum(F.col("size") * F.col("n")).alias("words"))
    by_sub = by_sub.withColumn("upto", F.sum("words").over(Window.partitionBy("rank").orderBy("sub"))).where("upto > room")
    edges = by_sub.groupBy("rank").agg(F.min_by(F.struct("sub", (F.col("room") - F.col("upto") + F.col("words")).alias("gap")), "sub").alias("x"))
    edges = small(cut(edges.select("rank", F.col("x.sub").alias("edge"), F.col("x.gap").alias("gap"))))
    filled = cut(_fill(counted.join(edges, "rank").where("sub = edge").select("rank", "id", "size", "n", "gap"), seed + 2).where("taken"))
    filled = small(filled.select(F.col("rank").alias("_rank"), F.col("id").alias("_id"), F.col("size").alias("_size"), "taken"), 200_000)
    met = deal(sized.select(F.struct(*given).alias("row"), *keys)).select("row", "id", "size", "source_size", "target", "rank", "block")
    met = met.join(drawn, ["rank", "block"], "left").join(torn, "rank", "left").join(edges, "rank", "left").withColumn("sub", sub)
    met = met.join(filled, (F.col("rank") == F.col("_rank")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("size") == F.col("_size")), "left")
    late = F.col("block").eqNullSafe(F.col("torn")) & ((F.col("sub") < F.col("edge")) | ((F.col("sub") == F.col("edge")) & F.coalesce("taken", F.lit(False))))
    draws = F.when(F.coalesce(late, F.lit(False)), F.concat("draws", "last")).otherwise(F.col("draws"))
    return met.select("row.*", "source_size", "target", F.coalesce(draws, F.array().cast("array<struct<shard:int,place:bigint>>")).alias("draws"))


def turn(place: Column, row_id: Column, seed: int = 7) -> Column:
    """Where in its shard's order a copy of a row comes: the local shuffle."""
    return F.xxhash64(row_id, place, F.lit(seed))


def mixed_rows(mixed: DataFrame, columns: list[str], id_col: str = "doc_id", slices: int = 1, seed: int = 7) -> DataFrame:
    """The rows of the mix with the given columns, copies repeated, by shard and shuffled within each.

    A shard's order is cut into ``slices`` ranges that tasks write by themselves, so no shard is one task.
    """
    rows = mixed.select(F.struct(*columns).alias("row"), F.col(id_col).alias("id"), F.explode("draws").alias("draw"))
    rows = rows.select("row", F.col("draw.shard").alias("shard"), turn(F.col("draw.place"), F.col("id"), seed=seed).alias("turn"))
    rows = rows.withColumn("slice", F.floor((F.shiftright("turn", 32) + (1 << 31)) * slices / float(1 << 32)).cast("int"))
    return rows.repartition("shard", "slice").sortWithinPartitions("shard", "slice", "turn").select("row.*")
