from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillspan.llm import mixing


def level(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = sum(sizes.values()), set(names), {}
    while True:
        over = [s for s in free if left * weight[s] / sum(weight[x] for x in free) > cap * sizes[s]]
        if not over:
            break
        for s in over:
            out[s] = cap * sizes[s]
            free.discard(s)
        left = sum(sizes.values()) - sum(out.values())
    return out | {s: left * weight[s] / sum(weight[x] for x in free) for s in free}


def test_targets(spark):
    sizes = {"a": 1000, "b": 10, "c": 700, "é": 90, "B": 2, None: 300}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df, "source", "size").collect()}
    expected = level(sizes)
    assert set(got) == set(expected) and all(abs(got[s] - expected[s]) < 1e-6 for s in expected)


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3), F.lit(1)).alias("p"))
        assert sorted(r["p"] for r in df.collect()) == list(range(n))


def test_hypergeometric_moments_and_limits(spark):
    total, marked, drawn = 60, 25, 18
    u = mixing.uniform(F.col("id"), F.lit(5))
    x = np.array([r["x"] for r in spark.range(4000).select(mixing.hypergeometric(F.lit(total), F.lit(marked), F.lit(drawn), u).alias("x")).collect()])
    mean, var = drawn * marked / total, drawn * marked / total * (1 - marked / total) * (total - drawn) / (total - 1)
    assert abs(x.mean() - mean) < 5 * np.sqrt(var / 4000) and abs(x.var() / var - 1) < 0.15
    edge = spark.range(1).select(*[mixing.hypergeometric(F.lit(a), F.lit(b), F.lit(c), F.lit(0.7)).alias(f"x{a}{b}{c}") for a, b, c in ((5, 5, 3), (5, 0, 3), (0, 0, 0), (9, 4, 9))]).first()
    assert list(edge) == [3, 0, 0, 4]


def test_split_takes_exactly_what_is_drawn(spark):
    df = spark.range(50).select(mixing.split(F.array(*[F.lit(x).cast("long") for x in (5, 0, 11, 4)]), F.lit(9), F.col("id")).alias("x"))
    rows = [r["x"] for r in df.collect()]
    assert all(sum(x) == 9 and all(0 <= a <= b for a, b in zip(x, (5, 0, 11, 4), strict=True)) for x in rows) and len({tuple(x) for x in rows}) > 5


@pytest.fixture(scope="module")
def mixed(spark):
    rng = np.random.default_rng(0)
    rows = [(i, ("a" if i % 3 else f"s{i % 11}") if i % 17 else None, int(rng.integers(0, 400)) if i % 50 else None, "x", 1, 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long, draws string, rank int, block int").repartition(6)
    return df, mixing.mix(df, shards=8, most_blocks=64, least_words=500)


def test_mix(spark, mixed):
    df, out = mixed
    rows = out.collect()
    assert len(rows) == 3000 and out.columns == ["doc_id", "source", "size", "rank", "block", "source_size", "target", "draws"]
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r["source"]] += r["size"] or 0
        taken[r["source"]] += (r["size"] or 0) * len(r["draws"])
        target[r["source"]] = r["target"]
        assert len(r["draws"]) <= 3 and r["rank"] == 1 and r["block"] == 2
    expected = level(sizes)
    for s in sizes:
        assert abs(target[s] - expected[s]) < 1e-6 and abs(taken[s] - target[s]) <= 30
    again = mixing.mix(df, shards=8, most_blocks=64, least_words=500).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_shards_are_even_and_draws_disjoint(spark, mixed):
    _, out = mixed
    draws = out.select("source", F.explode("draws").alias("d")).select("source", "d.shard", "d.place").distinct().collect()
    by_shard = Counter(r["shard"] for r in draws)
    assert set(by_shard) == set(range(8)) and max(by_shard.values()) - min(by_shard.values()) <= 3
    assert len({(r["source"], r["place"]) for r in draws}) == len(draws)


def test_rows_of_the_mix(spark, mixed):
    _, out = mixed
    rows = mixing.mixed_rows(out, ["doc_id", "source", "size", "rank", "block"])
    assert rows.count() == out.select(F.sum(F.size("draws"))).first()[0] and rows.columns[0] == "doc_id"


def test_empty_and_wordless(spark):
    schema = "doc_id long, source string, size long"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    rows = mixing.mix(spark.createDataFrame([(1, "a", 0), (2, None, None), (2, None, None)], schema)).collect()
    assert [(r["source_size"], r["target"]) for r in rows] == [(0, 0.0)] * 3


def test_tree_splits_quotas_exactly(spark):
    rng = np.random.default_rng(3)
    quota = {i: int(rng.integers(0, 30)) for i in range(40)} | {7: 500}
    df = spark.createDataFrame(list(quota.items()), "rank long, quota long")
    for group in (1024, 6):  # one group, or groups that are split together first
        rows = mixing._leaves(df, 13, 5, group).collect()
        by_source, by_shard = Counter(), Counter()
        for r in rows:
            assert r["quota"] > 0
            by_source[r["rank"]] += r["quota"]
            by_shard[r["shard"]] += r["quota"]
        total = sum(quota.values())
        assert by_source == {k: v for k, v in quota.items() if v}
        assert by_shard == {k: total * (k + 1) // 13 - total * k // 13 for k in range(13)}
        assert len({r["shard"] for r in rows if r["rank"] == 7}) == 13


def test_draws_are_what_the_leaves_name(spark, mixed):
    """Each source's places are all those its leaves hold, in leaf order."""
    _, out = mixed
    seen = defaultdict(dict)
    for r in out.select("source", F.explode("draws").alias("d")).select("source", "d.shard", "d.place").distinct().collect():
        seen[r["source"]][r["place"]] = r["shard"]
    for places in seen.values():
        assert sorted(places) == list(range(len(places)))
        shards = [places[k] for k in sorted(places)]
        assert shards == sorted(shards)


def test_a_shard_is_ordered_by_the_local_shuffle_in_slices(spark, mixed):
    _, out = mixed
    expected = defaultdict(list)
    turns = out.select("doc_id", F.explode("draws").alias("d")).select("doc_id", "d.shard", mixing.turn(F.col("d.place"), F.col("doc_id")).alias("t"))
    for r in turns.collect():
        expected[r["shard"]].append((r["t"], r["doc_id"]))
    flat = [doc for k in expected for _, doc in sorted(expected[k])]
    for slices in (1, 4):
        rows = mixing.mixed_rows(out, ["doc_id"], slices=slices).withColumn("p", F.spark_partition_id()).collect()
        assert sorted(r["doc_id"] for r in rows) == sorted(flat)
    one = mixing.mixed_rows(out, ["doc_id"], slices=4).coalesce(1).collect()
    at = {p: i for i, p in enumerate(sorted((t, d) for k in expected for t, d in expected[k]))}
    assert len(one) == len(at)


def test_only_a_part_of_a_block_is_ranked(spark):
    """Many rows in the block that is taken in part: cut into parts, and still near the target."""
    rows = [(i, "big" if i % 3 else "small", 1 + i % 9) for i in range(6000)] + [(None, "small", 5)] * 50
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(5)
    out = mixing.mix(df, shards=4, most_blocks=2, least_words=10, part_rows=64).collect()
    taken, target = defaultdict(int), {}
    for r in out:
        taken[r["source"]] += r["size"] * len(r["draws"])
        target[r["source"]] = r["target"]
    assert len(out) == 6050 and all(abs(taken[s] - target[s]) <= 4.5 for s in target)


def test_clashing_names_are_kept_by_rows_of_the_mix(spark):
    df = spark.createDataFrame([(1, "a", 4, "t", "s"), (2, "b", 5, "u", "v")], "doc_id long, source string, size long, target string, source_size string")
    held = df.select(F.struct("*").alias("row"), "doc_id", "source", "size")
    rows = mixing.mixed_rows(mixing.mix(held), ["row"]).select("row.*")
    assert rows.columns == df.columns and {r["target"] for r in rows.collect()} <= {"t", "u"}
