import random

import pytest
from pyspark.sql import functions as F

from quillspan.operators import evaluation, hierarchy, linking


def tree(spark, pairs, kind="long"):
    return spark.createDataFrame(list(pairs), f"tax_id {kind}, parent_tax_id {kind}").repartition(3)


def plain(pairs):
    """(node, ancestor, depth) by walking up."""
    up = {}
    for n, p in sorted((n, p) for n, p in pairs if n is not None and p is not None and p != n):
        up.setdefault(n, p)
    out = set()
    for n in up:
        at, d, seen = n, 0, set()
        while at in up and up[at] not in seen:
            at, d = up[at], d + 1
            seen.add(at)
            out.add((n, at, d))
    return out


def forest(n, seed):
    rng = random.Random(seed)
    return [(i, rng.choice([i, None, 10_000 + i]) if i < 3 or rng.random() < 0.05 else rng.randrange(max(0, i - 30), i)) for i in range(n)]


@pytest.mark.parametrize("pairs", [forest(300, 1), [(1, 1)], [(i, 0) for i in range(50)], [(1, 2), (2, 3), (3, 1), (4, 1), (5, 5), (6, 5)], [(1, None), (None, 1), (2, 1), (2, 1)]], ids=["forest", "root", "star", "circle", "nulls"])
def test_ancestors_and_intervals(spark, pairs):
    assert {tuple(r) for r in hierarchy.ancestors(tree(spark, pairs)).collect()} == plain(pairs)
    rows = {r["tax_id"]: r for r in hierarchy.intervals(tree(spark, pairs)).collect()}
    nodes = {n for n, _ in pairs if n is not None}
    assert set(rows) == nodes
    up = {x for x in plain(pairs) if x[1] in nodes}
    circling = {n for n, a, _ in up if (a, a) in {(x, y) for x, y, _ in up}}
    for n in nodes:
        r = rows[n]
        if n in circling:
            assert r["first"] is None and r["size"] is None and r["root"] is None
            continue
        assert r["depth"] == max((d for m, _, d in up if m == n), default=0)
        assert r["size"] == 1 + sum(a == n for _, a, _ in up) and r["last"] == r["first"] + r["size"] - 1
    below = {(a, b) for a in nodes - circling for b in nodes - circling if rows[a]["root"] == rows[b]["root"] and rows[b]["first"] < rows[a]["first"] <= rows[b]["last"]}
    assert below == {(n, a) for n, a, _ in up if n not in circling}
    assert len({(r["root"], r["first"]) for r in rows.values() if r["first"] is not None}) == len(nodes - circling)


def test_a_chain_of_ten_thousand(spark):
    chain = spark.range(10_000).select(F.col("id").cast("string").alias("tax_id"), F.when(F.col("id") > 0, (F.col("id") - 1).cast("string")).alias("parent_tax_id"))
    rows = hierarchy.intervals(chain).collect()
    assert all(r["depth"] == r["first"] == int(r["tax_id"]) and r["last"] == 9999 and r["root"] == "0" for r in rows) and len(rows) == 10_000


def test_ancestors_of_a_deep_chain(spark):
    chain = tree(spark, [(i, i - 1) for i in range(1, 700)], "int")
    assert hierarchy.ancestors(chain).agg(F.count("*"), F.sum("depth")).first() == (699 * 700 // 2, sum(d * (700 - d) for d in range(1, 700)))


def test_is_below(spark):
    row = spark.range(1).select(hierarchy.is_below(F.lit(3), F.lit(1), F.lit(3)), hierarchy.is_below(F.lit(1), F.lit(1), F.lit(3)), hierarchy.is_below(F.lit(4), F.lit(1), F.lit(3))).first()
    assert tuple(row) == (True, False, False)


def test_first_of_a_key_without_one_task(spark):
    """Most rows have no key, a third has one key: neither meets in one task."""
    rows = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, F.col("id").cast("string")).alias("key"))
    classes = spark.createDataFrame([("hot", "C"), ("1", "D"), (None, "X")], "key string, cls string")
    out = linking.attach_once(rows, classes, "key", "id")
    got = {r["id"]: r["cls"] for r in out.where("cls IS NOT NULL").collect()}
    assert got == {0: "C", 1: "D"} and out.count() == 30_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = [r["count"] for r in linking.attach_once(rows, classes, "key", "id").groupBy(F.spark_partition_id()).count().collect()]
        assert max(tasks) < 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_more_labels_than_a_thousand(spark):
    outcomes = spark.range(1100).selectExpr("CAST(id AS STRING) AS actual", "CAST(id % 7 AS STRING) AS predicted").union(spark.createDataFrame([(None, "0")], "actual string, predicted string"))
    out = evaluation.confusion(outcomes)
    assert out.count() == 1101**2 and out.agg(F.sum("n")).first()[0] == 1101
    assert out.where("n > 0").count() == 1101


@pytest.mark.parametrize("circles", [False, True])
def test_paths_in_stretches(spark, monkeypatch, circles):
    """Pairs are put together from rows of paths, which many nodes ask for: no pair is written."""
    monkeypatch.setattr(hierarchy, "STRETCH", 4)
    monkeypatch.setattr(hierarchy, "ASKING", 8)
    pairs = [*forest(400, 3), *((2000 + i, 2000 + (i + 1) % 5) for i in range(5)), *((3000 + i, 2000 if i == 0 else 2999 + i) for i in range(9))][: None if circles else 400]
    rows, write = [], hierarchy.written

    def watched(df):
        out = write(df)
        if "ancestor" in df.columns:
            rows.append(out.count())
        return out

    monkeypatch.setattr(hierarchy, "written", watched)
    found = [tuple(r) for r in hierarchy.ancestors(tree(spark, pairs)).collect()]
    assert len(found) == len(set(found)) and set(found) == plain(pairs)
    assert max(rows, default=0) <= (14 * 14 if circles else 0)


def test_no_table_of_nodes_passes_through_the_driver(spark, monkeypatch):
    plans, write = [], hierarchy.written
    monkeypatch.setattr(hierarchy, "written", lambda df: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or write(df))
    out = hierarchy.intervals(tree(spark, forest(60, 2)))
    plans.append(out._jdf.queryExecution().sparkPlan().toString())
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_pairs_come_out_in_blocks(spark, monkeypatch):
    """Nodes at nearly one depth come out together for each ancestor, so files of pairs are small; those that are too many are shared out."""
    monkeypatch.setattr(hierarchy, "STRETCH", 32)
    monkeypatch.setattr(hierarchy, "ASKING", 100)
    pairs = [(i, i - 1) for i in range(1, 150)] + [(1000 * k + i, i) for k in range(1, 8) for i in range(150)]
    found = [tuple(r) for r in hierarchy.ancestors(tree(spark, pairs)).collect()]
    assert len(found) == len(set(found)) and set(found) == plain(pairs)
    assert sum(x[1] != y[1] for x, y in zip(found, found[1:], strict=False)) < len(found) / 5
