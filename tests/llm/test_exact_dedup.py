import hashlib
import re

import pytest

from quillspan.llm.exact_dedup import exact_dedup, group_copies, digests, without_copies


def brute(rows):
    groups = {}
    for doc, text in rows:
        s = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", "", text or "").encode()).hexdigest()
        groups.setdefault(s, []).append((-len(text or ""), doc is None, doc))
    out = []
    for s, g in groups.items():
        best = min(g, key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(doc, best[2], len(g), doc == best[2] and n == best[0], s) for n, _, doc in g]
    return sorted(out, key=repr)


ROWS = [(i, "same text") for i in range(50, 90)] + [(3, "same  text"), (2, "same\ttext "), (7, None), (8, ""), (9, " \n"), (10, "x" * 200_000), (11, "é"), (12, "é "), (None, "samet ext"), (13, "unique"), (14, "a\x1fb")]


@pytest.mark.parametrize("options", [{}, {"heavy": 1, "capacity": 64}])
def test_agrees_with_brute_force(spark, options):
    df = spark.createDataFrame([(a, b, 1, "y") for a, b in ROWS], "doc_id long, text string, group_size int, text_sha256 string").repartition(5)
    got = exact_dedup(df, **options).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute(ROWS)


def test_light_and_heavy_paths_agree(spark):
    rows = [(i, f"t{i * i % 37}") for i in range(400)]
    keys = digests(spark.createDataFrame(rows, "doc_id long, text string"))
    a, b = (sorted(map(tuple, group_copies(keys, heavy=h, capacity=c).collect())) for h, c in ((1, 64), (64, 256)))
    assert a == b == sorted(brute(rows))


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "bb")], "doc_id long, text string")
    assert [tuple(r) for r in without_copies(df).orderBy("doc_id").collect()] == [(1, "a"), (2, "bb")]
    assert {(r["doc_id"], r["group_size"], r["kept"]) for r in exact_dedup(df).collect()} == {(1, 3, True), (2, 3, False), (2, 1, True)}
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup(none).count() == 0 and without_copies(none).count() == 0


def test_kept_rows_have_all_columns(spark):
    df = spark.createDataFrame([(5, "a b", 1, "n"), (4, "ab", 2, "m"), (None, "zz", 3, None)], "doc_id long, text string, kept int, n string")
    assert sorted(map(tuple, without_copies(df).collect()), key=repr) == sorted([(5, "a b", 1, "n"), (None, "zz", 3, None)], key=repr)
