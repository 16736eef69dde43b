import numpy as np
import pytest

from helpers import word_list
from quillspan.llm.components import components
from quillspan.llm.jaccard_join import similar_documents

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=4):
    w = word_list((text or "").translate(LOW))
    k = min(n, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if k else frozenset()


def brute(rows, percent=85):
    ids = sorted({doc for doc, _ in rows if doc is not None})
    label = {doc: doc for doc in ids}
    sets = [(doc, shingles(t)) for doc, t in rows]

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            common = len(s & t)
            if s and t and i is not None and j is not None and 100 * common >= percent * (len(s) + len(t) - common):
                x, y = find(i), find(j)
                label[max(x, y)] = min(x, y)
    return sorted(((doc, len(s), None if doc is None else find(doc)) for doc, s in sets), key=repr)


def corpus(seed, n_words=400):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(n_words)]
    rows = []
    for size in (30, 60, 150):
        base = list(rng.choice(words, size))
        for rate in (0, 0, 0.002, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.2) * 3:
            copy = [str(rng.choice(words)) if rng.random() < rate else w for w in base]
            cut = int(rng.integers(0, 4)) if rate else 0
            rows.append(" ".join(copy[cut:]))
        chain = base  # each near the one before, the ends far apart
        for _ in range(12):
            chain = chain[2:] + list(rng.choice(words, 2))
            rows.append(" ".join(chain))
    passage = " ".join(rng.choice(words, 40))
    rows += [passage + " " + " ".join(rng.choice(words, 25)) for _ in range(40)]
    rows += [" ".join(rng.choice(words, int(rng.integers(1, 60)))) for _ in range(60)]
    rows += ["a b c", "A  b C", "a b", "a b", "", None, " \n", "one", "ONE", "x y " * 3000, "x y " * 3001]
    order = rng.permutation(len(rows))
    return [(int(k), rows[i]) for k, i in enumerate(order)]


@pytest.mark.parametrize("seed,words", [(1, 400), (2, 12), (3, 5)])
def test_agrees_with_brute_force(spark, seed, words):
    rows = corpus(seed, words)
    df = spark.createDataFrame([(a, b, 1, 2, "z") for a, b in rows], "doc_id long, text string, n int, node int, component_id string").repartition(4)
    got = similar_documents(df).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_null_ids_and_repeated_rows(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (None, "z"), (7, None), (9, "a b c d e f"), (9, "a b c d e f"), (5, "q r s t u"), (9, "q r s t u")]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(None, 3, 4), (4, 3, 4), (None, 1, None), (7, 0, 7), (9, 3, 4), (5, 2, 5), (9, 2, 5)}


def test_empty_table(spark):
    assert similar_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (60, 50), (7, 7)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {50: 50, 60: 50, 100: 50}
