import random
import re
import zlib
from collections import Counter

import pytest

from quillspan.llm import spelling as sp

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(x):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def plain_counts(docs, least=5, times=3):
    counts = Counter()
    for i, text in docs:
        for run in map(lower, RUN.findall(text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= times}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(counts):
    beside = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, others in beside.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(beside[w]), None if form[w] is None else counts[form[w]]))
    return out


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)


def test_counts_with_deleted_code_points(spark):
    rng = random.Random(1)
    alphabet = "abcÀéÿXYZ ,×÷_1ßø"
    docs = [(i, "".join(rng.choices(alphabet, k=rng.randrange(4000)))) for i in range(40)]
    docs += [(None, "wörter Wörter wörter"), (7, None), (8, ""), (9, ("y" * 700 + " ") * 3), (9, ("z" * 256 + " " + "z" * 257 + " ") * 3), (10, "abcde" * 20), (10, "fghijé\nfghijé fghijé")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert {r["word"]: r["n"] for r in sp.count_words(rows).collect()} == plain_counts(docs)
    every = {r["word"]: r["n"] for r in sp.count_words(rows, least=2, occurrences=1, period=97).collect()}
    assert every == plain_counts(docs, 2, 1)


def test_checksums_are_those_of_zlib():
    import numpy as np

    texts = [b"abc Def", b"", "ééÿ ".encode() + b"x" * 1000]
    w, points = sp.letter_runs(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    got = sp.checksums(w, [b"1:", b"2:", b"-3:"]).tolist()
    assert got == [zlib.crc32(x) for x in (b"1:abc", b"1:def", "-3:ééÿ".encode(), b"-3:" + b"x" * 1000)]
    assert points.tolist() == [3, 3, 3, 1000]


@pytest.mark.parametrize("each", [1, 7, 50, 10_000])
def test_random_words_against_all_pairs(spark, each):
    rng = random.Random(each)
    counts = {"".join(rng.choices("abé", k=rng.randrange(1, 7))): rng.randrange(1, 40) for _ in range(250)}
    counts |= {"a" * k: k for k in range(1, 12)}
    assert {tuple(r) for r in sp.group_variants(frame(spark, counts), each=each).collect()} == plain_groups(counts)


def test_many_children_long_words_and_other_alphabets(spark):
    counts = {f"stem{chr(0x4E00 + i)}": 1 + i % 5 for i in range(120)} | {"stem": 9, "stems": 900, "stemss": 3}
    counts |= {"q" * 3000 + x: 1 + i for i, x in enumerate(["", "a", "ab", "b", "bb", "\U0001f600"])}
    assert {tuple(r) for r in sp.group_variants(frame(spark, counts), each=20).collect()} == plain_groups(counts)


def test_documents(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = sp.spelling_variants(docs.withColumn("word", docs["lang"]), each=300)
    assert {tuple(r) for r in rows.collect()} == plain_groups(plain_counts([(r["doc_id"], r["text"]) for r in docs.collect()]))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sp.spelling_variants(docs).count() == 0
