from collections import Counter

import numpy as np
import pyarrow as pa

from quillspan.llm import lm_scoring as lm
from quillspan.llm import words


def test_scores_prefer_the_target(spark):
    rng = np.random.default_rng(0)
    fine, coarse = [f"fine{i}" for i in range(50)], [f"rough{i}" for i in range(50)]
    rows = [(i, " ".join(rng.choice(fine if i % 2 else coarse, 60)), 1) for i in range(200)]
    target = spark.createDataFrame([(i,) for i in range(1, 100, 2)], "doc_id long")
    got = {r["doc_id"]: r for r in lm.lm_scores(spark.createDataFrame(rows, "doc_id long, text string, target int").repartition(3), target).collect()}
    fresh = [got[i]["score"] for i in range(101, 200, 2)]
    other = [got[i]["score"] for i in range(0, 200, 2)]
    assert max(fresh) < min(other)
    assert all(abs(r["score"] - (r["target_loss"] - r["background_loss"])) < 1e-9 and r["n_words"] == 60 for r in got.values())


def test_losses_by_brute_force(spark):
    texts = ["a b a b c", "a b d", "c c c", "B A"]
    rows = list(enumerate(texts))
    target = {0, 3}
    got = {r["doc_id"]: r for r in lm.lm_scores(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()}
    docs = [lm.cells(*words.text_bytes(pa.array([t]))) for t in texts]
    for i in range(len(texts)):
        for name, members in (("target_loss", target), ("background_loss", set(range(4)))):
            others = [docs[j] for j in members if j != i]
            count = lambda k, x: sum(int((o[k] == x).sum()) for o in others)  # noqa: E731, B023
            total = sum(len(o[0]) for o in others)
            losses = []
            for _, w, left, pair in zip(*docs[i], strict=True):
                c_left = count(1, left) if left else 0
                share = min(count(3, pair), c_left) / max(c_left, 1)
                weight = c_left / (c_left + 8.0)
                losses.append(-np.log(weight * share + (1 - weight) * (count(1, w) + 0.5) / (total + 0.5 * (1 << lm.WORD_BITS))))
            assert abs(got[i][name] - np.mean(losses)) < 1e-5


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, " \n"), (None, "a b"), (3, "w " * 60_000), (3, "w")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    rows = lm.lm_scores(docs, none).collect()
    assert len(rows) == 5 and [r["score"] for r in rows if r["n_words"] == 0] == [None, None]
    assert lm.lm_scores(docs.limit(0), none).count() == 0


def test_words_are_counted_as_themselves(spark):
    """More words than a fixed table of 2^18 cells would hold: other documents' words never change a score but by the totals."""
    rare = " ".join(f"rare{i} odd{i}" for i in range(100_000))
    many = [(100 + k, " ".join(f"n{k}x{i}" for i in range(60_000))) for k in range(8)]
    rows = [(1, rare), (2, rare), (3, "Alpha beta gamma"), (4, "alpha BETA delta"), *many]
    target = {2, 4, 100}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in lm.lm_scores(docs, spark.createDataFrame([(i,) for i in target], "doc_id long"), batch_bytes=1 << 18, bucket_bytes=1 << 14).collect()}
    texts = {i: t.lower().split() for i, t in rows}
    for name, members in (("target_loss", target), ("background_loss", set(texts))):
        word, pair = Counter(), Counter()
        for j in members:
            word.update(texts[j])
            pair.update(zip(texts[j], texts[j][1:], strict=False))
        total = sum(word.values())
        for i, text in texts.items():
            own = i in members
            mine, mine2 = Counter(text if own else []), Counter(zip(text, text[1:], strict=False) if own else [])
            losses = []
            for left, w in zip([None, *text], text, strict=False):
                c_left = word[left] - mine[left] if left else 0
                weight = c_left / (c_left + 8.0)
                share = (pair[left, w] - mine2[left, w]) / max(c_left, 1)
                losses.append(-np.log(weight * share + (1 - weight) * (word[w] - mine[w] + 0.5) / (total - len(text) * own + 0.5 * (1 << lm.WORD_BITS))))
            assert abs(got[i][name] - np.mean(losses)) < 1e-9, (i, name)


def test_counts_of_any_size_are_kept():
    counts = np.array([0, 1, 254, 255, 256, 70_000, 5_000_000_000])
    assert (lm._unpack(lm._pack(counts), len(counts)) == counts).all()
    key = np.sort(np.random.default_rng(1).integers(0, 1 << 58, 1000, dtype=np.uint64))
    low, check = lm._unpack_keys(lm._pack_keys(key, key[::-1], 6), 1000)
    assert (low == (key << np.uint64(6)) >> np.uint64(32)).all() and (check == key[::-1]).all()
