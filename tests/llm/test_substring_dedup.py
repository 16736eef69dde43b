import hashlib

import numpy as np
import pytest

from helpers import word_list
from quillspan.llm import substring_dedup as sd


def brute(rows, window=13):
    first = {}
    for doc, text in rows:
        w = word_list(text)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            key = float("inf") if doc is None else doc
            first[k] = min(first.get(k, float("inf")), key)
    out = []
    for doc, text in rows:
        w, gone = word_list(text), set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (float("inf") if doc is None else doc):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(300)]

    def text(n):
        return " ".join(rng.choice(words, n))

    passages = [text(n) for n in (13, 14, 20, 60)]
    rows = [(int(i), text(int(rng.integers(0, 80))) + " " + str(rng.choice(passages)) + "\n" + text(int(rng.integers(0, 30)))) for i in rng.permutation(120)]
    rows += [(200 + i, rows[i][1]) for i in range(5)] + [(300, None), (301, ""), (302, " \t\n"), (303, "a b c"), (None, rows[0][1]), (None, "z " * 40)]
    rows += [(304, "same word " * 500), (305, "word same " * 500), (306, text(30_000)), (307, "x" * 300_000), (10, passages[3] + " other text of the same id"), (308, passages[0]), (309, "é ü " * 30)]
    return rows


@pytest.mark.parametrize("chunk", [None, 2000])
def test_agrees_with_brute_force(spark, chunk, monkeypatch):
    rows = corpus()
    if chunk:
        real = sd.ask
        monkeypatch.setattr(sd, "ask", lambda *a, **k: real(*a, **k, chunk=chunk))
    df = spark.createDataFrame([(a, b, "c", 1) for a, b in rows], "doc_id long, text string, bits string, th int").repartition(4, "doc_id")
    got = sd.digest(sd.remove_repeats(df)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_longer_windows_and_repeated_rows(spark):
    rows = [(i, t) for i, t in corpus() if i != 306 and i != 307]
    rows += rows[:3]
    got = sd.digest(sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=20)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 20)
    with pytest.raises(ValueError):
        sd.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), window=7)


def test_every_match_shares_an_anchor():
    """Whatever the two starts, some offset below the period is a cover position for both."""
    for i in range(sd.PERIOD):
        for j in range(sd.PERIOD):
            assert any((i + k) % sd.PERIOD in sd.COVER and (j + k) % sd.PERIOD in sd.COVER for k in range(sd.PERIOD))


def test_empty_table(spark):
    assert sd.digest(sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string"))).count() == 0
