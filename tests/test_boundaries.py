"""Sentence ends: ratios against plain Python, abbreviations and initials not cut."""

import math
import random
import re
from collections import Counter

import pytest

from quillspan.operators import boundaries


def told(text):
    out = []
    for t in re.split(r"\s+", text or ""):
        t = re.sub(r"""[,;:!?)\]"']+$""", "", re.sub(r"^[\W_]+", "", t))
        word = re.sub(r"\.$", "", t.lower())
        if re.search(r"[^\W_]", word):
            out.append((word, t.endswith(".")))
    return out


def chance(k, n, p):
    return (k * math.log(p) if k else 0) + ((n - k) * math.log(1 - p) if n > k else 0)


def ratio(a, b, ab, n):
    p1, p2 = ab / a, (b - ab) / (n - a) if n > a else 0
    return 2 * (chance(ab, a, p1) + chance(b - ab, n - a, p2) - chance(ab, a, b / n) - chance(b - ab, n - a, b / n))


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(3, 8)))
    vocabulary = [word() for _ in range(150)]
    texts = [None, "", " . ", "(a)"]
    for _ in range(300):
        said = []
        for _ in range(rng.randint(1, 5)):
            w = rng.choices(vocabulary, k=rng.randint(3, 9))
            if rng.random() < 0.5:
                w.insert(rng.randrange(1, len(w)), rng.choice(["(Fig. 3)", "Fig. S2", "E. Coli", "cf. The", "i.e. Two", "Nr. 7"]))
            said.append(rng.choice(["The ", "The ", "In ", ""]).capitalize() + " ".join(w) + ".")
        texts.append(" ".join(x[0].upper() + x[1:] for x in said))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string").repartition(3)
    return texts, df, boundaries.learn_boundaries(df)


def test_counts_and_ratios(spark, learned):
    texts, df, model = learned
    pairs = Counter()
    for text in texts:
        w = told(text)
        pairs.update((a, dotted, b) for (a, dotted), b in zip(w, [x for x, _ in w[1:]] + [None], strict=False))
    found = boundaries.neighbours(df).collect()
    assert {(r.word, r.dotted, r.after): r.n for r in found} == dict(pairs)
    n, dot = Counter(), Counter()
    for (a, dotted, _), k in pairs.items():
        n[a] += k
        dot[a] += k * dotted
    total, p = sum(n.values()), sum(dot.values()) / sum(n.values())
    scores = {}
    for w, k in dot.items():
        if k and not w[0].isdigit():
            letters = len(w.replace(".", ""))
            scores[w] = 2 * (chance(k, n[w], 0.99) - chance(k, n[w], p)) * math.exp(-letters) * (w.count(".") + 1) * letters ** -(n[w] - k)
    short = {w for w, x in scores.items() if x >= 0.3}
    assert {r.word: pytest.approx(r.score) for r in model.abbreviations.collect()} == {w: scores[w] for w in short}
    assert {"fig", "cf", "i.e", "nr"} <= short
    is_short = lambda w: w in short or re.fullmatch(r"[^\W\d_]|\d+", w)
    starts, bound = Counter(), Counter()
    for (a, dotted, b), k in pairs.items():
        if dotted and b is not None:
            (bound if is_short(a) else starts)[(a, b) if is_short(a) else b] += k
    ends = sum(starts.values())
    want = {w: ratio(ends, n[w], k, total) for w, k in starts.items() if k * total > ends * n[w]}
    assert {r.word: pytest.approx(r.ratio) for r in model.starters.collect()} == {w: x for w, x in want.items() if x >= 30}
    assert "the" in {r.word for r in model.starters.collect()}
    want = {(a, b): ratio(n[a], n[b], k, total) for (a, b), k in bound.items() if k > 1 and k * total > n[a] * n[b]}
    assert {(r.word, r.after): pytest.approx(r.ratio) for r in model.collocations.collect()} == {w: x for w, x in want.items() if x >= 7.88}


def test_sentences(spark, learned):
    _, _, model = learned
    texts = [
        "It is (Fig. 3) here. The end.", "See Fig. S2 for it! Is E. Coli there? (Yes.) In it.", "Found in Nr. The next.", "abc.  Def\n(g) 1.", "One", "", None, "x. Y" * 2000,
    ]
    rows = spark.createDataFrame([(i, t, "s") for i, t in enumerate([*texts, texts[0]])], "id int, text string, _s string").repartition(2)
    found = {r.id: r.sentences for r in boundaries.split_sentences(rows, model).collect()}
    said = lambda i: [x.text for x in found[i]]
    assert said(0) == said(8) == ["It is (Fig. 3) here.", "The end."]
    assert said(1) == ["See Fig. S2 for it!", "Is E. Coli there?", "(Yes.) In it."]  # a gap follows the stop itself, as in text.sentences
    assert said(2) == ["Found in Nr.", "The next."]  # an abbreviation before a word that begins sentences
    assert said(3) == ["abc.", "Def\n(g) 1."] and said(4) == ["One"] and said(5) == [""] and found[6] is None
    for i, t in enumerate(texts[:5]):
        assert all(t[x.s : x.s + len(x.text)] == x.text for x in found[i])
    assert "".join(said(7)).replace(" ", "") == texts[7].replace(" ", "")


def test_of_nothing(spark):
    none = spark.createDataFrame([], "text string")
    model = boundaries.learn_boundaries(none)
    assert model.abbreviations.count() == model.starters.count() == 0
    rows = spark.createDataFrame([("Aa bb. Cc d. E.",)], "text string")
    assert [x.text for x in boundaries.split_sentences(rows, model).first().sentences] == ["Aa bb.", "Cc d. E."]


def test_few_rows_and_no_texts_are_shuffled(spark, learned):
    """Counting leaves few rows for a text, whose other words have no next; asking about gaps moves neither texts nor their parts."""
    texts, df, model = learned
    every, few = boundaries.neighbours(df), boundaries.neighbours(df, every=False)
    want = Counter()
    for r in every.collect():
        want[r.word, r.dotted, r.after if r.dotted else None] += r.n
    assert {(r.word, r.dotted, r.after): r.n for r in few.collect()} == dict(want)
    odd = ["a\x0bb.\x1cc\x85d.\u2028 E\u00a0f.)\tg .. h.é ((i.\"' ÏJ.", "x.,\u2028 y.?! Z"]
    found = boundaries.neighbours(spark.createDataFrame([(t,) for t in odd], "text string")).collect()
    assert {(r.word, r.dotted, r.after): r.n for r in found} == {
        ("a", False, "b.\x1cc\x85d\u2028"): 1, ("b.\x1cc\x85d\u2028", False, "e\u00a0f"): 1, ("e\u00a0f", True, "g"): 1, ("g", False, "h.é"): 1,
        ("h.é", False, "i"): 1, ("i", True, "ïj"): 1, ("ïj", True, None): 1, ("x\u2028", False, "y"): 1, ("y", True, "z"): 1, ("z", False, None): 1,
    }
    plan = boundaries.split_sentences(df.withColumn("k", df.id), model)._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "Aggregate" in x and "parts" in x], plan
