import collections
import math
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import word_list
from quillspan.llm import quality_rules as qr


def base(text):
    w = word_list(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    times = collections.Counter(grams)
    covered = {j for i, g in enumerate(grams) if times[g] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if word_list(line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


CASES = [None, "", " \n ", "one", "a b c d e " * 3, "#* x $%&|<>", "l1 x\nl1 x\n\n\nl1 x ", "é" * 30, "word " * 20000, "the of and " * 30 + "x y z w v", "a\x0bb\x0cc\rd\te f"]


def test_base_counts(spark):
    df = spark.createDataFrame([(i, t, "en", "c") for i, t in enumerate(CASES)], "doc_id long, text string, lang string, classes string")
    rows = {r["doc_id"]: r for r in qr.quality_rules(df).collect()}
    for i, t in enumerate(CASES):
        r = rows[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == base(t), repr((t or "")[:40])
        assert not (r["base_failed"] and r["kept"])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \n#é", max_size=60), min_size=1, max_size=20))
def test_base_counts_of_any_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in qr.base_counts(df).collect():
        b = base(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == b[:5]


def jsd(a, b):
    p, q = ([x / sum(h) for x in h] for h in (a, b))
    return math.sqrt(max(0, sum((x * math.log2(2 * x / (x + y)) if x else 0) + (y * math.log2(2 * y / (x + y)) if y else 0) for x, y in zip(p, q, strict=True)) / 2))


def test_distance(spark):
    pairs = [([1, 2, 3], [3, 2, 1]), ([1, 0], [0, 1]), ([5, 5], [1, 1]), ([0, 0], [1, 1])]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<long>, b array<long>")
    got = {r["i"]: r["d"] for r in df.select("i", qr.js_distance(F.col("a"), F.col("b")).alias("d")).collect()}
    for i, (a, b) in enumerate(pairs[:3]):
        assert abs(got[i] - jsd(a, b)) < 1e-9
    assert got[3] is None


def test_histograms(spark):
    text = "The house of the man, and THE Of 12 #x é. " * 10
    row = qr.histograms(qr.base_counts(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    common = dict(zip([*qr.VOCABULARY, None], row["common"], strict=True))
    assert (common["the"], common["of"], common["and"], common["de"]) == (30, 20, 10, 0)
    assert sum(row["common"]) == row["n_words"] == 110
    assert sum(row["classes"]) == row["word_chars"] and row["classes"][qr.CLASSES.index("symbol")] == 10 and row["classes"][qr.CLASSES.index("beyond")] == 10


def test_verdicts_on_the_tables(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    rows = qr.quality_rules(docs).join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) < 0.5 * len(bad)


def test_empty_table_and_null_columns(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert qr.quality_rules(none).count() == 0
    odd = spark.createDataFrame([(None, None, None), (1, "w " * 60, None), (1, "w " * 60, None)], "doc_id long, text string, lang string")
    assert qr.quality_rules(odd).count() == 3


def test_every_language_counts_and_rare_ones_share_a_reference(spark):
    """More languages than any list would hold: each is judged by its own reference, those of a document or two by a common one."""
    rng = __import__("random").Random(4)
    rows = []
    for k in range(90):
        own = [qr.VOCABULARY[(k * 7 + j) % len(qr.VOCABULARY)] for j in range(3)]
        rows += [(f"l{k:03d}", " ".join(rng.choice(own) if j % 4 else f"x{rng.random()}" for j in range(80))) for _ in range(25)]
    rows += [(f"rare{k}", " ".join(f"%{rng.random()}" for _ in range(80))) for k in range(3)]
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(8)
    measured = qr.histograms(qr.base_counts(df)).withColumn("base_failed", F.lit(False))
    refs = qr.fit_references(measured).collect()
    assert sorted(r["n_docs"] for r in refs) == [3] + [25] * 90
    hist = {r["doc_id"]: (r["lang"], r["common"]) for r in measured.collect()}
    got = {r["doc_id"]: r["word_distance"] for r in qr.quality_rules(df).select("doc_id", "word_distance").collect()}
    for i in range(0, len(rows), 211):
        assert abs(got[i] - min(jsd(hist[i][1], r["common"]) for r in refs)) < 1e-9
