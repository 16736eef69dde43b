import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillspan.llm.queries import queries, tokenizer_path
from test_exact_dedup import brute as equal_texts
from test_jaccard_join import brute as similar
from test_jaccard_join import shingles
from test_mixing import level
from test_packing import best_fit_decreasing


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    """Each stage's input and output, as rows."""
    folder = str(tmp_path_factory.mktemp("stages"))
    docs = spark.read.parquet(f"{data}/documents.parquet")
    out = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, data).write.parquet(f"{folder}/{k}")
        after = spark.read.parquet(f"{folder}/{k}")
        out[name] = (docs.collect(), after.collect(), after.columns)
        docs = after
    return out


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "best-fit packing"]
    assert corpus_pipeline.queries().keys() == {"pipeline"} and len([q for q in queries() if q.startswith("op")]) == 13


def test_all_but_the_last_keep_the_columns(stages):
    for name in [n for n, _ in corpus_pipeline.STAGES][:-1]:
        assert stages[name][2] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_classifier_keeps_good_documents(spark, data, stages):
    before, after, _ = stages["quality classifier"]
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after}
    good = [d for d, q in label.items() if q == 1]
    bad = [d for d, q in label.items() if q == 0]
    assert sum(d in kept for d in good) >= 0.97 * len(good) and sum(d in kept for d in bad) <= 0.2 * len(bad) and len(kept) < len(before)


def test_one_of_equal_texts_stays(stages):
    before, after, _ = stages["exact dedup"]
    expected = {r[0] for r in equal_texts([(r["doc_id"], r["text"]) for r in before]) if r[3]}
    assert {r["doc_id"] for r in after} == expected and len(after) == len(expected)


def test_one_of_linked_documents_stays(stages):
    before, after, _ = stages["n-gram Jaccard join"]
    assert {r["doc_id"] for r in after} == {r[2] for r in similar([(r["doc_id"], r["text"]) for r in before])}


def test_mix_comes_near_its_targets(stages):
    before, after, _ = stages["mixing sources to target weights"]
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in before}
    have, taken, smallest = defaultdict(int), defaultdict(int), {}
    for r in before:
        have[r["source"]] += size[r["doc_id"]]
        smallest[r["source"]] = max(smallest.get(r["source"], 0), size[r["doc_id"]])
    for r in after:
        taken[r["source"]] += size[r["doc_id"]]
    for s, goal in level(have).items():
        assert abs(taken[s] - goal) <= max(60, 0.5 * smallest[s])


def test_packing_is_tight(stages):
    before, after, columns = stages["best-fit packing"]
    assert columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sum(r["piece"] == 0 for r in after) == len(before)
    assert len({r["sequence_id"] for r in after}) <= best_fit_decreasing([r["length"] for r in after], 2048) + 1


def test_near_copies_link_by_80_percent_of_5_words(spark, data):
    text = [f"w{i}" for i in range(200)]
    rows = [(1, text), (2, [*text, *(f"more{i}" for i in range(40))]), (3, [*text, *(f"much{i}" for i in range(60))]), (4, ["x", *text[:150]]), (6, [f"z{i}" for i in range(50)])]
    sets = {i: shingles(" ".join(t), 5) for i, t in rows}
    linked = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert linked == {(1, 2)}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.ngram_jaccard_join(spark, docs, data).collect()}
    assert kept == {1, 3, 4, 6}


def test_decisions_hold_for_null_and_repeated_ids(spark, data):
    text = [f"w{i}" for i in range(200)]
    near, other, third = [*text, "x"], [f"o{i}" for i in range(60)], [f"t{i}" for i in range(60)]
    rows = [(1, text), (7, near), (7, other), (None, [*text, "y"]), (None, third), (None, [*third, "z"]), (9, [*other, "z"]), (2, None)]
    docs = spark.createDataFrame([(i, t and " ".join(t)) for i, t in rows], "doc_id long, text string")
    after = [(r["doc_id"], r["text"]) for r in corpus_pipeline.ngram_jaccard_join(spark, docs, data).collect()]
    assert len(after) == 4 and {(1, " ".join(text)), (7, " ".join(other)), (2, None)} < set(after)
    assert [t.startswith("t0 ") for i, t in after if i is None] == [True]


@pytest.mark.parametrize("new_id", [None, 5])
def test_classifier_judges_rows_of_one_id_apart(spark, data, new_id):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{data}/labels.parquet").collect()}
    unlabelled = docs.withColumn("doc_id", docs["doc_id"] + 10_000_000)
    alone = {r["doc_id"] - 10_000_000 for r in corpus_pipeline.quality_classifier(spark, docs.unionByName(unlabelled), data).collect() if r["doc_id"] >= 10_000_000}
    ids = {r["doc_id"]: r["text"] for r in docs.collect()}
    good, bad = next(i for i in sorted(alone) if labels.get(i) == 1), next(i for i in sorted(ids) if i not in alone and labels.get(i) == 0)
    pair = docs.where(docs["doc_id"].isin(good, bad))
    pair = pair.withColumn("doc_id", F.lit(None if new_id is None else 10_000_000 + new_id).cast("long"))
    after = [r["text"] for r in corpus_pipeline.quality_classifier(spark, docs.unionByName(pair), data).collect() if r["doc_id"] is None or r["doc_id"] >= 10_000_000]
    assert after == [ids[good]]


def odd_documents(spark, data):
    """Nulls everywhere, empty and long texts, repeated rows and ids, and columns named like the stages' own."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, target string, draws int, source_size string, size string, row string, sha string, number int, _copy_id string, id string, at int"
    good = spark.read.parquet(f"{data}/documents.parquet").limit(40).collect()
    more = ("mine", 7, "mine", "mine", "mine", "mine", 7, "mine", "mine", 7)
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in good]
    rows += [(None, rows[0][1], None, None, None), (None, None, None, None, None), (None, None, None, None, None), (rows[1][0], rows[1][1], "en", "x", 1), (rows[1][0], rows[2][1], "en", "x", 1)]
    rows += [(-5, "", "en", "", 0), (-6, "word " * 120_000, "en", "x", 1), (-7, " \n\t", None, "x", 3)]
    return spark.createDataFrame([(*r, *more) for r in rows], schema).repartition(3)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_rows(spark, data, name):
    docs, stage = odd_documents(spark, data), dict(corpus_pipeline.STAGES)[name]
    before = [tuple(r) for r in docs.collect()]
    out = stage(spark, docs, data)
    after = [tuple(r) for r in out.collect()]
    if name == "best-fit packing":
        assert sum(r[1] == 0 for r in after) == len(before)
    else:
        assert out.columns == docs.columns and set(after) <= set(before) and after
    if name == "exact dedup":
        assert len(after) == len({re.sub(r"[\x20\x09-\x0D]+", "", r[1] or "") for r in before}) and len(set(after)) == len(after)
    if name == "mixing sources to target weights":
        assert max(after.count(r) / before.count(r) for r in set(after)) <= 3


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, data, name):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(0)
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, data)
    assert out.count() == 0 and (name == "best-fit packing" or out.columns == docs.columns)


def test_run_is_its_stages_in_turn(spark, data, stages):
    last = stages["best-fit packing"]
    rows = corpus_pipeline.queries()["pipeline"](spark, data)
    assert rows.columns == last[2]
    assert sorted(tuple(r)[:5] for r in rows.collect()) == sorted(tuple(r)[:5] for r in last[1])
