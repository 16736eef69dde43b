import random
import re

import pytest

from quillspan.functions import automaton
from quillspan.operators import annotations, mentions, providers

PASSAGES = "doc_id long, passage_idx int, u_start int, text string"


def plain(texts, names):
    """What re finds, name by name."""
    out = set()
    for d, text in enumerate(texts):
        for i, name in enumerate(names):
            pattern = re.escape(name) if " " in name or "(" in name else rf"\b{re.escape(name)}\b"
            spans = [(m.start() + 10 * d, m.end() + 10 * d) for m in re.finditer(pattern, text or "", re.I)] if name else []
            if spans:
                out.add((d, i, name, tuple(spans)))
    return out


def search(spark, texts, names, **options):
    rows = spark.createDataFrame([(d, 0, 10 * d, t) for d, t in enumerate(texts)], PASSAGES).repartition(3)
    lexicon = spark.createDataFrame([(i, "genes", n) for i, n in enumerate(names)], "entity_idx long, entity_type string, name string")
    found = mentions.locate_all(rows, lexicon, **options).collect()
    assert all(r["entity_type"] == "genes" for r in found)
    got = [(r["doc_id"], r["entity_idx"], r["name"], tuple((x["s"], x["e"]) for x in r["spans"])) for r in found]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("part", [4_000_000, 40])
def test_overlapping_names_against_re(spark, part):
    rng = random.Random(part)
    alphabet = "aab b.(-é_1A"
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(120))) for _ in range(60)] + [None, "", "aaaa a a a", "a-a-a-a", "Éé éÉ"]
    names = ["a", "aa", "a a", "aba", "ab", "b", "a-a", "-a", "a-", "(", "(a", "é", "éa", "A", "1", "a.b", ". ", "_", "b b b", "", "aab b.(-é"]
    assert search(spark, texts, names, part=part) == plain(texts, names)


def test_lengths_stay_where_case_changes_them(spark):
    texts = ["İstanbul and the STRASSE, straße", "x\x00y the\x00the"]
    got = search(spark, texts, ["istanbul", "and", "straße", "the"])
    assert {(d, n) for d, _, n, _ in got} == {(0, "and"), (0, "the"), (0, "straße"), (1, "the")}
    assert {spans for d, _, n, spans in got if d == 1} == {((14, 17), (18, 21))}


def test_a_name_of_several_types_and_repeated_rows(spark):
    rows = spark.createDataFrame([(1, 0, 5, "Gold gold"), (1, 0, 5, "Gold gold")], PASSAGES)
    lexicon = spark.createDataFrame([("a", "gold"), ("b", "GOLD"), ("b", None), ("a", "gold")], "entity_type string, name string").coalesce(1)
    got = sorted((r["entity_type"], r["entity_idx"], r["name"], [tuple(x) for x in r["spans"]]) for r in mentions.locate_all(rows, lexicon).collect())
    spans = [(5, 9), (10, 14)]
    assert got == [x for x in (("a", 0, "gold", spans), ("a", 3, "gold", spans), ("b", 1, "GOLD", spans)) for _ in (0, 1)]
    assert mentions.locate_all(rows, lexicon.limit(0)).count() == 0 and mentions.locate_all(rows.limit(0), lexicon).count() == 0


def test_many_names_from_the_documents(spark, data):
    from quillspan.plans import inputs

    rows = inputs.article_passages(spark, data)
    words = [r[0] for r in rows.selectExpr("explode(split(text, '[^A-Za-z]+')) AS w").where("length(w) > 3").distinct().collect()]
    assert len(words) > 3000
    lexicon = spark.createDataFrame([("genes", w) for w in words], "entity_type string, name string")
    spans = annotations.annotate(rows, lexicon).selectExpr("count(*)", "sum(s)", "sum(e - s - length(name))").first()
    assert spans[2] == 0
    plain = sum(len(re.findall(r"\b[A-Za-z]{4,}\b", r["text"])) for r in rows.collect() if r["text"])
    assert spans[0] >= plain  # each whole word is a name, in several cases perhaps
    extracted = providers.lexicon_extractor(lexicon)(rows)
    assert extracted.count() == mentions.locate_all(rows, lexicon).count()


def test_names_that_overlap_themselves():
    assert [automaton.overlaps_itself(x) for x in ("aa", "aba", "abab", "ab", "a", "abca")] == [True, True, True, False, False, True]


def test_a_batch_is_not_all_python_texts_at_once():
    import tracemalloc
    from types import SimpleNamespace

    import pyarrow as pa

    kinds = pa.schema([("doc_id", pa.int64()), ("passage_idx", pa.int32()), ("entity_type", pa.string()), ("entity_idx", pa.int32()), ("name", pa.string()), ("spans", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))])
    n = 200
    texts = [None if i == 7 else "x" * 200_000 + " the" for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([0] * n, pa.int32()), pa.array([3] * n, pa.int64()), pa.array(texts)], ["doc_id", "passage_idx", "u_start", "text"])
    del texts
    search = automaton.searcher(SimpleNamespace(value=automaton.pack_names([(0, "genes", "the")])), kinds)
    tracemalloc.start()
    found = [r for out in search(iter([batch])) for r in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r["doc_id"], r["spans"]) for r in found] == [(i, [{"s": 200_004, "e": 200_007}]) for i in range(n) if i != 7]
    assert peak < 25e6, peak  # the texts have 40 MB
