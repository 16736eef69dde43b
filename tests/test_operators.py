import math

import pytest
from pyspark.sql import functions as F

from quillspan.operators import abbreviations, annotations, evaluation, linking, loading, mentions, merging, prompts, providers, ranking, relations
from quillspan.plans import table_queries
from quillspan.schemas import NO_DEFINITION, NO_RELATION, predicate_guidelines


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_locate_drops_made_up_names(spark):
    passages = frame(spark, "doc_id int, passage_idx int, u_start int, text string", (1, 0, 10, "Rice and rice."), (1, 1, 30, "None"))
    names = frame(spark, "doc_id int, passage_idx int, entity_type string, entity_idx int, name string", (1, 0, "species", 0, "rice"), (1, 0, "species", 1, "rice"), (1, 0, "species", 2, "Rice"), (1, 1, "species", 0, "rice"))
    found = mentions.drop_unfound(mentions.locate(names, passages))
    assert sorted((r["name"], r["entity_idx"], [tuple(s) for s in r["spans"]]) for r in found.collect()) == [("Rice", 2, [(10, 14), (19, 23)]), ("rice", 0, [(10, 14), (19, 23)])]


@pytest.mark.parametrize("width", [1, 3, 10, 4096])
def test_overlap_does_not_depend_on_buckets(spark, width):
    spans = [(d, i, i + n) for d in (1, 2) for i in range(0, 40, 3) for n in (1, 2, 15)]
    units = [(1, k, a, b) for k, (a, b) in enumerate(((0, 5), (5, 5), (5, 31), (2, 60)))] + [(2, 0, 10, 12)]
    got = mentions.overlap(frame(spark, "doc_id int, s int, e int", *spans), frame(spark, "doc_id int, unit_idx int, u_start int, u_end int", *units), width)
    expected = [(d, s, e, k) for d, s, e in spans for x, k, a, b in units if x == d and e > a and s < b]
    assert sorted((r["doc_id"], r["s"], r["e"], r["unit_idx"]) for r in got.collect()) == sorted(expected)


def test_merge_keeps_the_first_record(spark):
    schema = "doc_id int, passage_idx int, entity_idx int, entity_type string, name string, spans array<struct<s:int,e:int>>, ontology_id string, CID long, taxonomy_id int"
    rows = frame(
        spark, schema,
        (1, 1, 0, "compounds", "GA", [(20, 22)], "C:1", None, None), (1, 0, 1, "compounds", "gibberellin", [(5, 16)], "C:1", None, None), (1, 0, 2, "compounds", "Gibberellin", [(5, 16)], "C:1", None, None),
        (1, 2, 0, "compounds", "water", [(40, 45)], None, 962, None), (1, 3, 0, "compounds", "962", [(50, 53)], None, None, None), (1, 0, 0, "genes", "X", [(1, 2)], "C:1", None, None),
        (1, 0, 3, "species", "rice", [], None, None, 4530), (1, 4, 0, "species", "Oryza sativa", [(60, 72)], None, None, 4530), (1, 4, 1, "genes", "", [(1, 2)], None, None, None),
    )
    got = {(r["entity_type"], r["merge_key"]): (r["name"], [tuple(s) for s in r["spans"]], r["alt_names"], r["CID"]) for r in merging.merge_duplicates(rows).collect()}
    assert got == {
        ("compounds", "C:1"): ("gibberellin", [(5, 16), (20, 22)], ["GA"], None),
        ("compounds", "962"): ("water", [(40, 45), (50, 53)], ["962"], 962),
        ("genes", "x"): ("X", [(1, 2)], [], None),
        ("species", "4530"): ("rice", [(60, 72)], ["Oryza sativa"], None),
    }


def test_abbreviations_move_into_long_forms(spark):
    schema = "doc_id int, entity_type string, turn struct<passage_idx:int,entity_idx:int>, name string, spans array<struct<s:int,e:int>>, alt_names array<string>, CID long"
    rows = frame(
        spark, schema,
        (1, "compounds", (0, 0), "SA", [(9, 11)], ["sal"], 1), (1, "compounds", (1, 0), "Salicylic acid", [(0, 5)], [], 338), (1, "genes", (0, 0), "SA", [(7, 8)], [], None),
        (2, "compounds", (0, 0), "SA", [(1, 2)], [], None), (1, "compounds", (2, 0), "JA", [(30, 32)], [], 2),
    )
    short = frame(spark, "doc_id int, short string, long string", (1, "SA", "salicylic acid"), (1, "JA", "jasmonic acid"))
    got = sorted((r["doc_id"], r["entity_type"], r["name"], [tuple(s) for s in r["spans"]], r["alt_names"], r["CID"]) for r in merging.merge_abbreviations(rows, short).collect())
    assert got == [
        (1, "compounds", "JA", [(30, 32)], [], 2), (1, "compounds", "Salicylic acid", [(0, 5), (9, 11)], ["SA", "sal"], 338),
        (1, "genes", "SA", [(7, 8)], [], None), (2, "compounds", "SA", [(1, 2)], [], None),
    ]


@pytest.mark.parametrize(
    "text,found",
    [
        ("Treated with gibberellic acid (GA) today.", {"GA": "gibberellic acid"}),
        ("First, The Jasmonic Acid (JA) rose; (a) no, (ii) no.", {}),
        ("First, Jasmonic acid (JA) rose.", {"JA": "Jasmonic acid"}),
        ("Levels of the reactive oxygen species (ROS) and (ROS).", {"ROS": "reactive oxygen species"}),
        ("A mitogen of the protein (XYZ).", {}),
        ("Nothing (AB", {}),
        ("see Heat shock and cold factor (HSCF) here", {"HSCF": "Heat shock and cold factor"}),
        ("", {}),
    ],
)
def test_abbreviation_definitions(text, found):
    assert abbreviations.definitions(text) == found


def test_abbreviations_by_document(spark):
    rows = frame(spark, "doc_id int, passage_idx int, text string", (1, 0, "Gibberellic acid (GA)."), (1, 5, "Great ape (GA)."), (2, 0, None))
    assert [tuple(r) for r in abbreviations.detect(rows).collect()] == [(1, "GA", "Great ape")]


def test_short_forms():
    assert [abbreviations.is_short_form(x) for x in ("GA", "ga", "gab", "1A", "", "a" * 11, "iP")] == [True, False, True, False, False, False, True]


def test_nearest_terms(spark):
    entities = frame(spark, "entity_id long, space string, vec array<float>", (1, "a", [1.0, 0.0]), (2, "a", [0.0, 1.0]), (3, "b", [1.0, 1.0]), (4, "c", [1.0, 0.0]), (5, "a", [0.0, 0.0]))
    terms = frame(spark, "row_idx long, space string, vec array<float>, not_for long", (7, "a", [2.0, 0.0], None), (5, "a", [1.0, 0.0], None), (9, "a", [0.0, 3.0], 2), (1, "b", [1.0, 0.0], None))
    got = {r["entity_id"]: (r["row_idx"], round(r["score"], 4)) for r in linking.nearest_terms(entities, terms).collect()}
    assert got[1] == (5, 1.0) and got[2][1] == 0.0 and got[3] == (1, 0.7071) and 4 not in got and 5 not in got


def test_compounds_and_species(spark):
    compounds = frame(spark, "name string, ontology_id string", ("ETHANE", None), ("ethane", "C:1"), ("ÄTHAN", None), (None, None))
    synonyms = frame(spark, "row_idx long, cid long, synonym string", (2, 7, "Ethane"), (1, 6, "ethane"), (3, 8, "äthan"))
    props = frame(spark, "cid long, smiles string", (6, "CC")), frame(spark, "cid long, inchikey string", (6, "KEY"))
    got = sorted(((r["name"], r["ontology_id"], r["cid"], r["smiles"]) for r in linking.link_compounds(compounds, synonyms, *props).collect()), key=repr)
    assert got == sorted([("ETHANE", None, 6, "CC"), ("ethane", "C:1", None, None), ("ÄTHAN", None, None, None), (None, None, None, None)], key=repr)
    names = frame(spark, "row_idx long, tax_id int, name string, name_class string", (1, 9, "rice", "common name"), (2, 8, "rice", "scientific name"), (0, 5, "rice", "scientific name"), (3, 7, "maize", "common name"))
    nodes = frame(spark, "tax_id int, rank string", (9, "species"), (8, "Species"), (5, "genus"), (7, "species"))
    merged = frame(spark, "old_tax_id int, new_tax_id int", (7, 70), (70, 700))
    species = frame(spark, "name string", ("rice",), ("Rice",), ("maize",))
    assert {r["name"]: r["taxonomy_id"] for r in linking.link_species(species, names, nodes, merged).collect()} == {"rice": 8, "Rice": None, "maize": 70}


def test_binomials(spark):
    rows = frame(spark, "doc_id int, name string", (1, "Oryza sativa"), (1, "O. sativa"), (1, "o. sativa"), (2, "O. sativa"), (1, "Oryza sativa L"), (1, "Olea sativa"))
    got = sorted((r["doc_id"], r["name"], r["lookup_name"]) for r in linking.expand_binomials(rows).collect())
    assert got == [(1, "O. sativa", "Olea sativa"), (1, "Olea sativa", "Olea sativa"), (1, "Oryza sativa", "Oryza sativa"), (1, "Oryza sativa L", "Oryza sativa L"), (1, "o. sativa", "Olea sativa"), (2, "O. sativa", "O. sativa")]


def test_scores(spark):
    row = spark.range(1).select(
        ranking.co_count(F.lit(2), F.lit(3)).alias("co"),
        ranking.proximity(F.array(F.lit(0), F.lit(4)), F.array(F.lit(1), F.lit(4))).alias("prox"),
        ranking.proximity(F.array(F.lit(0)), F.array().cast("array<int>")).alias("none"),
    ).first()
    assert abs(row["co"] - math.log(1 + 12 / (5 + 1e-6))) < 1e-12 and row["prox"] == 1.5 and row["none"] == 0


def test_pairs(spark):
    e = frame(spark, "doc_id int, entity_type string, name string, CID long", (1, "compounds", "a", 1), (1, "compounds", "b", None), (1, "genes", "g", None), (2, "genes", "h", None))
    assert sorted((r["subj"], r["obj"]) for r in ranking.entity_pairs(e).collect()) == [("a", "g"), ("b", "g")]
    assert [(r["subj"], r["obj"]) for r in ranking.entity_pairs(e, "cid_only").collect()] == [("a", "g")]


def test_relations(spark):
    rows = frame(spark, "category string, predicate string, context string, justification string", ("species", "made_in", "It Is made", "is MADE"), ("species", "eats", "x", "y"), ("human_traits", "affects", None, "z"), ("genes", NO_RELATION, "c", " "))
    some, none = relations.route(rows)
    assert some.count() == 3 and none.count() == 1
    assert sorted((r["predicate"], r["decision"]) for r in relations.judge(rows).collect()) == [(NO_RELATION, "no"), ("affects", "no"), ("eats", "no"), ("made_in", "yes")]
    definitions = {r["predicate"]: r["definition"] for r in relations.with_definitions(rows, predicate_guidelines(spark)).collect()}
    assert definitions["affects"] == definitions["eats"] == NO_DEFINITION != definitions["made_in"]
    a, b = frame(spark, "x int", (1,), (2,), (2,)), frame(spark, "x int", (2,), (3,))
    assert sorted(map(tuple, relations.compare(a, b).collect())) == [(1, "first"), (2, "both"), (3, "second")]


def test_evaluation(spark):
    gold = frame(spark, "label_ string, name string", ("a", "x"), ("a", "y"), ("b", "z"))
    predicted = frame(spark, "label_ string, name string", ("a", "x"), ("a", "x"), ("c", "w"))
    got = {r["label"]: (r["tp"], r["fp"], r["fn"], round(r["f1"], 3)) for r in evaluation.precision_recall(gold, predicted, ["label_", "name"], "label_").collect()}
    assert got == {None: (1, 1, 2, 0.4), "a": (1, 0, 1, 0.667), "b": (0, 0, 1, 0.0), "c": (0, 1, 0, 0.0)}
    g = frame(spark, "gold_id int, pmcid string, subject string, object string, alt_names string, actual string", (1, "P", "s", "o", "x; y", "r"), (2, "P", "s", "q", None, "t"), (3, "Q", "s", "o", "", "r"))
    p = frame(spark, "row_idx int, pmcid string, subject string, object string, predicate string", (0, "P", "s", "y", "early"), (1, "P", "s", "y", "late"), (2, "P", "s", "x", "first"), (3, "P", "s", "new", "n"), (4, "R", "s", "o", "m"))
    assert {r["gold_id"]: r["predicted"] for r in evaluation.match_gold(g, p).collect()} == {1: "first", 2: NO_RELATION, 3: NO_RELATION}
    assert [(r["object"], r["predicted"]) for r in evaluation.invented(g, p).collect()] == [("new", "n")]


def test_report(spark):
    rows = frame(spark, "actual string, predicted string", *[("a", "a")] * 3, ("a", "b"), ("b", "b"), ("c", "a"))
    matrix = evaluation.confusion(rows)
    assert matrix.count() == 9 and {(r["actual"], r["predicted"]): r["n"] for r in matrix.collect()}[("c", "c")] == 0
    m = {r["label"]: r for r in evaluation.class_metrics(matrix).collect()}
    assert (m["a"]["tp"], m["a"]["fp"], m["a"]["fn"], m["a"]["tn"], m["c"]["precision"]) == (3, 1, 1, 1, 0.0)
    lines = {r["row"]: r for r in evaluation.report(evaluation.class_metrics(matrix)).collect()}
    assert abs(lines["accuracy"]["f1"] - 4 / 6) < 1e-9 and abs(lines["macro avg"]["recall"] - (0.75 + 1 + 0) / 3) < 1e-9 and lines["weighted avg"]["support"] == 6


def test_annotations(spark):
    passages = frame(spark, "doc_id int, passage_idx int, u_start int, text string", (1, 0, 0, "rice, Rice"))
    marks = annotations.annotate(passages, frame(spark, "entity_type string, name string", ("species", "RICE"), ("genes", "x")))
    assert sorted((r["s"], r["e"]) for r in marks.collect()) == [(0, 4), (6, 10)]
    assert annotations.remove(marks, frame(spark, "entity_type string, name string", ("species", "rice"))).count() == 0
    assert [r["value"] for r in annotations.reference_lines(marks).collect()] == ["species: rice"]
    more = annotations.add(marks, marks.withColumn("name", F.upper("name")).unionByName(marks.withColumns({"s": F.col("s") - 1, "name": F.lit("a")})))
    assert more.columns == marks.columns and more.count() == 2 * marks.count()
    for row in annotations.by_place(more).collect():
        assert [tuple(x) for x in row["annotations"]] == sorted(tuple(x) for x in row["annotations"])


def test_loading(spark, tmp_path):
    rows = frame(spark, "key int, row_idx int, v string", (1, 2, "late"), (1, 1, "early"), (2, 5, None))
    assert sorted(map(tuple, linking.first_by(rows, "key", "row_idx").select("key", "v").collect())) == [(1, "early"), (2, None)]
    assert tuple(loading.integrity("t", rows, frame(spark, "key int", (1,)), ["key"]).first()) == ("t", 3, 1)
    assert loading.integrity("t", rows, rows, ["key"], sample=2).first()["n_unknown"] == 0
    loading.store(rows, str(tmp_path / "x"))
    loading.store(rows.limit(0), str(tmp_path / "x"), mode="ignore")
    assert spark.read.parquet(str(tmp_path / "x")).count() == 3
    assert [r["id"] for r in loading.distinct_ids(frame(spark, "` PMCID ` string", (" a ",), ("a",), (None,), (" ",)), "PMCID").collect()] == ["a"]


def test_surfaces_and_classes(spark):
    terms = frame(spark, "id int, name string, syn array<string>", (1, " a ", ["b", "a", ""]), (2, None, ["c"]))
    assert sorted((r["id"], r["surface"]) for r in linking.surface_forms(terms, F.col("name"), F.col("syn")).collect()) == [(1, "a"), (1, "b"), (2, "c")]
    entities = frame(spark, "id int, key string", (2, "k"), (1, "k"), (3, None), (4, "z"))
    got = {r["id"]: r["cls"] for r in linking.attach_once(entities, frame(spark, "key string, cls string", ("k", "C")), "key", "id").collect()}
    assert got == {1: "C", 2: None, 3: None, 4: None}


def test_providers(spark):
    pairs = frame(spark, "subj string, context string", ("a", "It Accumulates in leaves"), ("b", "nothing"))
    got = {r["subj"]: (r["predicate"], r["decision"]) for r in providers.containment_judge(providers.cue_predictor()(pairs)).collect()}
    assert got == {"a": ("accumulates_in", "yes"), "b": (NO_RELATION, "no")}
    calls = []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError
        return x

    assert providers.with_retries(flaky, 3, 0)(5) == 5 and len(calls) == 3
    with pytest.raises(OSError):
        providers.with_retries(lambda: (_ for _ in ()).throw(OSError()), 2, 0)()
    rows = frame(spark, "text string", ("p1",), ("p2",))
    made = providers.answer(rows, prompts.extraction(F.col("text")), lambda p: ['{"name": "x"}' if "p1" in t else "no json" for t in p], "name string")
    assert {r["text"]: r["answer"]["name"] for r in made.collect()} == {"p1": "x", "p2": None}
    asked = providers.lookup(frame(spark, "k string", ("a",), ("a",), ("b",), (None,)), "k", lambda ks: [{"k": k, "v": len(ks)} for k in ks if k == "a"], "k string, v int")
    assert [r["k"] for r in asked.collect()] == ["a"]


def test_prompts(spark):
    row = spark.range(1).select(
        prompts.relation(F.lit("SA"), F.array(F.lit("sal")), F.lit("rice"), F.array().cast("array<string>"), F.lit("species"), F.lit("ctx")).alias("r"),
        prompts.evaluation(F.lit("SA"), F.lit("made_in"), F.lit("rice"), F.lit("def"), F.lit("why"), F.lit("ctx\nmore")).alias("e"),
    ).first()
    assert "SA (also: sal)" in row["r"] and "rice, one of the species" in row["r"] and row["e"].endswith("Text: ctx\nmore")


def test_compare_keeps_a_share_of_the_rows(spark, data):
    """Repeated rows are on their side once; triples are aggregated once, in tasks whose number follows the rows."""
    rows = [("a", "p", "x", "k"), ("a", "p", "x", "k"), ("a", "p", "x", "l"), (None, "p", None, "l"), ("b", "p", "x", "k"), ("c", "p", "x", None)]
    flat = spark.createDataFrame(rows, "subject_name string, predicate string, object_name string, category string")
    found = relations.compare_triples(flat, F.col("category") == "k", 7)
    want = {("a", "p", "x", "both"), ("Unknown subject", "p", "Unknown object", "second"), ("b", "p", "x", "first")}
    got = [tuple(r) for r in found.collect()]
    assert set(got) == want and len(got) == 3
    assert found.rdd.getNumPartitions() == 7
    a, b = flat.where("category = 'k'").drop("category"), flat.where("category = 'l'").drop("category")
    assert {tuple(r) for r in relations.compare(a, b, 5).collect()} == {("a", "p", "x", "both"), (None, "p", None, "second"), ("b", "p", "x", "first")}
    plan = table_queries.triple_set_diff(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1


def test_sentences_are_split_for_their_texts_alone(spark, data):
    """Places and numbers of sentences come from a written table; documents are read for the texts of sentences and of passages."""
    from quillspan.plans import text_queries

    plan = text_queries.context_assembly(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert len([x for x in plan.splitlines() if "Relation [" in x and "text#" in x]) == 2, plan
    plan = text_queries.context_window(spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.splitlines() if "text#" in x], plan
