"""Services: addresses, waits, checked answers, fail lists and downloads."""

from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from quillspan.operators import linking, nearest, prompts, providers, relations
from quillspan.schemas import PREDICATES
from quillspan.sources import fetch, ontologies


def test_addresses_are_quoted(spark):
    names = ["salicylic acid", "a/b+c*d~e", "é(1)=C#N", ""]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("n", fetch.quoted(F.col("n")).alias("q"), fetch.natural_product_address(F.col("n")).alias("a")).collect()
    assert all(r["q"] == quote(r["n"]) and r["a"].endswith("=" + r["q"]) for r in rows)


def test_waits_that_services_ask_for():
    cases = {"1h2m3.5s": 3723.5, "2m": 120.0, "try again in 7.25s.": 7.25, "12": 12.0, "": None, "soon": None}
    assert {k: providers.asked_wait(k) for k in cases} == cases
    slept, calls = [], []

    def call():
        calls.append(1)
        if len(calls) < 4:
            raise providers.Busy("1m30s") if len(calls) == 1 else OSError("x")
        return "done"

    assert providers.with_retries(call, 5, 0.5, sleep=slept.append)() == "done"
    assert slept == [90.0, 1.0, 2.0]


def test_answers_are_checked_and_asked_again(spark):
    def generate(asked):
        import os
        import tempfile

        out = []
        for p in asked:  # the second time a prompt is asked its answer is sound, but for "never"
            mark = os.path.join(tempfile.gettempdir(), f"asked-{os.getpid()}-{abs(hash(p))}")
            again = os.path.exists(mark)
            open(mark, "w").close()
            good = '{"decision": "yes", "n": [1, 2]}'
            out.append({"wrong": '{"decision": "maybe", "n": [1]}', "shape": '{"decision": "yes", "n": "1"}', "none": "no json"}.get(p, good) if not again or p == "never" else good)
            if p == "never":
                out[-1] = '["decision"]'
        return out

    rows = spark.createDataFrame([(p,) for p in ("wrong", "shape", "none", "fine", "never")], "p string").coalesce(1)
    made = providers.answer(rows, F.col("p"), generate, "decision string, n array<int>", values={"decision": ["yes", "no"]})
    got = {r["p"]: (r["answer"]["decision"], r["answer"]["n"]) for r in made.collect()}
    assert got == {"wrong": ("yes", [1, 2]), "shape": ("yes", [1, 2]), "none": ("yes", [1, 2]), "fine": ("yes", [1, 2]), "never": (None, None)}


def test_prompts_list_what_a_category_allows(spark):
    df = spark.createDataFrame([("genes",), ("human_traits",), ("other",), (None,)], "c string")
    name, none = F.lit("x"), F.array().cast("array<string>")
    rows = df.select("c", prompts.relation(name, none, name, none, F.coalesce("c", F.lit("?")), F.lit("text"), guided=True).alias("p")).collect()
    for r in rows:
        listed = [line[2:].split(":")[0] for line in r["p"].split("\n") if line.startswith("- ")]
        assert listed == [*PREDICATES.get(r["c"], []), "No_Relationship"]
    assert "affects" in PREDICATES["human_traits"]


def test_failures_are_listed(spark):
    def call(key):
        if key == "bad":
            raise ValueError("broken")
        return None if key == "none" else "<x/>"

    ids = spark.createDataFrame([("bad",), ("none",), ("ok",), ("ok",), (None,)], "id string")
    got = {r["id"]: (r["xml"], r["error"]) for r in fetch.fetch_or_list(ids, call, 1, at_once=2).collect()}
    assert got == {"bad": (None, "ValueError: broken"), "none": (None, "no text"), "ok": ("<x/>", None)}


def test_only_missing_files_are_downloaded(tmp_path):
    (tmp_path / "have").write_bytes(b"12345")
    (tmp_path / "short").write_bytes(b"1")
    (tmp_path / "empty").write_bytes(b"")
    asked = []

    def get(address):
        asked.append(address)
        return b"abc"

    files = {n: f"at:{n}" for n in ("have", "short", "empty", "new")}
    assert fetch.download_missing(files, str(tmp_path), get, {"have": 5, "short": 3}) == ["short", "empty", "new"]
    assert asked == ["at:short", "at:empty", "at:new"] and (tmp_path / "short").read_bytes() == b"abc"
    assert fetch.download_missing(files, str(tmp_path), get) == []
    with pytest.raises(OSError):
        fetch.download_missing({"x": "at:x"}, str(tmp_path), get, {"x": 9})


def test_nearest_terms_without_vectors(spark):
    terms = spark.createDataFrame([(k, "a", [float(k == j) for j in range(3)], None) for k in range(3)] + [(7, "a", None, None), (8, None, [1.0, 0.0, 0.0], None)], "row_idx long, space string, vec array<float>, not_for long")
    entities = spark.createDataFrame([(1, "a", [0.1, 0.9, 0.0]), (2, "a", None), (3, None, [1.0, 0.0, 0.0]), (4, "b", [1.0, 0.0, 0.0]), (5, "a", [0.0, 0.0, 0.0])], "entity_id long, space string, vec array<float>")
    out = linking.nearest_terms(entities, terms)
    assert [(r["entity_id"], r["space"], r["row_idx"]) for r in out.collect()] == [(1, "a", 1)]


def test_large_spaces_meet_by_blocks(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(nearest, "BLOCK", 16)
    rng = np.random.default_rng(0)
    t, e = rng.normal(size=(300, 8)), rng.normal(size=(90, 8))
    terms = spark.createDataFrame([(i, "ab"[i % 7 == 0], t[i].tolist(), None) for i in range(300)], "row_idx long, space string, vec array<double>, not_for long")
    entities = spark.createDataFrame([(i, "ab"[i % 2], e[i].tolist()) for i in range(90)], "entity_id long, space string, vec array<double>")
    got = {r["entity_id"]: r["row_idx"] for r in linking.nearest_terms(entities, terms).collect()}
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    scores = unit(e) @ unit(t).T
    for i in range(90):
        mine = [k for k in range(300) if (k % 7 == 0) == (i % 2 == 1)]
        assert got[i] == max(mine, key=lambda k: scores[i, k])


def test_ontologies_with_any_line_ends(spark, tmp_path):
    lines = ["format-version: 1.2", "default-namespace: ns", "", "[Term]", "id: X:1", "name: one", 'synonym: "uno [1]" EXACT []', "", "[Typedef]", "id: part_of", "", "[Term]", "id: X:2", "name: two", "is_a: X:1 ! one", "", "[Term]", "id: X:3", "name: three", "is_obsolete: true"]
    for k, end in enumerate(("\n", "\r\n")):
        (tmp_path / f"{k}.obo").write_bytes((end.join(lines) + end).encode())
        rows = ontologies.read_obo(spark, str(tmp_path / f"{k}.obo")).orderBy("id").collect()
        assert [(r["id"], r["name"], r["namespace"], r["is_obsolete"]) for r in rows] == [("X:1", "one", "ns", False), ("X:2", "two", "ns", False), ("X:3", "three", "ns", True)]
        assert list(rows[1]["is_a"]) == ["X:1"] and len(rows[0]["synonyms"]) == 1


def test_sets_and_subjects(spark):
    a = spark.createDataFrame([("x", "p", "y"), (None, "p", "y")], "subject string, predicate string, object string")
    b = spark.createDataFrame([(None, "p", "y"), ("z", "p", "y")], a.schema)
    got = {(r["subject"], r["side"]) for r in relations.compare(a, b).collect()}
    assert got == {("x", "first"), (None, "both"), ("z", "second")}
    flat = spark.createDataFrame([("Salicylic acid", "made_in", "leaf"), ("Other", "made_in", "root")], "subject_name string, predicate string, object_name string")
    assert [r["subject_name"] for r in relations.by_subject(flat, "ACID").collect()] == ["Salicylic acid"]


def test_pairs_without_an_answer_are_kept_apart(spark):
    from quillspan.operators import relations
    from quillspan.schemas import NO_RELATION

    rows = spark.createDataFrame([(1, "made_in"), (2, NO_RELATION), (3, None)], "k int, predicate string")
    parts = [*relations.route(rows), relations.unanswered(rows)]
    assert [[r.k for r in part.collect()] for part in parts] == [[1], [2], [3]]


def test_a_missing_id_column_is_named(spark):
    from quillspan.operators import loading

    with pytest.raises(ValueError, match="no column 'PMCID'"):
        loading.distinct_ids(spark.createDataFrame([("1",)], "other string"), "PMCID")
