import gzip
import json

from pyspark.sql import functions as F
from test_corpus import given, reference  # noqa: F401
from test_sources import DMP, OBO

from quillspan.functions.vectors import embedder
from quillspan.operators import evaluation, linking
from quillspan.plans import build, corpus
from quillspan.sources import ontologies, sinks


def test_reference_tables(spark, tmp_path):
    for name, text in (("smiles", "1\tC\n"), ("inchikeys", "1\tI\tK\n"), ("synonyms", "1\tmethane\n")):
        with gzip.open(tmp_path / f"{name}.gz", "wt") as f:
            f.write(text)
    (tmp_path / "tax").mkdir()
    for name, text in DMP.items():
        (tmp_path / "tax" / name).write_text(text)
    out = str(tmp_path / "ref")
    paths = {n: str(tmp_path / f"{n}.gz") for n in ("smiles", "inchikeys", "synonyms")}
    build.build_reference(spark, out, str(tmp_path / "tax"), **paths)
    build.build_reference(spark, out, str(tmp_path / "tax"), **paths)
    ref = build.load_reference(spark, out)
    assert ref.smiles.count() == 1 and ref.names.count() == 2 and ref.terms is None
    assert build.load_reference(spark, str(tmp_path / "none")) == corpus.Reference()


def test_vectors(spark, tmp_path):
    (tmp_path / "p.obo").write_text(OBO)
    terms = ontologies.annotatable(ontologies.read_obo(spark, str(tmp_path / "p.obo")))
    build.build_vectors(spark, str(tmp_path / "vec"), "peco", terms, embedder())
    rows = spark.read.parquet(str(tmp_path / "vec"))
    assert [(r["row_idx"], r["surface"], r["canonical_name"], len(r["vec"])) for r in rows.orderBy("row_idx").collect()] == [(0, "heat treatment", "heat treatment", 64), (1, "hot", "heat treatment", 64), (2, "warm & dry", "heat treatment", 64)]
    located = spark.createDataFrame([("experimental_conditions", "Hot"), ("experimental_conditions", "zzzz"), ("genes", "hot")], "entity_type string, name string")
    linked = corpus.link_ontologies(located, rows, embedder())
    assert {(r["entity_type"], r["name"]): r["ontology_id"] for r in linked.collect()} == {("experimental_conditions", "Hot"): "P:2", ("experimental_conditions", "zzzz"): None, ("genes", "hot"): None}


def test_classes(spark):
    schema = "i int, entity_type string, ontology_id string, SMILES string, InChIKey string"
    rows = spark.createDataFrame([(1, "compounds", None, "C", "K"), (0, "compounds", None, "C", "K"), (2, "compounds", "X", "CC", None), (3, "species", None, None, None)], schema)
    kinds = lambda keys: keys.select("InChIKey", *[F.lit(x.lower()).alias(x) for x in ("Kingdom", "Superclass", "Class", "Subclass")])
    got = {r["i"]: r["Classyfire"] for r in linking.classify_compounds(rows, kinds, "i").collect()}
    assert got[0]["Kingdom"] == "kingdom" and got[1] is None and got[2] is None and len(got) == 4
    products = lambda keys: keys.withColumns({"Np_class": F.array(F.lit("a")), "Np_superclass": F.array(F.lit("b"))})
    got = {r["i"]: r["Natural_product_class"] for r in linking.natural_products(rows, products).collect()}
    assert got[0]["Np_class"] == got[1]["Np_class"] == ["a"] and got[2] is None and got[3] is None


def test_sinks(spark, tmp_path):
    nested = spark.createDataFrame([("PMC1", [("é", ["x"])], None)], "doc_id string, compounds array<struct<name:string,alt_names:array<string>>>, genes array<string>")
    sinks.write_json(nested, str(tmp_path / "j"))
    text = next((tmp_path / "j" / "doc_id=PMC1").glob("*.json")).read_text()
    assert json.loads(text) == {"compounds": [{"name": "é", "alt_names": ["x"]}]} and "é" in text
    sinks.write_sheet(nested.select("doc_id", F.array(F.lit("a"), F.lit('b"')).alias("names")), str(tmp_path / "c"))
    assert spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c")).first()["names"] == 'a; b"'
    gold = spark.createDataFrame([("a", "x"), ("b", "y")], "kind string, name string")
    sinks.write_report(evaluation.match_sets(gold, gold.limit(0), ["kind", "name"]), str(tmp_path / "r"), "kind", ["name"])
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "r")).collect()) == ["a FN x", "b FN y"]
    sinks.write_routed(spark.createDataFrame([("yes", "p"), ("no", "q")], "decision string, predicate string"), str(tmp_path / "d"), "decision")
    assert spark.read.json(str(tmp_path / "d")).count() == 2
