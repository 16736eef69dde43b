import gzip
import io
import json
import tarfile

from quillspan.operators import passages
from quillspan.sources import articles, dumps, gold, ontologies, stages
from quillspan.sources.fetch import fetch_articles

XML = """<?xml version="1.0" encoding="UTF-8"?>
<!DOCTYPE collection SYSTEM "BioC.dtd">
<collection><source>x</source>
<document><id>PMC1</id>
 <passage><infon key="section_type">abstract</infon><infon key="type">paragraph</infon><offset>0</offset><text>Salicylic acid (SA) &amp; rice.</text>
  <annotation><infon key="type">Chemical</infon><text>Salicylic acid</text></annotation><annotation><infon key="type">Chemical</infon><text></text></annotation>
  <annotation><infon key="type">Other</infon><text>zzz</text></annotation></passage>
 <passage><infon key="section_type">REF</infon><offset>30</offset><text>Left out.</text></passage>
 <passage><infon key="type">title_1</infon><offset>40</offset><text>Left out.</text></passage>
 <passage><offset>50</offset><text>No infon.</text></passage>
 <passage><text>No offset.</text></passage>
 <passage><offset>70</offset></passage>
</document>
<document><id>PMC2</id><passage><offset>0</offset><text>Two.</text></passage></document>
</collection>"""


def test_articles(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    rows = articles.read_articles(spark, str(tmp_path / "*.xml"))
    read = passages.select_passages(rows)
    assert sorted((r["doc_id"], r["passage_idx"], r["u_start"], r["u_end"], r["text"]) for r in read.collect()) == [
        ("PMC1", 0, 0, 27, "Salicylic acid (SA) & rice."), ("PMC1", 3, 50, 59, "No infon."), ("PMC2", 0, 0, 4, "Two."),
    ]
    marks = passages.pre_annotations(read)
    assert [tuple(r) for r in marks.collect()] == [("PMC1", 0, 0, "compounds", "Salicylic acid")]
    names = spark.createDataFrame([("PMC1", 3, "species", 0, "rice"), ("PMC1", 3, "pathways", 0, "p"), ("PMC2", 0, "genes", 0, "g")], "doc_id string, passage_idx int, entity_type string, entity_idx int, name string")
    assert sorted(r["name"] for r in passages.override(names, marks).collect()) == ["Salicylic acid", "g", "p"]


OBO = """format-version: 1.2
default-namespace: peco

[Term]
id: P:1 ! stub
is_a: P:2 ! x

[Term]
id: P:2
name: heat treatment
synonym: "hot (exact)" EXACT []
synonym: "warm &amp; dry" RELATED []
is_a: P:3 ! exposure
relationship: part_of P:4 ! more

[Term]
id: P:3
name: old
is_obsolete: true

[Term]
id: G:1
name: binding
namespace: molecular_function
subset: gocheck_do_not_annotate

[Typedef]
id: part_of
name: part of
"""


def test_obo(spark, tmp_path):
    (tmp_path / "p.obo").write_text(OBO)
    terms = ontologies.read_obo(spark, str(tmp_path / "p.obo"))
    assert {r["id"]: r["namespace"] for r in terms.collect()} == {"P:1": "peco", "P:2": "peco", "P:3": "peco", "G:1": "molecular_function"}
    good = ontologies.annotatable(terms)
    assert [r["id"] for r in good.collect()] == ["P:2"]
    assert sorted(r["surface"] for r in ontologies.term_surfaces(good).collect()) == ["heat treatment", "hot", "warm & dry"]
    assert ontologies.annotatable(terms, "molecular_function").count() == 0
    assert sorted(map(tuple, ontologies.edges(terms).collect())) == [("P:1", "is_a", "P:2"), ("P:2", "is_a", "P:3"), ("P:2", "part_of", "P:4")]


def test_obo_without_header(spark, tmp_path):
    (tmp_path / "q.obo").write_text("[Term]\nid: Q:1\nname: q\n")
    assert ontologies.read_obo(spark, str(tmp_path / "q.obo")).first()["namespace"] == ontologies.NO_NAMESPACE


def test_pathways(spark, tmp_path):
    (tmp_path / "p.txt").write_text("Pathways\tid\n<i>a</i> &beta; way\tPWY-1\nonly name\n")
    assert [tuple(r) for r in ontologies.read_pathways(spark, str(tmp_path / "p.txt")).collect()] == [("PWY-1", "a β way")]


def test_compound_dumps(spark, tmp_path):
    for name, text in (("s", "1\tC\n2\tCC\n1\tCCC\nx\tO\n3\t\n"), ("k", "1\tI=1\tAAA\n2\tI=2\tBBB\n"), ("n", "1\tMethane\n2\tethane\n9\tMETHANE\n")):
        with gzip.open(tmp_path / f"{name}.gz", "wt") as f:
            f.write(text)
    assert sorted(map(tuple, dumps.read_smiles(spark, str(tmp_path / "s.gz")).collect())) == [(1, "C"), (2, "CC")]
    assert sorted(map(tuple, dumps.read_inchikeys(spark, str(tmp_path / "k.gz")).collect())) == [(1, "AAA"), (2, "BBB")]
    assert [(r["cid"], r["synonym"]) for r in dumps.read_synonyms(spark, str(tmp_path / "n.gz")).orderBy("row_idx").collect()] == [(1, "Methane"), (2, "ethane"), (9, "METHANE")]


DMP = {
    "nodes.dmp": "1\t|\t1\t|\tno rank\t|\n4530\t|\t1\t|\tspecies\t|\n39947\t|\t4530\t|\tSubspecies\t|\n",
    "names.dmp": "4530\t|\tOryza sativa\t|\t\t|\tscientific name\t|\n4530\t|\trice\t|\t\t|\tcommon name\t|\n",
    "merged.dmp": "12\t|\t4530\t|\n",
    "other.dmp": "x\n",
}


def test_taxonomy(spark, tmp_path):
    (tmp_path / "d").mkdir()
    with tarfile.open(tmp_path / "taxdump.tar.gz", "w:gz") as tar:
        for name, text in DMP.items():
            (tmp_path / "d" / name).write_text(text)
            info = tarfile.TarInfo(name)
            info.size = len(text)
            tar.addfile(info, io.BytesIO(text.encode()))
    for path in (tmp_path / "taxdump.tar.gz", tmp_path / "d"):
        t = dumps.read_taxonomy(spark, str(path))
        assert sorted(map(tuple, t["nodes"].collect())) == [(1, 1, "no rank"), (4530, 1, "species"), (39947, 4530, "Subspecies")]
        assert sorted((r["tax_id"], r["name"], r["name_class"]) for r in t["names"].collect()) == [(4530, "Oryza sativa", "scientific name"), (4530, "rice", "common name")]
        assert [tuple(r) for r in t["merged"].collect()] == [(12, 4530)]
    assert sorted(map(tuple, dumps.lineage(t["nodes"]).collect())) == [(4530, 1, 1), (39947, 1, 2), (39947, 4530, 1)]


def test_stage_files(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "PMC7.json").write_text(json.dumps([{"compounds": [{"name": "SA"}, {"name": "JA"}], "genes": []}, {"species": [{"name": "rice"}]}]))
    (folder / "PMC8.json").write_text("{not json")
    good, bad = stages.read_passage_entities(spark, str(folder))
    assert sorted((r["doc_id"], r["passage_idx"], r["entity_type"], r["entity_idx"], r["name"]) for r in good.collect()) == [("PMC7", 0, "compounds", 0, "SA"), ("PMC7", 0, "compounds", 1, "JA"), ("PMC7", 1, "species", 0, "rice")]
    assert [r["file_name"] for r in bad.collect()] == ["PMC8.json"]
    nested = stages.nest_entities(good.select("doc_id", "entity_type", "name", "spans"), "doc_id").first()
    assert sorted(e["name"] for e in nested["compounds"]) == ["JA", "SA"] and nested["genes"] is None


def test_relation_files(spark, tmp_path):
    one = {"relations": [{"subject_entity": {"name": "SA", "CID": 338}, "predicate": "made_in", "object_entity": {"name": "rice", "taxonomy_id": 4530}, "category": "species", "justification": "j", "context": "c"}]}
    for name in ("PMC12_x", "PMC13_not_evaluated", "PMC14_no_relationships", "other"):
        (tmp_path / f"{name}.json").write_text(json.dumps(one))
    good, bad = stages.read_relations(spark, str(tmp_path))
    assert sorted((r["pmcid"], r["subject_entity"]["CID"]) for r in good.collect()) == [("PMC12", 338), ("Unknown", 338)] and bad.count() == 0
    assert stages.nest_relations(good.drop("row_idx"), "pmcid").first()["relations"][0]["predicate"] == "made_in"


def test_gold(spark, tmp_path):
    (tmp_path / "ner.csv").write_text("entity type,entity,start,end,Ontology ID\ncompounds,SA,0,2,x\ngenes,12,a,5,\nspecies,Rice,4.0,8.0,\n")
    assert sorted(map(tuple, gold.read_gold_entities(spark, str(tmp_path / "ner.csv")).collect())) == [("compounds", "sa", 0, 2), ("species", "rice", 4, 8)]
    (tmp_path / "re.csv").write_text("PMCID,Subject_name,Object_name,Actual Relation (x)\nPMC1,SA,rice,made_in\nPMC1,SA,maize,\n")
    rows = gold.read_gold_relations(spark, str(tmp_path / "re.csv")).orderBy("gold_id").collect()
    assert [(r["object"], r["alt_names"], r["actual"]) for r in rows] == [("rice", None, "made_in"), ("maize", None, "No_Relationship")]


def test_fetching(spark):
    def call(key):
        return None if key == "b" else f"<{key}/>"

    ids = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "id string")
    assert sorted(map(tuple, fetch_articles(ids, call).collect())) == [("a", "<a/>"), ("b", None)]


def test_rows_of_dumps_that_do_not_fit_are_kept_apart(spark, tmp_path):
    lines = ["1\tC", "2\tCC\textra", "x\tO", "3", "4\t", "1\tN", "5\tO"]
    (tmp_path / "smiles.tsv").write_text("\n".join(lines) + "\n")
    path = str(tmp_path / "smiles.tsv")
    good = [tuple(r) for r in dumps.read_smiles(spark, path).orderBy("cid").collect()]
    assert good == [(1, "C"), (5, "O")]
    bad = {r["line"]: r["reason"] for r in dumps.rejected_rows(spark, path, "smiles").collect()}
    assert bad == {"2\tCC\textra": "malformed", "x\tO": "malformed", "3": "malformed", "4\t": "no smiles"}
    assert len(good) + len(bad) + 1 == len(lines)
