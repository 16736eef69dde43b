import pytest
from pyspark.sql import functions as F

from quillspan.functions.vectors import embedder
from quillspan.operators import passages, providers
from quillspan.plans import corpus
from quillspan.sources.articles import read_articles
from quillspan.streaming.ingest import ingest

ARTICLE = """<?xml version="1.0"?><collection><document><id>{id}</id>
<passage><infon key="section_type">ABSTRACT</infon><infon key="type">abstract</infon><offset>0</offset><text>Salicylic acid (SA) accumulates in rice. SA was high. Oryza sativa grew.</text></passage>
<passage><infon key="section_type">RESULTS</infon><infon key="type">paragraph</infon><offset>100</offset><text>We saw SA in O. sativa under heat treatment. Nothing else was seen.</text></passage>
</document></collection>"""


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for k in (1, 2):
        (tmp_path / "in" / f"PMC{k}.xml").write_text(ARTICLE.format(id=f"PMC{k}"))
    return tmp_path


def given(spark):
    names = [("compounds", "Salicylic acid"), ("compounds", "SA"), ("species", "rice"), ("species", "Oryza sativa"), ("species", "O. sativa"), ("experimental_conditions", "heat treatment")]
    lexicon = spark.createDataFrame(names, "entity_type string, name string")
    return corpus.Providers(providers.lexicon_extractor(lexicon), providers.cue_predictor(), providers.containment_judge, embedder())


def reference(spark):
    terms = spark.createDataFrame([("peco", 0, "PECO:1", "heat treatment", "peco"), ("peco", 1, "PECO:2", "cold", "peco")], "ontology string, row_idx long, id string, canonical_name string, namespace string")
    return corpus.Reference(
        terms=terms.withColumn("vec", embedder()("canonical_name")),
        synonyms=spark.createDataFrame([(0, 338, "salicylic ACID")], "row_idx long, cid long, synonym string"),
        smiles=spark.createDataFrame([(338, "OC")], "cid long, smiles string"),
        inchikeys=spark.createDataFrame([(338, "KEY")], "cid long, inchikey string"),
        names=spark.createDataFrame([(0, 4530, "Oryza sativa", "scientific name"), (1, 4530, "rice", "common name")], "row_idx long, tax_id int, name string, name_class string"),
        nodes=spark.createDataFrame([(4530, "species")], "tax_id int, rank string"),
        merged=spark.createDataFrame([], "old_tax_id int, new_tax_id int"),
    )


def test_articles_to_relations(spark, folder):
    articles = read_articles(spark, str(folder / "in"))
    out = corpus.run(spark, articles, str(folder / "out"), given(spark), reference(spark))
    entities = {(r["entity_type"], r["name"]): r for r in spark.read.parquet(str(folder / "out" / "entities")).where("doc_id = 'PMC1'").collect()}
    assert set(entities) == {("compounds", "Salicylic acid"), ("species", "rice"), ("experimental_conditions", "heat treatment")}
    acid, rice = entities["compounds", "Salicylic acid"], entities["species", "rice"]
    assert acid["CID"] == 338 and acid["alt_names"] == ["SA"] and len(acid["spans"]) == 4
    assert rice["taxonomy_id"] == 4530 and rice["alt_names"] == ["O. sativa", "Oryza sativa"]
    assert entities["experimental_conditions", "heat treatment"]["ontology_id"] == "PECO:1"
    rows = {(r["doc_id"], r["obj"]): (r["predicate"], r["decision"]) for r in out.collect()}
    assert rows["PMC1", "rice"] == ("accumulates_in", "yes") and {d for d, _ in rows} == {"PMC1", "PMC2"}
    again = corpus.run(spark, articles, str(folder / "out"), given(spark), reference(spark))
    assert again.count() == len(rows)
    (folder / "in" / "PMC3.xml").write_text(ARTICLE.format(id="PMC3"))
    more = corpus.run(spark, read_articles(spark, str(folder / "in")), str(folder / "out"), given(spark), reference(spark))
    assert {r["doc_id"] for r in more.collect()} == {"PMC1", "PMC2", "PMC3"}


def test_streaming(spark, folder):
    def process(articles):
        return passages.select_passages(articles).groupBy("doc_id").agg(F.count("*").alias("n"))

    def go():
        ingest(spark, str(folder / "in"), str(folder / "out"), str(folder / "check"), process).awaitTermination(120)
        return sorted(map(tuple, spark.read.parquet(str(folder / "out" / "rows")).select("doc_id", "n").collect()))

    assert go() == [("PMC1", 2), ("PMC2", 2)]
    (folder / "in" / "PMC9.xml").write_text(ARTICLE.format(id="PMC9"))
    (folder / "in" / "copy.xml").write_text(ARTICLE.format(id="PMC1"))
    assert go() == [("PMC1", 2), ("PMC2", 2), ("PMC9", 2)]


def test_a_run_that_broke_off_is_written_over(spark, folder):
    articles = read_articles(spark, str(folder / "in"))
    out = str(folder / "out")
    corpus.run(spark, articles, out, given(spark))
    n = spark.read.parquet(f"{out}/entities").count()
    # as if a second run had written its part, but not its note
    spark.read.parquet(f"{out}/entities").drop("run").write.parquet(f"{out}/entities/run=1")
    (folder / "in" / "PMC5.xml").write_text(ARTICLE.format(id="PMC5"))
    corpus.run(spark, read_articles(spark, str(folder / "in")), out, given(spark))
    assert spark.read.parquet(f"{out}/entities").count() == n // 2 * 3


def test_a_batch_that_runs_again_writes_the_same(spark, folder):
    import shutil

    def go():
        ingest(spark, str(folder / "in"), str(folder / "out"), str(folder / "check"), lambda a: a.select("id")).awaitTermination(120)
        return sorted(r["id"] for r in spark.read.parquet(str(folder / "out" / "rows")).collect())

    assert go() == ["PMC1", "PMC2"]
    shutil.rmtree(folder / "check" / "commits")
    assert go() == ["PMC1", "PMC2"]


def test_state_holds_an_id_each_and_batches_stay_flat(spark, tmp_path):
    source, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()

    def go(checkpoint=check):
        query = ingest(spark, str(source), out, checkpoint, lambda a: a.select("id"), files=2)
        query.awaitTermination(120)
        return query

    for i in range(24):
        (source / f"a{i}.xml").write_text(ARTICLE.format(id=f"P{i % 20}"))
    (source / "none.xml").write_text(ARTICLE.format(id="").replace("<id></id>", ""))
    (source / "none2.xml").write_text(ARTICLE.format(id="").replace("<id></id>", ""))
    query = go()
    state = [p["stateOperators"][0] for p in query.recentProgress if p["numInputRows"]]
    assert len(state) == 13 and sum(s["numRowsUpdated"] for s in state) == state[-1]["numRowsTotal"] == 22
    assert max(s["numRowsUpdated"] for s in state) <= 2  # a batch touches its own ids
    read = lambda: sorted(str(r["id"]) for r in spark.read.parquet(f"{out}/rows").collect())
    first = read()
    assert first == sorted(["None", "None", *[f"P{i}" for i in range(20)]])
    (source / "again.xml").write_text(ARTICLE.format(id="P3"))
    go()  # a restart finds the ids
    assert read() == first
    go(str(tmp_path / "other"))  # another checkpoint: ids that were taken stay out, rows without one come again
    assert read() == sorted([*first, "None", "None"])
