from quillspan.llm.known_licenses import TEXTS
from quillspan.llm.license_scan import license_scan


def test_known_texts_in_other_dress(spark):
    mit = TEXTS["MIT"]
    rows = [
        (1, mit), (2, "Copyright (c) 2020 Someone\n\n" + mit.upper()), (3, mit.replace("sublicense", "sub-license").replace("NONINFRINGEMENT", "non-infringement")), (4, mit + " and more"),
        (5, "  released under the mit licence"), (6, None), (7, ""), (8, "© 2021 A. All rights reserved.\n" + TEXTS["ISC"].replace("\n", " ")), (9, "x " * 50_000), (9, TEXTS["Zlib"].replace("acknowledgment", "acknowledgement")),
    ]
    df = spark.createDataFrame([(a, b, "mine") for a, b in rows], "doc_id long, text string, license_id string")
    got = sorted((r["doc_id"], r["license_id"]) for r in license_scan(df).collect() if r["license_id"])
    assert got == [(1, "MIT"), (2, "MIT"), (3, "MIT"), (5, "MIT-line"), (8, "ISC"), (9, "Zlib")]
    assert license_scan(df).count() == len(rows) and license_scan(df.limit(0)).count() == 0


def test_known_texts_differ(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS.values())), "doc_id long, text string")
    assert [r["license_id"] for r in license_scan(df).orderBy("doc_id").collect()] == list(TEXTS)


def test_titled_files_and_full_texts(spark):
    notice = "Copyright (c) 2020 Someone\n"
    rows = [(f"{title}\n\n{notice}{TEXTS[name]}", name) for name, title in (("MIT", "MIT License"), ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("ISC", "ISC License"))]
    rows += [(notice + TEXTS["BSD-3-Clause"], "BSD-3-Clause")]
    for name, words in (("Apache-2.0", 1500), ("GPL-2.0", 2500), ("GPL-3.0", 5000), ("LGPL-2.1", 4000), ("MPL-2.0", 2000), ("CC0-1.0", 900)):
        assert len(TEXTS[name].split()) > words
        rows.append((TEXTS[name].upper(), name))
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string")
    got = [(r["license_id"] or "").split("-titled")[0] for r in license_scan(df).orderBy("doc_id").collect()]
    assert got == [name for _, name in rows]


def test_line_ends_dont_matter(spark):
    """Every known text, reflowed at three widths and in capitals, below a notice."""
    import textwrap

    def reflowed(text, width):
        return "\n\n".join(textwrap.fill(" ".join(p.split()), width, break_long_words=False, break_on_hyphens=False) for p in text.split("\n\n"))

    rows = [(name, "Copyright (c) 1999-2021 The Someone Project, and others\n© Someone Else\n\n" + reflowed(t, w).upper()) for name, t in TEXTS.items() for w in (37, 61, 5000)]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    assert [r["license_id"] for r in license_scan(df).orderBy("doc_id").collect()] == [n for n, _ in rows]


def test_lines_that_are_a_notice(spark):
    text = "Some words.\n  RELEASED under the MIT licence!\nMore of them\nLicensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0.\nlicensed to nobody"
    rows = [(1, text), (2, "This is not released under the MIT License. Or is it?"), (3, None), (4, ""), (5, "(c) 2020 me"), (6, "x " * 200_000 + "\nReleased under the MIT License."), (None, text)]
    got = {r["doc_id"]: (r["license_id"], r["line_licenses"]) for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    none = (None, "")
    assert got == {1: (None, "CC-BY-NC-4.0-line,MIT-line"), None: (None, "CC-BY-NC-4.0-line,MIT-line"), 2: none, 3: none, 4: none, 5: none, 6: (None, "MIT-line")}


def test_finds_the_notices_of_the_tables(spark, data):
    from quillspan.llm.queries import op8_license_scan

    rows = op8_license_scan(spark, data).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    lines = {TEXTS[k].lower(): k for k in TEXTS if k.endswith("-line")}
    expected = {d: ",".join(sorted({lines[x.lower()] for x in t.split("\n") if x.lower() in lines})) for d, t in docs.items()}
    assert {r["doc_id"]: r["line_licenses"] for r in rows} == expected and any(expected.values())
