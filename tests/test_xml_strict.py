"""The document reader against a plain tree walk, on documents that differ from the documented form in every way we know of."""

import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from tcelake.operators.profile import PathTree, profile_paths
from tcelake.operators.shred import SHREDDERS, shred_all
from tcelake.sources.folder import case_file_stream, case_files, ranges, write_files
from tcelake.sources.xml_docs import parse_documents, parsed_documents

FORMS = {
    "case.xml": b"<tce><BaselineYear>1991</BaselineYear><baselineCD4><COUNT>7</COUNT><count>8</count></baselineCD4></tce>",
    "markup.xml": b"<tce><baselineYear>19<b>x</b>99</baselineYear><baselineCD4><count><v>1</v></count></baselineCD4></tce>",
    "namespace.xml": b'<tce xmlns="u"><baselineYear>1999</baselineYear><pastCD4><count>1</count></pastCD4></tce>',
    "prefixed.xml": b'<tce xmlns:a="u"><a:baselineYear>1</a:baselineYear><baselineYear>2</baselineYear></tce>',
    "undeclared.xml": b"<tce><a:b>1</a:b></tce>",
    "ascii.xml": b'<?xml version="1.0" encoding="US-ASCII"?><tce><dateUnit>caf\xc3\xa9</dateUnit></tce>',
    "odd16.xml": b"\xfe\xff" + "<tce/>".encode("utf-16-be") + b"\xd8",
    "lone16.xml": b"\xff\xfe" + "<tce><dateUnit>".encode("utf-16-le") + b"\x00\xd8x\x00" + "</dateUnit></tce>".encode("utf-16-le"),
    "entity.xml": b'<!DOCTYPE t [<!ENTITY a "weeks">]><tce><dateUnit>&a;</dateUnit></tce>',
    "bomb.xml": b"<!DOCTYPE t [<!ENTITY a0 '" + b"x" * 100 + b"'>" + b"".join(b"<!ENTITY a%d '%s'>" % (i + 1, b"&a%d;" % i * 20) for i in range(6))
                + b"]><tce><dateUnit>&a6;</dateUnit></tce>",
    "deep.xml": b"<tce>" + b"<w>" * 5000 + b"</w>" * 5000 + b"</tce>",
    "root.xml": b"<baselineCD4><count>1</count><baselineCD4><count>2</count></baselineCD4></baselineCD4>",
    "nested.xml": b"<tce><baselineIsolate><gene>A</gene><baselineIsolate><gene>B</gene><aaMutation><position>1</position></aaMutation>"
                  b"</baselineIsolate></baselineIsolate></tce>",
    "nul.xml": b"<tce>\x00</tce>", "none.xml": None, "empty.xml": b"", "spaces.xml": b"  \n",
}


def expected(name, content):
    """The five tables' rows of one file, by the definitions."""
    out = {t: [] for t in SHREDDERS}
    try:
        root = ET.fromstring(content)
    except Exception:  # noqa: BLE001
        return None
    alias = root.findtext("patient/patientAlias")
    out["tce_case"].append((name, alias, root.findtext("baselineYear"), root.findtext("patient/CD4NadirBeforeTCE"), root.findtext("dateUnit"),
                            root.findtext("schemaVersion")))
    for time in ("baseline", "past", "followup"):
        for kind, fields in (("RNA", ("logLoad", "rawLoad")), ("CD4", ("count",))):
            out["tce_measurements"] += [(name, alias, n.findtext("relativeDate"), kind, time + kind, time, n.findtext(f), f)
                                        for n in root.findall(f".//{time}{kind}") for f in fields if n.findtext(f)]
    for kind in ("baseline", "past"):
        for i, n in enumerate(root.findall(f".//{kind}Isolate")):
            out["tce_isolates"].append((name, alias, f"{name}_{kind}_{i}", kind, *[n.findtext(x) for x in (
                "gene", "subtype", "relativeDate", "aaStart", "aaStop", "aaSequence", "nucleotideSequence")]))
            out["tce_mutations"] += [(name, alias, f"{name}_{kind}_{i}", kind, n.findtext("gene"), n.findtext("relativeDate"), m.findtext("position"),
                                      m.findtext("aminoAcid"), m.findtext("mixtures")) for m in n.findall(".//aaMutation")]
    for tag, kind in (("baselineNewTreatment", "new"), ("pastRegimenTreatments", "past")):
        out["tce_treatments"] += [(name, alias, *[n.findtext(x) for x in ("relativeStartDate", "relativeStopDate", "duration")], d.findtext("drugCode"),
                                   d.findtext("drugClass"), kind) for n in root.findall(f".//{tag}") for d in n.findall("drug")]
    return out


def check(spark, files):
    df = spark.createDataFrame(list(files.items()), "xml_filename string, content binary")
    docs, bad = parse_documents(df, "xml_filename", "content")
    want = {n: None if c is None else expected(n, c) for n, c in files.items()}
    assert {r.xml_filename for r in bad.collect()} == {n for n, w in want.items() if w is None}
    for table, rows in shred_all(docs).items():
        got = sorted((tuple(r) for r in rows.collect()), key=repr)
        assert got == sorted((r for w in want.values() if w for r in w[table]), key=repr), table


def test_documents_of_every_known_form(spark):
    check(spark, FORMS)
    df = spark.createDataFrame(list(FORMS.items()), "xml_filename string, content binary")
    year = {r.xml_filename: r.doc.baselineYear for r in parsed_documents(df, "xml_filename", "content", ["baselineYear"]).collect() if r.doc}
    assert year["case.xml"] is None and year["markup.xml"] == "19" and year["namespace.xml"] is None and year["prefixed.xml"] == "2"


def test_random_documents(spark):
    rng = random.Random(11)
    names = ["patient", "patientAlias", "baselineYear", "baselineRNA", "logLoad", "rawLoad", "relativeDate", "pastCD4", "count", "baselineIsolate", "pastIsolate",
             "gene", "aaMutation", "position", "baselineNewTreatment", "drug", "drugCode", "drugClass", "wrap", "o:gene", "Gene", "dateUnit"]

    def element(depth):
        name = rng.choice(names)
        inner = "".join(rng.choice(["", " ", "7", "a&amp;b", "<![CDATA[<x>]]>", "<!-- c -->", "é"]) + (element(depth - 1) if rng.random() < 0.8 else "")
                        for _ in range(rng.randrange(0, 5))) if depth else rng.choice(["", "x", " y "])
        return f"<{name}>{inner}</{name}>"

    files = {}
    for i in range(300):
        text = f'<tce xmlns:o="u">{"".join(element(4) for _ in range(rng.randrange(0, 6)))}</tce>'
        data = text.encode(["utf-8", "utf-16"][i % 2])
        if i % 10 == 0:
            cut = rng.randrange(len(data))
            data = data[:cut] + bytes([rng.randrange(256)]) + data[cut + 1:]
        files[f"{i}.xml"] = data
    check(spark, files)


def test_text_documents_keep_their_declared_charset_out(spark):
    df = spark.createDataFrame([("a", '<?xml version="1.0" encoding="windows-1252"?><tce><dateUnit>é</dateUnit></tce>')], "k string, t string")
    docs, _ = parse_documents(df, "k", "t")
    assert docs.first().dateUnit == "é"


def test_path_tree_counts_documents_and_elements(spark):
    tree = PathTree()
    for i, text in enumerate(["<a><b/><b><c/></b></a>", "<a><b/></a>", "<c/>"]):
        tree.add(ET.fromstring(text), i)
    assert dict(zip(tree.paths(), zip(tree.n_docs, tree.n_nodes)))["a/b"] == (2, 3) and "a/b/c" in tree.paths() and "c" in tree.paths()
    df = spark.createDataFrame([(b"<a><b/><b/></a>",)] * 5 + [(b"<a",), (None,)], "content binary").repartition(3)
    assert {r.path: (r.n_docs, r.n_nodes, r.in_schema) for r in profile_paths(df, "content", ["a"]).collect()} == {"a": (5, 5, True), "a/b": (5, 10, False)}


@pytest.fixture()
def folder(spark, tmp_path):
    path = str(tmp_path / "files")
    files = spark.range(200).select(F.concat("id", F.lit(".xml")).alias("xml_filename"), F.when(F.col("id") % 9 == 0, F.lit(b"")).otherwise(
        F.encode(F.concat(F.lit("<tce><dateUnit>"), "id", F.lit("</dateUnit></tce>")), "UTF-8")).alias("content"))
    assert write_files(files, path) == 200
    (tmp_path / "files" / "note.txt").write_text("<tce/>")
    (tmp_path / "files" / "sub").mkdir()
    (tmp_path / "files" / "sub" / "x.xml").write_text("<tce/>")
    return path


def test_folder_source_reads_every_file_once(spark, folder, tmp_path):
    for n in (1, 7):
        rows = {r.xml_filename: bytes(r.content) for r in case_files(spark, folder, partitions=n).collect()}
        assert len(rows) == 200 and rows["9.xml"] == b"" and rows["10.xml"] == b"<tce><dateUnit>10</dateUnit></tce>"
    assert case_files(spark, folder).count() == 200                       # no name twice
    bounds = ranges(7)
    assert bounds[0].low == 0 and bounds[-1].high == 1 << 32 and all(a.high == b.low for a, b in zip(bounds, bounds[1:]))
    (tmp_path / "none").mkdir()
    assert case_files(spark, str(tmp_path / "none")).count() == 0


def test_folder_stream_takes_new_files_once(spark, folder, tmp_path):
    import os
    import time
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")

    def run():
        time.sleep(1.1)                                                   # the settling time below
        case_file_stream(spark, folder, partitions=3, settle_seconds=1).writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", mark).trigger(once=True).start().awaitTermination(120)
        return sorted(r.xml_filename for r in spark.read.parquet(out).collect())

    assert len(run()) == 200
    with open(os.path.join(folder, "new.xml"), "w") as f:
        f.write("<tce/>")
    seen = run()
    assert len(seen) == 201 and "new.xml" in seen
