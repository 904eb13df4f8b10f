"""What a task holds does not grow with its input: row groups, archive batches, parsed trees, and the plan of the case files."""

import datetime
import glob
import io
import tarfile
import weakref
import xml.etree.ElementTree as ET

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tcelake.operators.profile import PathTree
from tcelake.schema import DOCUMENT_SHAPE
from tcelake.session import checkpoint_root, setting
from tcelake.sources import archive, driver_docs, xml_docs
from tcelake.sources.driver_tables import DriverSources


def test_index_shards_fill_row_groups_of_bounded_size(spark, monkeypatch):
    from tcelake.llm import common, fmindex
    monkeypatch.setitem(common.LARGE_ROWS, "parquet.block.size", str(1 << 18))
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(glob.glob(f"{root}/llm-fm-shards-*"))
    words = np.random.default_rng(3).integers(0, 1 << 20, 1 << 17).astype(str)
    docs = spark.createDataFrame([("en", " ".join(words[i::8])) for i in range(8)], "lang string, text string").coalesce(1)
    fmindex.collocations(docs, shard_words=1 << 12)
    own, = set(glob.glob(f"{root}/llm-fm-shards-*")) - before
    groups = [m.row_group(i) for f in glob.glob(f"{own}/*.parquet") for m in [pq.ParquetFile(f).metadata] for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) >= 32
    assert max(g.num_rows for g in groups) <= 16


def test_rare_triples_of_frequent_pairs_are_not_counted_by_text(spark, monkeypatch):
    from tcelake.llm import fmindex
    made, counts = [], fmindex.phrase_counts
    monkeypatch.setattr(fmindex, "phrase_counts", lambda *given: made.append(counts(*given)) or made[-1])
    words = np.random.default_rng(4).integers(0, 30, 20_000).astype(str)
    docs = spark.createDataFrame([("en", " ".join(words[i::8]) + " one two three" * 10) for i in range(8)], "lang string, text string")
    fmindex.collocations(docs, shard_words=1 << 12)
    found = {r["length"]: (r["all"], r["rare"]) for r in made[0].groupBy("length").agg(F.count("*").alias("all"), F.count_if(F.col("n") < 10).alias("rare")).collect()}
    assert found[2][0] > 800 and found[3][0] > 0 and found[3][1] < 50            # of some 14,000 triples


def test_members_of_many_archives_leave_in_bounded_batches():
    def packed(names):
        buf = io.BytesIO()
        with tarfile.open(fileobj=buf, mode="w:gz") as tar:
            for name in names:
                info = tarfile.TarInfo(name)
                info.size = 100
                tar.addfile(info, io.BytesIO(b"x" * 100))
        return buf.getvalue()

    names = [[f"{a}-{i}.xml" for i in range(4)] for a in range(3)]
    given = pa.RecordBatch.from_arrays([pa.array(["a", "b", "c", "broken", "none"]), pa.array([*map(packed, names), b"no archive", None], pa.binary())],
                                       names=["archive", "content"])
    batches = list(archive._members([given], "*.xml", batch_bytes=300))
    assert max(sum(len(c) for c in b.column("content").to_pylist() if c) for b in batches) <= 300
    rows = [(r["archive"], r["member"]) for b in batches for r in b.to_pylist()]
    assert rows == [*((a, m) for a, own in zip("abc", names) for m in own), ("broken", None)]


def test_trees_are_dropped_one_by_one():
    class Root(ET.Element):
        pass

    made = []

    def roots():
        for i in range(3):
            assert all(m() is None for m in made)
            root = Root("tce")
            ET.SubElement(ET.SubElement(root, "baselineCD4"), "count").text = str(i)
            made.append(weakref.ref(root))
            yield root
            root = None
            yield None

    rows = xml_docs.document_array(roots(), DOCUMENT_SHAPE).to_pylist()
    assert [r and r["baselineCD4"][0]["count"] for r in rows] == ["0", None, "1", None, "2", None]


def test_case_files_are_collected_once_over_sorted_rows(spark, tmp_path):
    day = datetime.datetime(2000, 1, 1)
    tables = {
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
                   [(1, 5, "F", 2.0, day, "1-URGENT"), (2, 6, "O", 3.0, day, None), (2, 7, "O", 3.0, day, None), (None, 8, "O", 4.0, day, None)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, "
                     "l_shipdate timestamp_ntz",
                     [(1, 10, 1, 1, 7.0, "R", "O", day), (1, 99, 1, 2, 8.0, "A", "F", day), (1, 10, 1, 3, 9.0, None, "F", day), (2, 11, 1, 2, 5.0, "N", "F", day),
                      (2, 10, 1, 1, 5.0, "N", "F", day), (None, 10, 1, 1, 5.0, "N", "F", day), (3, 10, 1, 1, 5.0, "R", "F", day)]),
        "part": ("p_partkey long, p_brand string, p_type string, p_size int", [(10, "A", "LARGE", 1), (10, "B", "SMALL", 2), (11, "C", "PROMO", 3)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    src = DriverSources(spark, str(tmp_path))
    with setting(spark, "spark.sql.execution.replaceHashWithSortAgg", "true"):
        docs = driver_docs.case_documents(src)
        plan = docs._jdf.queryExecution().executedPlan().toString()
        got = docs.collect()
    assert "ObjectHashAggregate" not in plan and "partial_collect_list" not in plan
    seen = {}
    for r in got:
        root = ET.fromstring(r.xml)
        count = {tag: len(root.findall(tag)) for tag in DOCUMENT_SHAPE if root.find(tag) is not None}
        count["genes"] = [n.findtext("gene") for n in root.findall("baselineIsolate")]
        seen.setdefault(r.xml_filename, []).append(count)
    leaves = {"patient": 1, "baselineYear": 1, "schemaVersion": 1}
    assert seen["1.xml"] == [{**leaves, "dateUnit": 1, "followupRNA": 1, "baselineCD4": 1, "baselineNewTreatment": 2, "pastRegimenTreatments": 2, "genes": []}]
    # An order that is there twice doubles its lines, in both of its files.
    assert seen["2.xml"] == [{**leaves, "baselineIsolate": 4, "pastRegimenTreatments": 6, "genes": ["RT", "RT", "IN", "IN"]}] * 2
    assert seen[None] == [{**leaves, "genes": []}] and len(got) == 4


def _order_tables(spark, folder, backwards=False):
    """Driver tables of two orders, one of them without most leaves; the rows of both forms are the same."""
    day, later = datetime.datetime(2000, 1, 1), datetime.datetime(2000, 5, 1)
    tables = {
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
                   [(1, 5, "F", 2.0, day, "1-URGENT"), (97, None, "O", None, None, None)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, "
                     "l_shipdate timestamp_ntz",
                     [(1, 10, 1, 1, 7.0, "R", "O", later), (1, 10, 1, 7, 50.0, "A", "F", day), (1, 10, 5, 3, 9.0, "N", "F", day), (1, 11, 5, 2, 46.0, "N", "F", day),
                      (1, 11, 1, 2, None, "N", None, None), (97, 12, 1, None, None, "R", None, None), (97, 12, None, None, 1.0, "N", None, None)]),
        "part": ("p_partkey long, p_brand string, p_type string, p_size int", [(10, "A&B <\"x'>]]>\r\n é", "LARGE", 1), (11, "", "STANDARD", 2), (12, None, "none", 3)]),
    }
    for name, (schema, rows) in tables.items():
        spark.createDataFrame(rows[::-1] if backwards else rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return DriverSources(spark, str(folder))


def test_case_files_are_the_same_whatever_order_lines_come_in(spark, tmp_path):
    made = [{r.xml_filename: r.xml for r in driver_docs.case_documents(_order_tables(spark, tmp_path / str(b), b)).collect()} for b in (False, True)]
    assert made[0] == made[1] and made[0].keys() == {"1.xml", "97.xml"}
    one = ET.fromstring(made[0]["1.xml"])
    assert sorted(c.text or "" for c in one.iter("drugCode")) == ["", "", *["A&B <\"x'>]]>\r\n é"] * 2]
    assert [n.findtext("gene") for n in one.iter("pastIsolate")] == ["IN"] and [n.findtext("aaStop") for n in one.iter("baselineIsolate")] == ["92", "93"]


def test_case_files_have_the_form_of_to_xml(spark, tmp_path):
    got = {r.xml_filename: r.xml for r in driver_docs.case_documents(_order_tables(spark, tmp_path)).collect()}
    leaf = "array<string>"
    shape = (f"patient array<struct<patientAlias:{leaf}, CD4NadirBeforeTCE:{leaf}>>, schemaVersion {leaf}, baselineRNA array<struct<rawLoad:{leaf}, relativeDate:{leaf}>>, "
             f"pastIsolate array<struct<gene:{leaf}, subtype:{leaf}, aaStart:{leaf}, aaMutation:array<struct<aminoAcid:{leaf}>>>>, "
             f"pastRegimenTreatments array<struct<relativeStartDate:{leaf}, drug:array<struct<drugCode:{leaf}>>>>")
    isolate = (["PR"], ["C"], ["1"], [(["P"],)])
    row = ([(None, None)], ["1.1"], [(None, None)], [isolate], [(None, [(None,)])] * 2)
    want = spark.createDataFrame([row], shape).select(F.to_xml(F.struct("*"), {"rowTag": "tce"})).first()[0]
    assert got["97.xml"] == want


def test_case_files_are_written_by_methods_that_the_jvm_compiles(spark, tmp_path, monkeypatch):
    seen, forms = [], driver_docs.varied_documents
    monkeypatch.setattr(driver_docs, "varied_documents", lambda text: seen.append(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) or forms(text))
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    _order_tables(spark, tmp_path)
    assert driver_docs.driver_corpus(spark, str(tmp_path)).count() == 2
    assert seen == ["8000"] and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == before


def test_mutations_are_found_without_path_expressions():
    class Isolate(ET.Element):
        def findall(self, path, namespaces=None):
            raise AssertionError(path)

    root = ET.Element("tce")
    isolate = Isolate("pastIsolate")
    root.append(isolate)
    ET.SubElement(isolate, "gene").text = "RT"
    for position, above in (("41", ET.SubElement(isolate, "set")), ("215", isolate)):
        ET.SubElement(ET.SubElement(above, "aaMutation"), "position").text = position
    row, = xml_docs.document_array(iter([root]), {"pastIsolate": DOCUMENT_SHAPE["pastIsolate"]}).to_pylist()
    assert [m["position"] for m in row["pastIsolate"][0]["aaMutation"]] == ["41", "215"] and row["pastIsolate"][0]["gene"] == "RT"


def test_known_paths_are_not_looked_up_element_by_element(monkeypatch):
    calls, child = [], PathTree.child
    monkeypatch.setattr(PathTree, "child", lambda self, node, name: calls.append(name) or child(self, node, name))
    tree = PathTree()
    for i in range(50):
        tree.add(ET.fromstring("<a><b/><b><c/><c><d/></c></b><e><b><c/></b></e></a>"), i)
    tree.add(ET.fromstring("<a/>"), 50)
    assert len(calls) == 7
    assert dict(zip(tree.paths()[1:], zip(tree.n_docs[1:], tree.n_nodes[1:]))) == {
        "a": (51, 51), "a/b": (50, 100), "a/b/c": (50, 100), "a/b/c/d": (50, 50), "a/e": (50, 50), "a/e/b": (50, 50), "a/e/b/c": (50, 50)}


def test_archives_are_not_packed_at_the_slowest_compression():
    names = ["b.xml", "a.xml", "é" * 80 + ".xml", "dir/" + "x" * 200 + ".xml", "a.xml"]
    data = [b"b" * 512, b"", b"1", b"x" * 513, bytes(range(256)) * 9]
    packed = archive._pack(pa.table({"archive": ["7"] * 5, "member": names, "content": pa.array(data, pa.binary())}))
    content = packed.column("content")[0].as_py()
    assert packed.column("archive").to_pylist() == ["7"] and content[8] != 2               # 2: slowest compression
    rows = [r for b in archive._members(packed.to_batches(), "*.xml") for r in b.to_pylist()]
    assert [(r["archive"], r["member"], r["content"]) for r in rows] == [("7", n, d) for n, d in sorted(zip(names, data))]


def test_a_cut_archive_gives_its_whole_members_and_a_row_without_one():
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as tar:
        for name, size in (("a.xml", 700), ("b.txt", 5), ("c.xml", 5000)):
            info = tarfile.TarInfo(name)
            info.size = size
            tar.addfile(info, io.BytesIO(b"x" * size))
    given = pa.RecordBatch.from_arrays([pa.array(["cut"]), pa.array([buf.getvalue()[:4000]], pa.binary())], names=["archive", "content"])
    rows = [(r["member"], r["content"]) for b in archive._members([given], "*.xml") for r in b.to_pylist()]
    assert rows == [("a.xml", b"x" * 700), (None, None)]
