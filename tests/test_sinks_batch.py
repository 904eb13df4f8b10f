"""Sinks, catalog, the batch job (M14), streaming ingest, JSON/CSV jobs, archives."""

import io
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from tcelake.plans.batch import run
from tcelake.plans.side_jobs import brand_price, feature_csv_roundtrip, projected_products
from tcelake.sinks.catalog import deprecate_missing, register_tables
from tcelake.sinks.datasets import read_dataset, write_dataset, write_json_lines, write_sorted_text
from tcelake.sources.archive import archive_members
from tcelake.sources.json_records import json_records, json_table
from tcelake.streaming.ingest import start_ingest


def test_partitioned_write_register_prune_and_deprecate(spark, tmp_path):
    df = spark.createDataFrame([("1.xml", "RNA", "4.5"), ("1.xml", "CD4", "200"), ("2.xml", "RNA", "3.1")],
                               "xml_filename string, measurement_type string, value string")
    uri = str(tmp_path / "m")
    write_dataset(df, uri, partition_by=["measurement_type"])
    assert sorted(x for x in os.listdir(uri) if not x.startswith(("_", "."))) == [
        "measurement_type=CD4", "measurement_type=RNA"]
    write_dataset(df.filter("measurement_type = 'RNA'"), uri, partition_by=["measurement_type"], dynamic=True)  # rerun-safe
    assert read_dataset(spark, uri).count() == 3
    st = register_tables(spark, "tdb", {"meas": uri}, partitions={"meas": ["measurement_type"]})
    assert st[0].partitions == 2
    q = spark.table("tdb.meas").filter(F.col("measurement_type") == "RNA")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(measurement_type" in plan and q.count() == 2
    other = str(tmp_path / "gone")
    write_dataset(df, other)
    register_tables(spark, "tdb", {"gone": other})
    import shutil
    shutil.rmtree(other)
    assert deprecate_missing(spark, "tdb") == ["gone"]
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES tdb.gone").collect()}
    assert props.get("deprecated") == "true"


def test_register_raises_on_missing(spark, tmp_path):
    import pytest
    with pytest.raises(RuntimeError):
        register_tables(spark, "tdb2", {"x": str(tmp_path / "nope")})


def test_batch_run(spark, case_dir, tmp_path):
    import pytest
    with pytest.raises(Exception):   # strict casts (parity): the empty CD4 nadir leaf fails the fact (T1)
        run(spark, case_dir, str(tmp_path / "strict"))
    out = str(tmp_path / "out")
    s = run(spark, case_dir, out, db="tce_run", strict=False)
    assert s.files == 25 and s.quarantined == 6 and s.rows["tce_case"] == 19
    assert s.rows["tce_treatments"] > 0 and s.reports["fact_tce"] == 19
    assert "measurement_type=CD4" in os.listdir(f"{out}/tce_measurements")
    assert spark.table("tce_run.tce_case").count() == 19


def test_streaming_ingest_available_now(spark, case_dir, tmp_path):
    out, ckpt = str(tmp_path / "stream"), str(tmp_path / "ckpt")
    start_ingest(spark, case_dir, out, ckpt).awaitTermination()
    assert read_dataset(spark, f"{out}/tce_case").count() == 19
    # a second run sees no new files and adds nothing
    start_ingest(spark, case_dir, out, ckpt).awaitTermination()
    assert read_dataset(spark, f"{out}/tce_case").count() == 19


def test_json_sources_and_price_report(spark, tmp_path):
    whole = tmp_path / "whole"
    whole.mkdir()
    (whole / "p.json").write_text('{\n "products": [\n  {"brand": "A", "price": 1.0},\n  {"price": 3.0},\n'
                                  '  {"brand": "A", "price": 2.0}\n ]\n}\n')
    recs = json_records(spark, str(whole), "products", multi_line=True)
    assert recs.count() == 3
    assert json_table(spark, str(whole), "products", multi_line=True).count() == 3
    rep = [tuple(r) for r in brand_price(projected_products(spark, str(whole), multi_line=True)).collect()]
    assert rep == [("N/A", 3.0), ("A", 1.5)]


def test_json_lines_products(spark, tmp_path):
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.json").write_text('{"products":[{"brand":"A","price":1.0},{"price":3.0}]}\n'
                                  '{"products":[{"brand":"A","price":2.0},{"brand":null,"price":5.0}]}\n')
    rep = [tuple(r) for r in brand_price(projected_products(spark, str(lines))).collect()]
    assert rep == [(None, 5.0), ("N/A", 3.0), ("A", 1.5)]
    out = str(tmp_path / "out.json")
    write_json_lines(projected_products(spark, str(lines)), out)
    assert spark.read.json(out).count() == 4


def test_feature_csv_and_sorted_text(spark, tmp_path):
    part = spark.createDataFrame([(9, "n9", "T", 10), (1, "n1", "T", 2), (2, "n2", "T", 9)],
                                 "p_partkey long, p_name string, p_type string, p_size int")
    back = feature_csv_roundtrip(spark, part, str(tmp_path / "f.csv"))
    assert [r.release_version for r in back.collect()] == ["0.10", "0.2", "0.9"]   # text order
    paths = spark.createDataFrame([("b",), ("a",)], "path string")
    write_sorted_text(paths, "path", str(tmp_path / "paths"))
    assert [r.value for r in spark.read.text(str(tmp_path / "paths")).collect()] == ["a", "b"]


def test_archive_members(spark, tmp_path, case_dir):
    d = tmp_path / "arch"
    d.mkdir()
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as tar:              # plain tar named .tar.gz, like the reference's
        for name in ("1.xml", "blank.xml"):
            data = open(os.path.join(case_dir, name), "rb").read()
            info = tarfile.TarInfo(f"xmls_db/{name}")
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
        info = tarfile.TarInfo("xmls_db/readme.txt")
        info.size = 2
        tar.addfile(info, io.BytesIO(b"hi"))
    (d / "cases.tar.gz").write_bytes(buf.getvalue())
    (d / "broken.tar.gz").write_bytes(b"not an archive")
    m = archive_members(spark, str(d), "*.tar.gz", "*.xml")
    got = sorted((r.archive, r.member) for r in m.collect())
    assert got == [("broken.tar.gz", None), ("cases.tar.gz", "xmls_db/1.xml"), ("cases.tar.gz", "xmls_db/blank.xml")]


def test_bucketed_batch_run_avoids_source_shuffles(spark, case_dir, tmp_path):
    from tcelake.plans.models import Models
    s = run(spark, case_dir, str(tmp_path / "bucketed"), db="tce_bkt", strict=False, buckets=4)
    assert s.rows["tce_case"] == 19 and s.reports["fact_tce"] == 19
    tables = {n: spark.table(f"tce_bkt.{n}") for n in s.rows}
    m = Models(tables, strict=False)
    plan = m.measure_pivot().join(tables["tce_case"], "xml_filename")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan      # aggregation + join read co-partitioned buckets


def test_streaming_batch_retry_is_idempotent(spark, case_dir, tmp_path):
    from tcelake.streaming.ingest import _append_batch
    from tcelake.sources.xml_docs import raw_files
    out = str(tmp_path / "retry")
    batch = raw_files(spark, case_dir).select("xml_filename", "content")
    write = _append_batch(out)
    write(batch, 7)
    write(batch, 7)                                   # the same micro-batch retried after a failure
    write(batch.filter(F.col("xml_filename") == "1.xml"), 8)
    cases = read_dataset(spark, f"{out}/tce_case")
    assert cases.filter("ingest_batch = 7").count() == 19 and cases.filter("ingest_batch = 8").count() == 1


def test_cleaned_products_roundtrip(spark, tmp_path):
    from tcelake.plans.side_jobs import cleaned_products_roundtrip
    lines = tmp_path / "docs"
    lines.mkdir()
    (lines / "a.json").write_text('{"products":[{"brand":"A","price":1.0},{"price":3.0},{"brand":null,"price":5.0}]}\n')
    back = cleaned_products_roundtrip(spark, str(lines), str(tmp_path / "clean"))
    assert sorted(back.columns) == ["brand", "price"]
    assert [tuple(r) for r in brand_price(back).collect()] == [(None, 5.0), ("N/A", 3.0), ("A", 1.0)]


def test_full_rebuild_leaves_nothing_of_the_earlier_corpus(spark, tmp_path):
    uri = str(tmp_path / "rebuilt")
    write_dataset(spark.createDataFrame([("a", "RNA"), ("b", "CD4")], "xml_filename string, measurement_type string"), uri,
                  partition_by=["measurement_type"])
    write_dataset(spark.createDataFrame([("c", "RNA")], "xml_filename string, measurement_type string"), uri,
                  partition_by=["measurement_type"])
    assert [tuple(r) for r in read_dataset(spark, uri).select("xml_filename", "measurement_type").collect()] == [("c", "RNA")]


def test_registering_again_reads_the_new_location_and_schema(spark, tmp_path):
    from tcelake.sinks.catalog import register_tables
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    write_dataset(spark.range(3), first)
    write_dataset(spark.range(7).selectExpr("id", "id * 2 AS twice"), second)
    register_tables(spark, "tcelake_moved", {"t": first})
    assert spark.table("tcelake_moved.t").count() == 3
    register_tables(spark, "tcelake_moved", {"t": second})
    assert spark.table("tcelake_moved.t").count() == 7 and spark.table("tcelake_moved.t").columns == ["id", "twice"]
    spark.sql("DROP DATABASE tcelake_moved CASCADE")


def test_refilled_table_holds_the_new_rows_only(spark, tmp_path):
    from tcelake.sinks.catalog import refill_table
    rows = lambda *r: spark.createDataFrame(r, "x long, name string")
    uri, db = str(tmp_path / "refilled"), "tcelake_refilled"
    assert refill_table(rows((1, "a"), (2, None)), db, "t", uri) == f"{db}.t"
    refill_table(rows((3, "c")).select("name", "x"), db, "t", str(tmp_path / "elsewhere"))     # columns by name, location kept
    assert [tuple(r) for r in spark.table(f"{db}.t").collect()] == [(3, "c")] and not (tmp_path / "elsewhere").exists()
    with pytest.raises(RuntimeError, match="columns"):
        refill_table(spark.range(2), db, "t", uri)
    with pytest.raises(Exception, match="null in name"):
        refill_table(rows((4, None)), db, "t", uri, not_null=["name"])
    refill_table(rows(), db, "t", uri)
    assert spark.table(f"{db}.t").count() == 0
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_damaged_json_documents(spark, tmp_path):
    from tcelake.sources.json_records import json_rejects
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.json").write_text('{"products":[{"brand":"A"}]}\n{"products":[{"brand":"B"}\n{"other":1}\n{"products":[{"brand":"C"}]}\n')
    assert sorted(r.record["brand"] for r in json_records(spark, str(lines), "products").collect()) == ["A", "C"]
    assert [r.doc for r in json_rejects(spark, str(lines), "products").collect()] == ['{"products":[{"brand":"B"}']
    with pytest.raises(Exception, match="not JSON"):
        json_records(spark, str(lines), "products", strict=True).collect()
