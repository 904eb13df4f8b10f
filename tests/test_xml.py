"""XML source, quarantine, shredders (U1-U5) and the path profiler (U6) on fixture files."""

from pyspark.sql import functions as F

from tcelake.operators.profile import path_listing, profile_paths
from tcelake.operators.shred import shred_all
from tcelake.sources.xml_docs import raw_files, xml_documents

GOOD = {"1.xml", "emptyleaf.xml", "repeated.xml", "emptyparent.xml", "blank.xml", "emptyisolate.xml", "nodrugs.xml",
        "unknownclass.xml", "dupdrug.xml", "twonodes.xml", "unknownelem.xml", "special.xml", "latin1.xml",
        "u8bom.xml", "u16.xml", "wrapped.xml", "cp1252.xml", "cdata.xml", "longdecl.xml"}
BAD = {"truncated.xml": "malformed", "notxml.xml": "malformed", "empty.xml": "malformed",
       "trailing.xml": "trailing content", "nocharset.xml": "malformed", "bad8.xml": "malformed"}


def _tables(spark, case_dir):
    docs, bad = xml_documents(spark, case_dir)
    return docs, bad, shred_all(docs)


def _rows(df, file):
    return [r.asDict() for r in df.filter(F.col("xml_filename") == file).collect()]


def test_scan_lists_only_xml_in_folder_and_quarantines(spark, case_dir):
    docs, bad, _ = _tables(spark, case_dir)
    assert {r.xml_filename for r in docs.select("xml_filename").collect()} == GOOD
    assert {r.xml_filename: r.reason for r in bad.collect()} == BAD
    assert docs.count() + bad.count() == len(GOOD) + len(BAD)   # counts add up to the number of files


def test_sample_document(spark, case_dir):
    _, _, t = _tables(spark, case_dir)
    case = _rows(t["tce_case"], "1.xml")
    assert case == [{"xml_filename": "1.xml", "patient_alias": "P-1", "baseline_year": "1999",
                     "cd4_nadir_before_tce": "150", "date_unit": "weeks", "schema_version": "1.0"}]
    meas = _rows(t["tce_measurements"], "1.xml")
    assert len(meas) == 6
    assert sorted((m["timepoint_tag"], m["value_type"], m["value"], m["timepoint_type"]) for m in meas) == sorted([
        ("baselineRNA", "logLoad", "4.5", "baseline"), ("baselineRNA", "rawLoad", "31000", "baseline"),
        ("followupRNA", "logLoad", "2.1", "followup"), ("followupRNA", "logLoad", "3.0", "followup"),
        ("baselineCD4", "count", "200", "baseline"), ("pastCD4", "count", "180", "past")])
    iso = _rows(t["tce_isolates"], "1.xml")
    assert sorted(r["isolate_id"] for r in iso) == ["1.xml_baseline_0", "1.xml_past_0"]
    muts = _rows(t["tce_mutations"], "1.xml")
    assert sorted((m["position"], m["amino_acid"], m["mixtures"], m["gene"]) for m in muts) == [
        ("215", "Y", "YF", "RT"), ("41", "L", None, "RT")]
    tr = _rows(t["tce_treatments"], "1.xml")
    assert sorted((r["treatment_type"], r["drug_code"], r["relative_start_date"], r["relative_stop_date"])
                  for r in tr) == [("new", "BBB", "0", None), ("new", "CCC", "0", None), ("past", "AAA", "-100", "0")]


def test_leaf_semantics(spark, case_dir):
    _, _, t = _tables(spark, case_dir)
    c = {r.xml_filename: r for r in t["tce_case"].collect()}
    assert c["emptyleaf.xml"].cd4_nadir_before_tce == ""          # present but empty -> '' (not NULL)
    assert c["emptyleaf.xml"].date_unit is None                   # missing -> NULL
    assert c["repeated.xml"].patient_alias == "first"             # first occurrence wins (T2)
    assert c["repeated.xml"].baseline_year == "2001"
    assert c["emptyparent.xml"].patient_alias == "filled"         # empty parent first (T16)
    assert c["special.xml"].baseline_year == "1999"               # comment dropped, text joined (T18)
    assert c["special.xml"].date_unit == "4.5"                    # CDATA
    assert c["special.xml"].schema_version == "a&b"               # entity
    assert c["latin1.xml"].patient_alias == "José"                # declared encoding honoured (T15)
    assert c["unknownelem.xml"].baseline_year == "2003"
    assert c["u8bom.xml"].baseline_year == "1998" and c["u16.xml"].baseline_year == "2002"   # byte-order marks


def test_elements_at_any_depth_and_valid_oddities(spark, case_dir):
    _, _, t = _tables(spark, case_dir)
    assert [(r["timepoint_tag"], r["value"]) for r in _rows(t["tce_measurements"], "wrapped.xml")] == [("baselineCD4", "5")]
    iso = _rows(t["tce_isolates"], "wrapped.xml")                 # numbered in document order, whatever their depth
    assert [(r["isolate_id"], r["gene"]) for r in sorted(iso, key=lambda r: r["isolate_id"])] == [
        ("wrapped.xml_baseline_0", "RT"), ("wrapped.xml_baseline_1", "PR")]
    assert [(r["gene"], r["position"]) for r in _rows(t["tce_mutations"], "wrapped.xml")] == [("RT", "41")]
    assert [r["drug_code"] for r in _rows(t["tce_treatments"], "wrapped.xml")] == ["AAA"]      # drugs: direct children only
    c = {r.xml_filename: r for r in t["tce_case"].collect()}
    assert c["cp1252.xml"].patient_alias == "Zoë €" and c["longdecl.xml"].patient_alias == "José"
    assert c["cdata.xml"].date_unit == "<tce>weeks" and c["cdata.xml"].baseline_year == "2004"


def test_measurement_truthiness(spark, case_dir):
    _, _, t = _tables(spark, case_dir)
    rows = _rows(t["tce_measurements"], "blank.xml")
    assert sorted((r["timepoint_tag"], r["value_type"], r["value"]) for r in rows) == [
        ("baselineRNA", "logLoad", "3.3"), ("pastRNA", "rawLoad", "   ")]   # '' dropped, whitespace kept (T7)


def test_isolate_and_treatment_edges(spark, case_dir):
    _, _, t = _tables(spark, case_dir)
    iso = _rows(t["tce_isolates"], "emptyisolate.xml")
    assert sorted((r["isolate_id"], r["gene"]) for r in iso) == [
        ("emptyisolate.xml_baseline_0", None), ("emptyisolate.xml_baseline_1", "RT")]
    assert _rows(t["tce_treatments"], "nodrugs.xml") == []
    assert len(_rows(t["tce_treatments"], "dupdrug.xml")) == 2
    assert sorted(r["drug_code"] for r in _rows(t["tce_treatments"], "twonodes.xml")) == ["AAA", "DDD"]


def test_profiler_reports_paths_and_off_schema(spark, case_dir):
    raw = raw_files(spark, case_dir)
    prof = {r.path: r for r in profile_paths(raw, "content").collect()}
    assert prof["tce"].n_docs == len(GOOD)
    assert prof["tce/extra"].in_schema is False
    assert prof["tce/wrap/baselineCD4"].in_schema is False
    assert prof["tce/followupRNA"].n_nodes == 2
    assert prof["tce/baselineRNA/vLoadMatch"].in_schema is True
    listing = [r.path for r in path_listing(profile_paths(raw, "content")).collect()]
    assert listing == sorted(listing) and "tce" not in listing and "extra" in listing


def test_sample_matches_golden_path_shape(spark, case_dir):
    raw = raw_files(spark, case_dir).filter(F.col("xml_filename") == "1.xml")
    paths = {r.path for r in profile_paths(raw, "content").collect()}
    assert "tce/baselineIsolate/aaMutation/mixtures" in paths
    assert "tce/baselineNewTreatment/drug/drugClass" in paths
    assert all(p.startswith("tce") for p in paths)
