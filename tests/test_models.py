"""Models M1-M11 on small source tables; plan assertions (no single-partition exchange, partition pruning)."""

from pyspark.sql import functions as F

from tcelake.operators.shred import shred_all
from tcelake.plans.models import Models
from tcelake.plans.reports import class_share, year_trend
from tcelake.schema import SOURCE_SCHEMAS
from tcelake.sources.xml_docs import xml_documents


def _tables(spark, **rows):
    return {name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in SOURCE_SCHEMAS.items()}


def test_sample_document_models(spark, case_dir):
    docs, _ = xml_documents(spark, case_dir)
    m = Models(shred_all(docs.filter(F.col("xml_filename") == "1.xml")))
    reg = {r.treatment_type: r for r in m.dim_regimen().collect()}
    assert reg["new"].regimen_signature == "BBB+CCC" and reg["new"].drug_count == 2
    assert (reg["new"].contains_nrti, reg["new"].contains_pi, reg["new"].contains_nnrti) == (1, 1, 0)
    assert sorted(r.regimen_key for r in reg.values()) == [1, 2]
    fact = m.fact_tce().first()
    assert fact.followup_log_rna == 3.0 and fact.baseline_cd4 == 200.0 and fact.followup_cd4 is None
    assert fact.baseline_log_rna == 4.5 and fact.baseline_mutation_count == 2 and fact.tce_id == 1
    assert fact.new_regimen_key == reg["new"].regimen_key and fact.past_regimen_key == reg["past"].regimen_key
    t = m.dim_time().first()
    assert (t.baseline_year, t.decade, t.year_bucket, t.time_key) == (1999, "1990s", "<2000", 1)
    assert [tuple(r) for r in m.v_new_regimen_class_counts().collect()] == [("NRTI+PI", 1)]
    rel = {r.relative_date: r for r in m.dim_relative_time().collect()}
    assert rel["-60"].timepoint_bucket == "far_pre" and rel["0"].is_baseline is True


def test_fact_has_one_row_per_case_and_dense_keys(spark, monkeypatch):
    from tcelake.operators import rank
    monkeypatch.setattr(rank, "LEAF", 8)                       # as on a corpus of many leaves
    case = [(f"{i}.xml", "P", str(1990 + i % 3) if i % 4 else None, "100", "months" if i % 2 else None, "1")
            for i in range(40)]
    treat = [(f"{i}.xml", "P", "0", "1", "1", f"D{i % 3}", "PI", "new") for i in range(40)] + \
            [(f"{i}.xml", "P", "0", "1", "1", "D9", "NRTI", "past") for i in range(0, 40, 2)] + \
            [("orphan.xml", "P", "0", "1", "1", "D1", "FI", "new")]
    meas = [(f"{i}.xml", "P", "0", "RNA", "baselineRNA", "baseline", str(i), "logLoad") for i in range(0, 40, 3)]
    m = Models(_tables(spark, tce_case=case, tce_treatments=treat, tce_measurements=meas))
    fact = m.fact_tce()
    assert fact.count() == 40 and fact.select("xml_filename").distinct().count() == 40
    ids = fact.agg(F.min("tce_id"), F.max("tce_id"), F.count_distinct("tce_id")).first()
    assert tuple(ids) == (1, 40, 40)
    keys = m.dim_regimen().agg(F.min("regimen_key"), F.max("regimen_key"), F.count("*")).first()
    assert tuple(keys) == (1, 61, 61)
    # yearly counts from the case table equal the fact x dim_time join (R6)
    direct = {r.baseline_year: r.tce_count for r in m.tce_by_year().collect()}
    via_fact = {r.baseline_year: r.n for r in fact.join(m.dim_time(), "time_key").groupBy(m.dim_time().baseline_year)
                .agg(F.count("*").alias("n")).collect()}
    assert direct == via_fact
    # class counts from the case table equal fact x new regimen (orphan regimen not counted)
    assert sum(r.tce_count for r in m.v_new_regimen_class_counts().collect()) == 40
    plan = fact._jdf.queryExecution().executedPlan().toString() + \
        m.dim_regimen()._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    # counts of branches and the one leaf of distinct years, never case or treatment rows
    assert single and all("keys=[branch#" in lines[i + 1] or "keys=[baseline_year#" in lines[i + 1] for i in single)
    assert "rangepartitioning" not in plan


def test_dashboard_popularity_counts_null_year_cases(spark):
    # signature S: 10 cases, one with NULL year -> kept (9 rows shown); signature T: 9 cases -> dropped (A7, T10)
    case = [(f"s{i}.xml", "P", None if i == 0 else "2001", "1", "weeks", "1") for i in range(10)] + \
           [(f"t{i}.xml", "P", "2001", "1", "weeks", "1") for i in range(9)]
    treat = [(f"s{i}.xml", "P", "0", "1", "1", "S", "PI", "new") for i in range(10)] + \
            [(f"t{i}.xml", "P", "0", "1", "1", "T", "PI", "new") for i in range(9)]
    m = Models(_tables(spark, tce_case=case, tce_treatments=treat))
    dash = m.dashboard()
    assert dash.count() == 9 and {r.regimen_signature for r in dash.collect()} == {"S"}
    assert m.dashboard_unfiltered().count() == 18
    assert set(dash.columns) == set(m.dashboard_unfiltered().columns) and len(dash.columns) == 18


def test_reports(spark):
    counts = spark.createDataFrame([("NRTI+PI", 10), ("", 6), ("FI", 7)], "class_signature string, tce_count long")
    got = [tuple(r)[:3] for r in class_share(counts, 7).collect()]
    assert got == [("NRTI+PI", 10, 1), ("FI", 7, 2), ("Other", 6, 3)]
    by_year = spark.createDataFrame([(2001, 3), (1999, 5)], "baseline_year int, tce_count long")
    assert [tuple(r) for r in year_trend(by_year).collect()] == [(1999, 5), (2001, 3)]


def test_staged_measurements_casts(spark):
    meas = [("1.xml", "P", "-3", "CD4", "baselineCD4", "baseline", "200", "count")]
    out = Models(_tables(spark, tce_measurements=meas)).stg_measurements()
    assert [tuple(r) for r in out.collect()] == [("1.xml", "P", -3, "CD4", 200.0, "count")]
    assert out.schema["relative_date"].dataType.simpleString() == "int"


def test_hot_file_holding_a_third_of_rows(spark):
    # one case file carries a third of all treatment and measurement rows: results stay exact (no caps, no sampling)
    case = [(f"{i}.xml", "P", "2001", "1", "weeks", "1") for i in range(30)]
    treat = [("0.xml", "P", "0", "1", "1", f"D{i % 7}", ["PI", "NRTI", "FI"][i % 3], "new") for i in range(300)] + \
            [(f"{i}.xml", "P", "0", "1", "1", "D1", "PI", "new") for i in range(1, 30) for _ in range(20)]
    meas = [("0.xml", "P", str(i % 50), "RNA", "baselineRNA", "baseline", str(i), "logLoad") for i in range(400)] + \
           [(f"{i}.xml", "P", "1", "CD4", "baselineCD4", "baseline", "5", "count") for i in range(1, 30)
            for _ in range(27)]
    m = Models(_tables(spark, tce_case=case, tce_treatments=treat, tce_measurements=meas))
    f = {r.xml_filename: r for r in m.fact_tce().collect()}
    assert len(f) == 30 and f["0.xml"].baseline_log_rna == 399.0 and f["5.xml"].baseline_cd4 == 5.0
    reg = {r.xml_filename: r for r in m.dim_regimen().collect()}
    assert reg["0.xml"].drug_count == 7 and reg["0.xml"].regimen_signature == "+".join(f"D{i}" for i in range(7))
    counts = {r.class_signature: r.tce_count for r in m.v_new_regimen_class_counts().collect()}
    assert counts == {"FI+NRTI+PI": 1, "PI": 29}
    rel = m.dim_relative_time()
    assert rel.count() == rel.select("relative_date", "date_unit").distinct().count()


def test_relative_dates_keep_text_members_and_order(spark):
    # T8: '5' and '5.0' are distinct members; keys follow text order with NULL units last; months x4 -> weeks
    case = [("a.xml", "P", "2001", "1", "months", "1"), ("b.xml", "P", "2001", "1", None, "1")]
    meas = [("a.xml", "P", "5", "CD4", "baselineCD4", "baseline", "1", "count"),
            ("b.xml", "P", "5.0", "CD4", "baselineCD4", "baseline", "1", "count"),
            ("b.xml", "P", "5", "CD4", "baselineCD4", "baseline", "1", "count"),
            ("b.xml", "P", None, "CD4", "baselineCD4", "baseline", "1", "count"),
            ("z.xml", "P", "-7", "CD4", "baselineCD4", "baseline", "1", "count")]      # no case: dropped (J8)
    rows = [tuple(r) for r in Models(_tables(spark, tce_case=case, tce_measurements=meas)).dim_relative_time()
            .orderBy("relative_time_key").collect()]
    assert [(r[0], r[1], r[2], r[3]) for r in rows] == [(1, "5", "months", 20.0), (2, "5", None, 5.0),
                                                        (3, "5.0", None, 5.0)]


def test_null_codes_dropped_before_flags(spark):
    # T14: a NULL drug code row does not contribute its class to the flags
    treat = [("a.xml", "P", "0", "1", "1", "AAA", "NRTI", "new"), ("a.xml", "P", "0", "1", "1", None, "PI", "new")]
    r = Models(_tables(spark, tce_treatments=treat)).dim_regimen().first()
    assert (r.contains_nrti, r.contains_pi, r.drug_count, r.regimen_signature) == (1, 0, 1, "AAA")


def test_document_level_class_counts_equal_model_path(spark, case_dir):
    from tcelake.functions.scalar import CLASS_FLAGS, class_label_signature
    from tcelake.operators.aggregate import count_by
    from tcelake.operators.shred import new_regimen_class_flags
    docs, _ = xml_documents(spark, case_dir)
    via_models = {tuple(r) for r in Models(shred_all(docs)).v_new_regimen_class_counts().collect()}
    flags = new_regimen_class_flags(docs, CLASS_FLAGS)
    direct = {tuple(r) for r in count_by(flags.select(class_label_signature().alias("class_signature")),
                                         ["class_signature"], "tce_count").collect()}
    assert direct == via_models and ("", 1) in direct          # unknown class only -> '' group (T6)
