"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus the DuckDB oracle for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tcelake.plans import reports
from tcelake.plans.models import Models
from tcelake.plans.oracle import with_ctes
from tcelake.sources.driver_tables import driver_sources

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def models(spark: SparkSession, sf_dir: str) -> Models:
    return Models(driver_sources(spark, sf_dir))


# ---- star schema ------------------------------------------------------------------------------------------------------
@register("regimen_dim", with_ctes("SELECT * FROM dim_regimen", "dim_regimen"))
def regimen_dim(spark, sf_dir):
    return models(spark, sf_dir).dim_regimen()


@register("time_dim", with_ctes("SELECT * FROM dim_time", "dim_time"))
def time_dim(spark, sf_dir):
    return models(spark, sf_dir).dim_time()


@register("relative_time_dim", with_ctes("SELECT * FROM dim_relative_time", "dim_relative_time"))
def relative_time_dim(spark, sf_dir):
    return models(spark, sf_dir).dim_relative_time()


@register("case_fact", with_ctes("FROM fact", "fact"))
def case_fact(spark, sf_dir):
    return models(spark, sf_dir).fact_tce()


@register("case_dashboard", with_ctes(
    "SELECT * EXCLUDE peers FROM dashboard WHERE peers >= 10 AND baseline_year IS NOT NULL", "dashboard"))
def case_dashboard(spark, sf_dir):
    return models(spark, sf_dir).dashboard()


@register("case_dashboard_all", with_ctes(
    "SELECT * EXCLUDE peers FROM dashboard WHERE baseline_year IS NOT NULL", "dashboard"))
def case_dashboard_all(spark, sf_dir):
    return models(spark, sf_dir).dashboard_unfiltered()


@register("cases_by_year", with_ctes("SELECT * FROM by_year", "by_year"))
def cases_by_year(spark, sf_dir):
    return models(spark, sf_dir).tce_by_year()


@register("class_counts", with_ctes("SELECT * FROM class_counts", "class_counts"))
def class_counts(spark, sf_dir):
    return models(spark, sf_dir).v_new_regimen_class_counts()


@register("staged_measurements", with_ctes("""
SELECT format('{}.xml', l_orderkey) AS xml_filename, format('P{}', o_custkey) AS patient_alias,
       CAST(rel_month AS INTEGER) AS relative_date, CAST(l_quantity AS DOUBLE) AS value,
       if(l_returnflag = 'R', 'RNA', 'CD4') AS measurement_type,
       if(l_returnflag = 'A', 'count', ['rawLoad', 'logLoad'][l_linenumber % 2 + 1]) AS value_type
FROM lo WHERE l_returnflag <> 'N'""", "lo"))
def staged_measurements(spark, sf_dir):
    return models(spark, sf_dir).stg_measurements()


@register("measure_pivot_full_outer", with_ctes("FROM measures", "measures"))
def measure_pivot_full_outer(spark, sf_dir):
    return models(spark, sf_dir).measure_pivot_full_outer()


@register("measure_pivot_single_pass", with_ctes("FROM measures", "measures"))
def measure_pivot_single_pass(spark, sf_dir):
    return models(spark, sf_dir).measure_pivot()


@register("mutation_counts", with_ctes("FROM mutation_numbers", "mutation_numbers"))
def mutation_counts(spark, sf_dir):
    return models(spark, sf_dir).baseline_mutation_counts()


@register("union_distinct_dates", with_ctes("FROM file_dates", "file_dates"))
def union_distinct_dates(spark, sf_dir):
    return models(spark, sf_dir).relative_dates(distinct=True)


# ---- reports ----------------------------------------------------------------------------------------------------------
@register("class_share", with_ctes(reports.CLASS_SHARE_SQL.format(threshold=reports.DONUT_THRESHOLD), "class_counts"))
def class_share(spark, sf_dir):
    return reports.class_share(models(spark, sf_dir).v_new_regimen_class_counts(), reports.DONUT_THRESHOLD)


@register("signature_share", with_ctes(reports.SIGNATURE_SHARE_SQL.format(threshold=reports.SIGNATURE_THRESHOLD),
                                       "dim_regimen"))
def signature_share(spark, sf_dir):
    m = models(spark, sf_dir)
    counts = (m.regimen_aggregate("new").groupBy("regimen_signature")
                .agg(F.count(F.lit(1)).cast("long").alias("tce_count"))
                .withColumnRenamed("regimen_signature", "class_signature"))
    return reports.class_share(counts, reports.SIGNATURE_THRESHOLD)


@register("year_trend", with_ctes("SELECT CAST(baseline_year AS INTEGER) AS baseline_year, tce_count FROM by_year "
                                  "ORDER BY baseline_year", "by_year"))
def year_trend(spark, sf_dir):
    return reports.year_trend(models(spark, sf_dir).tce_by_year())


# ---- XML round trip: mapped rows -> case documents (to_xml) -> parse -> shred ----------------------------
def _xml_files(spark, sf_dir) -> DataFrame:
    """The case files of the driver directory (generated from the tables once, then read like input files)."""
    from tcelake.sources.driver_docs import driver_corpus
    return driver_corpus(spark, sf_dir)


def _xml_docs(spark, sf_dir, elements=None) -> DataFrame:
    from tcelake.sources.xml_docs import parse_documents
    docs, _ = parse_documents(_xml_files(spark, sf_dir), "xml_filename", "content", elements)
    return docs


def _shredded(name: str) -> QueryFn:
    def q(spark, sf_dir):
        from tcelake.operators.shred import SHREDDERS
        shred, elements = SHREDDERS[name]
        return shred(_xml_docs(spark, sf_dir, elements))
    return q


for _q, _t in (("xml_case", "tce_case"), ("xml_measurements", "tce_measurements"), ("xml_isolates", "tce_isolates"),
               ("xml_mutations", "tce_mutations"), ("xml_treatments", "tce_treatments")):
    register(_q, with_ctes(f"SELECT * FROM {_t}", _t))(_shredded(_t))


def damaged_documents(docs: DataFrame) -> DataFrame:
    """Case files of which every 53rd is truncated mid-way, every 59th is followed by a second root element, every 61st ends
    with half a UTF-16 character after a UTF-16 byte-order mark and every 67th uses a prefix that it does not declare.
    All files are still parsed; the damaged ones must land in the quarantine."""
    key = F.regexp_extract(F.col("xml_filename"), r"^(\d+)", 1).cast("long")
    x = F.col("content")
    damaged = (F.when(key % 53 == 0, F.substring(x, 1, (F.octet_length(x) / 2).cast("int")))
                .when(key % 61 == 0, F.concat(F.unhex(F.lit("FEFF")), F.encode(F.lit("<tce/>"), "UTF-16BE"), F.unhex(F.lit("D8"))))
                .when(key % 67 == 0, F.encode(F.lit("<tce><a:b>1</a:b></tce>"), "UTF-8"))
                .when(key % 59 == 0, F.encode(F.lit("<tce/><tce><baselineYear>0</baselineYear></tce>"), "UTF-8"))
                .otherwise(x))
    return docs.select("xml_filename", damaged.alias("content"))


_KEY = "CAST(regexp_extract(xml_filename, '^(\\d+)', 1) AS BIGINT)"


@register("xml_quarantine", with_ctes(f"""
SELECT xml_filename, CASE WHEN {_KEY} % 53 = 0 OR {_KEY} % 61 = 0 OR {_KEY} % 67 = 0 THEN 'malformed' ELSE 'trailing content' END AS reason
FROM tce_case WHERE {_KEY} % 53 = 0 OR {_KEY} % 59 = 0 OR {_KEY} % 61 = 0 OR {_KEY} % 67 = 0""", "tce_case"))
def xml_quarantine(spark, sf_dir):
    from tcelake.sources.xml_docs import parse_documents
    _, bad = parse_documents(damaged_documents(_xml_files(spark, sf_dir)), "xml_filename", "content", ())
    return bad.select("xml_filename", "reason")


@register("xml_accepted_cases", with_ctes(f"""
SELECT * FROM tce_case WHERE {_KEY} % 53 <> 0 AND {_KEY} % 59 <> 0 AND {_KEY} % 61 <> 0 AND {_KEY} % 67 <> 0""", "tce_case"))
def xml_accepted_cases(spark, sf_dir):
    from tcelake.operators.shred import SHREDDERS
    from tcelake.sources.xml_docs import parse_documents
    shred, elements = SHREDDERS["tce_case"]
    docs, _ = parse_documents(damaged_documents(_xml_files(spark, sf_dir)), "xml_filename", "content", elements)
    return shred(docs)


@register("xml_folder", with_ctes(f"""
SELECT xml_filename, patient_alias, baseline_year, cd4_nadir_before_tce, date_unit, schema_version, NULL AS reason
FROM tce_case WHERE {_KEY} % 53 <> 0 AND {_KEY} % 59 <> 0 AND {_KEY} % 61 <> 0 AND {_KEY} % 67 <> 0 AND {_KEY} % 71 <> 0
UNION ALL
SELECT xml_filename, NULL, NULL, NULL, NULL, NULL,
    CASE WHEN {_KEY} % 71 <> 0 AND {_KEY} % 53 <> 0 AND {_KEY} % 61 <> 0 AND {_KEY} % 67 <> 0 THEN 'trailing content' ELSE 'malformed' END
FROM tce_case WHERE {_KEY} % 53 = 0 OR {_KEY} % 59 = 0 OR {_KEY} % 61 = 0 OR {_KEY} % 67 = 0 OR {_KEY} % 71 = 0""", "tce_case"))
def xml_folder(spark, sf_dir):
    """Case files as files of one folder, written by the executors, every 71st of them empty: listed and read inside tasks, cases and
    quarantine together, so that every file is one row."""
    from tcelake.operators.shred import SHREDDERS
    from tcelake.session import scratch_dir
    from tcelake.sources.folder import case_files, write_files
    from tcelake.sources.xml_docs import parsed_documents, split_parsed
    key = F.regexp_extract(F.col("xml_filename"), r"^(\d+)", 1).cast("long")
    files = damaged_documents(_xml_files(spark, sf_dir)).withColumn("content", F.when(key % 71 == 0, F.lit(b"")).otherwise(F.col("content")))
    folder = scratch_dir(spark, "folder")
    write_files(files, folder)
    shred, elements = SHREDDERS["tce_case"]
    docs, bad = split_parsed(parsed_documents(case_files(spark, folder), "xml_filename", "content", elements))
    return shred(docs).withColumn("reason", F.lit(None).cast("string")).unionByName(bad.select("xml_filename", "reason"), allowMissingColumns=True)


#: Element names of the documented shape are fixed values; files vary as ``driver_docs.varied_documents`` says.
XML_PATHS_SQL = f"""
WITH tt AS (
  SELECT *, CASE WHEN treatment_type = 'new' THEN 'tce/baselineNewTreatment' ELSE 'tce/pastRegimenTreatments' END
         AS tag FROM tce_treatments
), nodes AS (
  SELECT 'tce' AS path, xml_filename FROM tce_case
  UNION ALL SELECT 'tce/patient', xml_filename FROM tce_case
  UNION ALL SELECT 'tce/patient/patientAlias', xml_filename FROM tce_case WHERE patient_alias IS NOT NULL
  UNION ALL SELECT 'tce/patient/CD4NadirBeforeTCE', xml_filename FROM tce_case WHERE cd4_nadir_before_tce IS NOT NULL
  UNION ALL SELECT 'tce/baselineYear', xml_filename FROM tce_case WHERE baseline_year IS NOT NULL
  UNION ALL SELECT 'tce/dateUnit', xml_filename FROM tce_case WHERE date_unit IS NOT NULL
  UNION ALL SELECT 'tce/schemaVersion', xml_filename FROM tce_case WHERE schema_version IS NOT NULL
  UNION ALL SELECT 'tce/' || timepoint_tag, xml_filename FROM tce_measurements
  UNION ALL SELECT 'tce/' || timepoint_tag || '/' || value_type, xml_filename FROM tce_measurements
  UNION ALL SELECT 'tce/' || timepoint_tag || '/relativeDate', xml_filename FROM tce_measurements
            WHERE relative_date IS NOT NULL
  UNION ALL SELECT 'tce/' || isolate_type || 'Isolate', xml_filename FROM tce_isolates
  UNION ALL SELECT 'tce/' || isolate_type || 'Isolate/gene', xml_filename FROM tce_isolates WHERE gene IS NOT NULL
  UNION ALL SELECT 'tce/' || isolate_type || 'Isolate/subtype', xml_filename FROM tce_isolates WHERE subtype IS NOT NULL
  UNION ALL SELECT 'tce/' || isolate_type || 'Isolate/relativeDate', xml_filename FROM tce_isolates
            WHERE relative_date IS NOT NULL
  UNION ALL SELECT 'tce/' || isolate_type || 'Isolate/aaStart', xml_filename FROM tce_isolates WHERE aa_start IS NOT NULL
  UNION ALL SELECT 'tce/' || isolate_type || 'Isolate/aaStop', xml_filename FROM tce_isolates WHERE aa_stop IS NOT NULL
  UNION ALL SELECT 'tce/' || isolate_type || 'Isolate/aaSequence', xml_filename FROM tce_isolates
            WHERE aa_sequence IS NOT NULL
  UNION ALL SELECT 'tce/' || isolate_type || 'Isolate/nucleotideSequence', xml_filename FROM tce_isolates
            WHERE nucleotide_sequence IS NOT NULL
  UNION ALL SELECT 'tce/' || isolate_type || 'Isolate/aaMutation', xml_filename FROM tce_mutations
  UNION ALL SELECT 'tce/' || isolate_type || 'Isolate/aaMutation/position', xml_filename FROM tce_mutations
            WHERE position IS NOT NULL
  UNION ALL SELECT 'tce/' || isolate_type || 'Isolate/aaMutation/aminoAcid', xml_filename FROM tce_mutations
            WHERE amino_acid IS NOT NULL
  UNION ALL SELECT 'tce/' || isolate_type || 'Isolate/aaMutation/mixtures', xml_filename FROM tce_mutations
            WHERE mixtures IS NOT NULL
  UNION ALL SELECT t.tag, xml_filename FROM tt t
  UNION ALL SELECT t.tag || '/relativeStartDate', xml_filename FROM tt t WHERE relative_start_date IS NOT NULL
  UNION ALL SELECT t.tag || '/relativeStopDate', xml_filename FROM tt t WHERE relative_stop_date IS NOT NULL
  UNION ALL SELECT t.tag || '/duration', xml_filename FROM tt t WHERE duration IS NOT NULL
  UNION ALL SELECT t.tag || '/drug', xml_filename FROM tt t
  UNION ALL SELECT t.tag || '/drug/drugCode', xml_filename FROM tt t WHERE drug_code IS NOT NULL
  UNION ALL SELECT t.tag || '/drug/drugClass', xml_filename FROM tt t WHERE drug_class IS NOT NULL
  UNION ALL SELECT 'tce/schemaVersion', xml_filename FROM tce_case WHERE {_KEY} % 19 = 0 AND schema_version IS NOT NULL
  UNION ALL SELECT 'tce/' || timepoint_tag || '/vLoadMatch', xml_filename FROM tce_measurements
            WHERE measurement_type = 'RNA' AND {_KEY} % 23 = 0
  UNION ALL SELECT 'tce/' || timepoint_tag || '/logLoad', xml_filename FROM tce_measurements
            WHERE measurement_type = 'RNA' AND {_KEY} % 29 = 0
), placed AS (
  SELECT path, xml_filename, {_KEY} % 7 = 0 AND path <> 'tce' AND NOT regexp_matches(path, '^tce/(patient|baselineYear|dateUnit|schemaVersion)') AS below
  FROM nodes
), seen AS (
  SELECT CASE WHEN below THEN 'tce/visit/part' || substr(path, 4) ELSE path END AS path, xml_filename, NOT below AS known FROM placed
  UNION ALL SELECT unnest(['tce/visit', 'tce/visit/part']), xml_filename, false FROM (SELECT DISTINCT xml_filename FROM placed WHERE below)
  UNION ALL SELECT 'tce/note', xml_filename, false FROM tce_case WHERE {_KEY} % 11 = 0
  UNION ALL SELECT 'tce/place', xml_filename, false FROM tce_case WHERE {_KEY} % 13 < 3
  UNION ALL SELECT unnest(['tce/BaselineYear', 'tce/{{urn:other}}dateUnit', 'tce/BASELINECD4', 'tce/BASELINECD4/count', 'tce/{{urn:other}}pastRNA',
                           'tce/{{urn:other}}pastRNA/logLoad']), xml_filename, false FROM tce_case WHERE {_KEY} % 17 = 0
  UNION ALL SELECT 'tce/schemaVersion/b', xml_filename, false FROM tce_case WHERE {_KEY} % 19 = 0 AND schema_version IS NOT NULL
)
SELECT path, count(DISTINCT xml_filename) AS n_docs, count(*) AS n_nodes, bool_and(known) AS in_schema
FROM seen GROUP BY path"""


def _nest_with(sql: str, *names: str) -> str:
    """Put the mapping CTEs in front of a statement that starts with its own WITH."""
    head = with_ctes("SELECT 1", *names)
    prefix = head[: head.rindex("SELECT 1")].rstrip()
    return prefix + ",\n" + sql.strip()[len("WITH "):]


@register("xml_paths", _nest_with(XML_PATHS_SQL, "tce_case", "tce_measurements", "tce_isolates", "tce_mutations",
                                  "tce_treatments"))
def xml_paths(spark, sf_dir):
    from tcelake.operators.profile import profile_paths
    return profile_paths(_xml_files(spark, sf_dir), "content")


# ---- sinks and catalog ------------------------------------------------------------------------------------------------
@register("partitioned_roundtrip", with_ctes("""
SELECT xml_filename, patient_alias, relative_date, timepoint_tag, timepoint_type, value, value_type, measurement_type
FROM tce_measurements WHERE measurement_type = 'RNA'""", "tce_measurements"))
def partitioned_roundtrip(spark, sf_dir):
    """Write measurements partitioned by type, register the table, read one partition back (partition pruning)."""
    from tcelake.session import scratch_dir
    from tcelake.sinks.catalog import register_tables
    from tcelake.sinks.datasets import write_dataset
    uri = write_dataset(driver_sources(spark, sf_dir)["tce_measurements"], scratch_dir(spark, "measurements"),
                        partition_by=["measurement_type"])
    db = "tcelake_check"
    name = "tce_measurements_" + uri.rstrip("/").rsplit("-", 1)[-1]
    register_tables(spark, db, {name: uri}, partitions={name: ["measurement_type"]})
    return spark.table(f"{db}.{name}").filter(F.col("measurement_type") == "RNA")


# ---- reruns and publication ------------------------------------------------------------------------------------------
_CHANGED = "<tce><patient><patientAlias>changed</patientAlias></patient><baselineYear>2001</baselineYear></tce>"


@register("batch_rerun", with_ctes(f"""
SELECT xml_filename,
       if({_KEY} % 10 = 3, 'changed', patient_alias) AS patient_alias, if({_KEY} % 10 = 3, '2001', baseline_year) AS baseline_year,
       if({_KEY} % 10 = 3, NULL, cd4_nadir_before_tce) AS cd4_nadir_before_tce, if({_KEY} % 10 = 3, NULL, date_unit) AS date_unit,
       if({_KEY} % 10 = 3, NULL, schema_version) AS schema_version,
       CAST(if({_KEY} % 10 IN (3, 5), 2, 1) AS BIGINT) AS parsed_run,
       if({_KEY} % 10 = 3, 0, coalesce(n, 0)) AS n_treatments
FROM tce_case LEFT JOIN (SELECT xml_filename, count(*) AS n FROM tce_treatments GROUP BY xml_filename) t USING (xml_filename)
WHERE {_KEY} % 10 <> 7""", "tce_case", "tce_treatments"))
def batch_rerun(spark, sf_dir):
    """Two runs over one folder: between them a tenth of the files is changed, a tenth is removed and a tenth is new. The cases after the
    second run, the run that parsed each, and the number of its treatments."""
    from tcelake.plans.rerun import rerun
    from tcelake.session import scratch_dir
    from tcelake.sinks.datasets import read_dataset
    from tcelake.sources.folder import remove_files, write_files
    files, key = _xml_files(spark, sf_dir), F.regexp_extract(F.col("xml_filename"), r"^(\d+)", 1).cast("long")
    folder, out = scratch_dir(spark, "rerun-files"), scratch_dir(spark, "rerun")
    write_files(files.filter(key % 10 != 5), folder)
    rerun(spark, folder, out, reports=())
    write_files(files.filter(key % 10 == 5), folder)
    write_files(files.filter(key % 10 == 3).withColumn("content", F.encode(F.lit(_CHANGED), "UTF-8")), folder)
    remove_files(files.filter(key % 10 == 7), folder)
    uris = rerun(spark, folder, out, reports=()).uris
    parsed = read_dataset(spark, uris["inventory"]).select("xml_filename", "parsed_run")
    n = read_dataset(spark, uris["tce_treatments"]).groupBy("xml_filename").agg(F.count(F.lit(1)).alias("n_treatments"))
    return read_dataset(spark, uris["tce_case"]).join(parsed, "xml_filename").join(n, "xml_filename", "left").fillna(0, ["n_treatments"])


@register("batch_job", with_ctes(reports.CLASS_SHARE_SQL.format(threshold=reports.DONUT_THRESHOLD), "class_counts"))
def batch_job(spark, sf_dir):
    """The job from a folder of case files to a report: files listed, parsed, shredded and written, reports built and published, one read back."""
    from tcelake.plans.rerun import rerun
    from tcelake.session import scratch_dir
    from tcelake.sources.folder import write_files
    folder, out = scratch_dir(spark, "job-files"), scratch_dir(spark, "job")
    write_files(_xml_files(spark, sf_dir), folder)
    db = "tcelake_job_" + out.rsplit("-", 1)[-1]
    rerun(spark, folder, out, db=db, reports=("v_new_regimen_class_counts", "class_share"))
    return spark.table(f"{db}.class_share").orderBy("ordinal")


@register("catalog_update", with_ctes("""
SELECT moment, measurement_type, count(*) AS n, count(DISTINCT value) AS n_values
FROM (SELECT 1 AS moment, measurement_type, value FROM tce_measurements WHERE timepoint_type <> 'followup'
      UNION ALL SELECT 2, measurement_type, value FROM tce_measurements WHERE timepoint_type <> 'followup'
      UNION ALL SELECT 3, measurement_type, value FROM tce_measurements WHERE measurement_type = 'RNA') seen
GROUP BY moment, measurement_type""", "tce_measurements"))
def catalog_update(spark, sf_dir):
    """A published table as readers see it: its first version, the same after an update that failed, and a second version with fewer
    partitions and another column order."""
    from tcelake.session import scratch_dir
    from tcelake.sinks.datasets import write_dataset
    from tcelake.sinks.publication import publish_versions
    m = driver_sources(spark, sf_dir)["tce_measurements"]
    by = {"partition_by": ["measurement_type"]}
    first = write_dataset(m.filter("timepoint_type <> 'followup'"), scratch_dir(spark, "published"), **by)
    second = write_dataset(m.filter("measurement_type = 'RNA'").select(*reversed(m.columns)), scratch_dir(spark, "published"), **by)
    db, parts = "tcelake_published_" + first.rsplit("-", 1)[-1], {"measurements": ["measurement_type"]}

    def seen(moment: int) -> DataFrame:
        return (spark.table(f"{db}.measurements").groupBy("measurement_type")
                     .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("value").alias("n_values")).withColumn("moment", F.lit(moment)))

    publish_versions(spark, db, {"measurements": first}, parts)
    frames = [seen(1)]
    try:
        publish_versions(spark, db, {"measurements": second, "isolates": f"{second}-missing"}, parts)
    except RuntimeError:
        frames.append(seen(2))
    publish_versions(spark, db, {"measurements": second}, parts)
    frames.append(seen(3))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("cached_report", """
WITH moments AS (SELECT unnest([1, 2, 3]) AS moment)
SELECT moment, moment = 2 AS hit, p_brand AS brand, count(*) AS n, sum(p_size) AS total_size
FROM part JOIN moments ON moment = 3 OR p_partkey % 4 <> 0 GROUP BY moment, p_brand""")
def cached_report(spark, sf_dir):
    """A report asked for three times, the third time after a quarter of the parts was added to its input."""
    from tcelake.plans.result_cache import ResultCache
    from tcelake.session import scratch_dir
    from tcelake.sources.driver_tables import read_driver
    part, uri, cache = read_driver(spark, sf_dir, "part"), scratch_dir(spark, "parts"), ResultCache(spark, scratch_dir(spark, "results"))

    def report(moment: int) -> DataFrame:
        df = (spark.read.parquet(uri).groupBy(F.col("p_brand").alias("brand"))
                   .agg(F.count(F.lit(1)).alias("n"), F.sum("p_size").alias("total_size")))
        got = cache.get(df)
        return got.frame.withColumn("moment", F.lit(moment)).withColumn("hit", F.lit(got.hit))

    part.filter("p_partkey % 4 <> 0").write.parquet(uri)
    out = report(1).unionByName(report(2))
    part.filter("p_partkey % 4 = 0").write.mode("append").parquet(uri)
    return out.unionByName(report(3))


# ---- JSON / CSV side jobs ---------------------------------------------------------------------------------------------
_PRODUCTS_CTE = """
WITH products AS (
  SELECT CASE WHEN p_size % 10 = 0 THEN 'N/A' WHEN p_size % 10 = 5 THEN NULL ELSE p_brand END AS brand,
         p_retailprice AS price
  FROM part)"""


def _products_uri(spark, sf_dir) -> str:
    from tcelake.plans.side_jobs import write_product_documents
    from tcelake.session import scratch_dir
    from tcelake.sources.driver_tables import read_driver
    return write_product_documents(read_driver(spark, sf_dir, "part"), scratch_dir(spark, "products"))


@register("json_default_projection", _PRODUCTS_CTE + "\nSELECT brand, price FROM products")
def json_default_projection(spark, sf_dir):
    from tcelake.plans.side_jobs import projected_products
    p = projected_products(spark, _products_uri(spark, sf_dir))
    return p.select("brand", F.col("price").cast("double").alias("price"))


@register("json_brand_price", _PRODUCTS_CTE + """
SELECT brand, round(avg(price), 2) AS avg_price FROM products GROUP BY brand ORDER BY avg_price DESC NULLS LAST""")
def json_brand_price(spark, sf_dir):
    """Product documents -> cleaned records (JSON lines) -> inferred read -> round(avg(price), 2) by brand."""
    from tcelake.plans.side_jobs import brand_price, cleaned_products_roundtrip
    from tcelake.session import scratch_dir
    cleaned = cleaned_products_roundtrip(spark, _products_uri(spark, sf_dir), scratch_dir(spark, "products-clean"))
    return brand_price(cleaned)


@register("json_array_split", """
SELECT if(p_partkey % 97 = 0, NULL, p_partkey) AS id,
       CASE WHEN p_partkey % 97 = 0 OR p_size % 10 = 5 THEN NULL WHEN p_size % 10 = 0 THEN 'N/A' ELSE p_brand END AS brand,
       if(p_partkey % 97 = 0, NULL, p_retailprice) AS price,
       if(p_partkey % 97 = 0, format('{{"id":{},"brand":tru}}', p_partkey), NULL) AS text,
       if(p_partkey % 97 = 0, 'malformed', NULL) AS reason
FROM part""")
def json_array_split(spark, sf_dir):
    """Product files of one large array each, read in blocks far smaller than a file; every 97th record is damaged and comes back as text."""
    from tcelake.plans.side_jobs import product_documents
    from tcelake.session import scratch_dir
    from tcelake.sources.driver_tables import read_driver
    from tcelake.sources.folder import write_files
    from tcelake.sources.json_arrays import json_array_records
    docs = product_documents(read_driver(spark, sf_dir, "part"), per_doc=5000, damaged_every=97)
    folder = scratch_dir(spark, "product-files")
    write_files(docs.select(F.format_string("%d.json", "doc_id").alias("xml_filename"), F.encode("doc", "UTF-8").alias("content")), folder)
    r = json_array_records(spark, folder, "products", block_bytes=1 << 16)
    m = F.col("record")
    return r.select(m["id"].cast("long").alias("id"),
                    F.when(m.isNotNull() & ~F.map_contains_key(m, F.lit("brand")), F.lit("N/A")).otherwise(m["brand"]).alias("brand"),
                    m["price"].cast("double").alias("price"), "text", "reason")


_FEATURES_SQL = """
SELECT CAST(p_partkey + 1 AS INTEGER) AS id, p_name AS name,
       'Part of type ' || p_type || ' in size ' || CAST(p_size AS VARCHAR) AS description,
       '0.' || CAST(p_size AS VARCHAR) AS release_version,
       CASE WHEN p_size % 2 = 0 THEN 'Enterprise' ELSE 'Open-Source' END AS edition
FROM part ORDER BY release_version, id"""


@register("feature_sort", _FEATURES_SQL)
def feature_sort(spark, sf_dir):
    from tcelake.plans.side_jobs import feature_rows
    from tcelake.sources.driver_tables import read_driver
    return feature_rows(read_driver(spark, sf_dir, "part")).orderBy("release_version", "id")


@register("csv_roundtrip", _FEATURES_SQL)
def csv_roundtrip(spark, sf_dir):
    from tcelake.plans.side_jobs import feature_csv_roundtrip
    from tcelake.session import scratch_dir
    from tcelake.sources.driver_tables import read_driver
    return feature_csv_roundtrip(spark, read_driver(spark, sf_dir, "part"), scratch_dir(spark, "features-csv"))


@register("feature_refill", _FEATURES_SQL.replace("FROM part ORDER BY", "FROM part WHERE p_partkey % 5 <> 0 ORDER BY"))
def feature_refill(spark, sf_dir):
    """The feature table created where it is absent and filled, then emptied and refilled with other rows."""
    from tcelake.plans.side_jobs import feature_rows
    from tcelake.session import scratch_dir
    from tcelake.sinks.catalog import refill_table
    from tcelake.sources.driver_tables import read_driver
    part, uri = read_driver(spark, sf_dir, "part"), scratch_dir(spark, "features")
    db = "tcelake_features_" + uri.rsplit("-", 1)[-1]
    for rows in (part, part.filter("p_partkey % 5 <> 0")):
        df = feature_rows(rows)
        table = refill_table(df, db, "features", uri, not_null=df.columns)
    return spark.table(table).orderBy("release_version", "id")


# ---- archives ---------------------------------------------------------------------------------------------------------
ARCHIVE_DOCS = 500   # case files per archive (archive id = order key range, so a group is bounded by construction)


@register("archive_scan", with_ctes("SELECT * FROM tce_case", "tce_case"))
def archive_scan(spark, sf_dir):
    """Case documents packed into gzip tars (by key range), expanded again, parsed and shredded."""
    from tcelake.operators.shred import SHREDDERS
    from tcelake.sources.archive import expand_archives, pack_archives
    from tcelake.sources.xml_docs import parse_documents
    key = F.regexp_extract(F.col("xml_filename"), r"^(\d+)", 1).cast("long")
    members = _xml_files(spark, sf_dir).withColumn("archive_id", (key / ARCHIVE_DOCS).cast("long"))
    archives = pack_archives(members, "archive_id", "xml_filename", "content")
    shred, elements = SHREDDERS["tce_case"]
    docs, _ = parse_documents(expand_archives(archives, "*.xml"), "member", "content", elements)
    return shred(docs)


# ---- end to end: case documents -> shred -> models -------------------------------------------------------------------
def _xml_models(spark, sf_dir) -> Models:
    from tcelake.operators.shred import shred_all
    from tcelake.sources.xml_docs import parse_once
    return Models(shred_all(parse_once(_xml_docs(spark, sf_dir))))


@register("xml_class_counts", with_ctes("SELECT * FROM class_counts", "class_counts"))
def xml_class_counts(spark, sf_dir):
    """Class counts straight from the case files: one parse, flags per document, one group-by (no join)."""
    from tcelake.functions.scalar import CLASS_FLAGS, class_label_signature
    from tcelake.operators.aggregate import count_by
    from tcelake.operators.shred import new_regimen_class_flags
    flags = new_regimen_class_flags(_xml_docs(spark, sf_dir, ("baselineNewTreatment",)), CLASS_FLAGS)
    return count_by(flags.select(class_label_signature().alias("class_signature")), ["class_signature"], "tce_count")


@register("xml_case_fact", with_ctes("FROM fact", "fact"))
def xml_case_fact(spark, sf_dir):
    return _xml_models(spark, sf_dir).fact_tce()


@register("record_listing", """
SELECT 'user_' || CAST(user_id AS VARCHAR) AS name,
       string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS types,
       'Name: user_' || CAST(user_id AS VARCHAR) || chr(10) || 'Types: '
         || string_agg(DISTINCT event_type, ', ' ORDER BY event_type) AS text
FROM events GROUP BY user_id""")
def record_listing(spark, sf_dir):
    from tcelake.plans.side_jobs import record_listing as listing, user_type_documents
    from tcelake.sources.driver_tables import read_driver
    return listing(user_type_documents(read_driver(spark, sf_dir, "events")))


# ---- published views and the path listing ------------------------------------------------------------------------------
@register("view_class_counts", with_ctes("SELECT * FROM class_counts ORDER BY tce_count DESC", "class_counts"))
def view_class_counts(spark, sf_dir):
    """Models published as views (temp views, like the reference's view materialisation), read back with SQL."""
    from tcelake.plans.models import publish
    publish(models(spark, sf_dir), names=("v_new_regimen_class_counts",))
    return spark.sql("SELECT * FROM v_new_regimen_class_counts ORDER BY tce_count DESC")


@register("xml_path_listing", _nest_with(XML_PATHS_SQL.replace(
    "SELECT path, count(DISTINCT xml_filename) AS n_docs, count(*) AS n_nodes, bool_and(known) AS in_schema\nFROM seen GROUP BY path",
    "SELECT DISTINCT regexp_replace(path, '^tce/', '') AS path FROM seen WHERE path <> 'tce' ORDER BY path"),
    "tce_case", "tce_measurements", "tce_isolates", "tce_mutations", "tce_treatments"))
def xml_path_listing(spark, sf_dir):
    from tcelake.operators.profile import path_listing, profile_paths
    return path_listing(profile_paths(_xml_files(spark, sf_dir), "content"))
