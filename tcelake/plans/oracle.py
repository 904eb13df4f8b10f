"""Independent DuckDB formulations of every registered query, used by the driver's correctness check.

The driver tables are pre-registered views in DuckDB. Each oracle repeats the driver mapping of
``tcelake.sources.driver_tables`` as CTEs; the models are stated from the data model: lists of drugs per regimen, filtered
aggregates over measurements, the fact as one grouping of all facets of a file, popularity as a window count.
"""

from __future__ import annotations

# --- driver mapping (mirror of tcelake/sources/driver_tables.py) ----------------------------------------------------
MAP_CTES = {
    "tce_case": """
SELECT CAST(o_orderkey AS VARCHAR) || '.xml' AS xml_filename,
       'P' || CAST(o_custkey AS VARCHAR) AS patient_alias,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS VARCHAR) END AS baseline_year,
       CAST(o_totalprice AS VARCHAR) AS cd4_nadir_before_tce,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'months'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'weeks' END AS date_unit,
       CASE WHEN o_orderstatus = 'F' THEN '1.0' ELSE '1.1' END AS schema_version
FROM orders""",
    "lo": """
SELECT l.*, o.o_custkey,
       CAST(floor(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) / 30.0) AS BIGINT)
         AS rel_month
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "tce_treatments": """
SELECT CAST(l_orderkey AS VARCHAR) || '.xml' AS xml_filename,
       'P' || CAST(o_custkey AS VARCHAR) AS patient_alias,
       CAST(rel_month AS VARCHAR) AS relative_start_date,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(rel_month + l_linenumber AS VARCHAR) END AS relative_stop_date,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(l_linenumber AS VARCHAR) END AS duration,
       CASE WHEN l_quantity = 50 THEN NULL ELSE p_brand END AS drug_code,
       CASE WHEN p_type = 'ECONOMY' THEN 'CRI' WHEN p_type = 'LARGE' THEN 'FI' WHEN p_type = 'MEDIUM' THEN 'INI'
            WHEN p_type = 'PROMO' THEN 'NNRTI' WHEN p_type = 'SMALL' THEN 'NRTI'
            WHEN p_type = 'STANDARD' AND p_size % 2 = 0 THEN 'PI' WHEN p_type = 'STANDARD' THEN 'XX' END AS drug_class,
       CASE WHEN l_linestatus = 'O' THEN 'new' ELSE 'past' END AS treatment_type
FROM lo JOIN part ON l_partkey = p_partkey""",
    "tce_measurements": """
SELECT CAST(l_orderkey AS VARCHAR) || '.xml' AS xml_filename,
       'P' || CAST(o_custkey AS VARCHAR) AS patient_alias,
       CAST(rel_month AS VARCHAR) AS relative_date,
       CASE WHEN l_returnflag = 'R' THEN 'RNA' ELSE 'CD4' END AS measurement_type,
       (CASE WHEN l_linestatus = 'O' THEN 'followup' WHEN l_linenumber = 1 THEN 'past' ELSE 'baseline' END)
         || (CASE WHEN l_returnflag = 'R' THEN 'RNA' ELSE 'CD4' END) AS timepoint_tag,
       CASE WHEN l_linestatus = 'O' THEN 'followup' WHEN l_linenumber = 1 THEN 'past' ELSE 'baseline' END
         AS timepoint_type,
       CAST(l_quantity AS VARCHAR) AS value,
       CASE WHEN l_returnflag = 'A' THEN 'count' WHEN l_linenumber % 2 = 1 THEN 'logLoad' ELSE 'rawLoad' END
         AS value_type
FROM lo WHERE l_returnflag IN ('R', 'A')""",
    "iso_rows": """
SELECT CAST(l_orderkey AS VARCHAR) || '.xml' AS xml_filename,
       'P' || CAST(o_custkey AS VARCHAR) AS patient_alias,
       CAST(l_orderkey AS VARCHAR) || '.xml_' || itype || '_'
         || CAST(row_number() OVER (PARTITION BY l_orderkey, itype ORDER BY l_linenumber, l_partkey, l_suppkey) - 1
                 AS VARCHAR) AS isolate_id,
       itype AS isolate_type,
       CASE WHEN l_partkey % 3 = 0 THEN 'PR' WHEN l_partkey % 3 = 1 THEN 'RT' ELSE 'IN' END AS gene,
       CASE WHEN l_suppkey % 2 = 0 THEN 'B' ELSE 'C' END AS subtype,
       CAST(rel_month AS VARCHAR) AS relative_date,
       '1' AS aa_start,
       CAST(90 + l_linenumber AS VARCHAR) AS aa_stop,
       CAST(NULL AS VARCHAR) AS aa_sequence,
       CAST(NULL AS VARCHAR) AS nucleotide_sequence,
       CAST(l_linenumber AS VARCHAR) AS position,
       substr('ACDEFGHIKLMNPQRSTVWY', CAST(l_partkey % 20 + 1 AS INTEGER), 1) AS amino_acid,
       CASE WHEN l_suppkey % 5 = 0 THEN 'XY' END AS mixtures,
       l_quantity <= 45 AS has_mutation
FROM (SELECT *, CASE WHEN l_linestatus = 'F' THEN 'baseline' ELSE 'past' END AS itype FROM lo
      WHERE l_returnflag = 'N') x""",
    "tce_isolates": """
SELECT xml_filename, patient_alias, isolate_id, isolate_type, gene, subtype, relative_date, aa_start, aa_stop,
       aa_sequence, nucleotide_sequence
FROM iso_rows""",
    "tce_mutations": """
SELECT xml_filename, patient_alias, isolate_id, isolate_type, gene, relative_date, position, amino_acid, mixtures
FROM iso_rows WHERE has_mutation""",
}

# --- models, derived per case file ------------------------------------------------------------------------------------
# Column names, labels and thresholds are fixed values of the data model.
_CLASS_OF = {"pi": "PI", "nrti": "NRTI", "nnrti": "NNRTI", "insti": "INI", "cri": "CRI", "fi": "FI"}
_FLAGS = ", ".join(f"CAST(list_contains(classes, '{c}') AS INTEGER) AS contains_{name}" for name, c in _CLASS_OF.items())
MODEL_CTES = {
    "drug_sets": """
SELECT xml_filename, treatment_type, list_sort(list(DISTINCT drug_code)) AS codes,
       list_sort(list_intersect(coalesce(list(DISTINCT drug_class), []), ['CRI', 'FI', 'INI', 'NNRTI', 'NRTI', 'PI'])) AS classes
FROM tce_treatments WHERE drug_code IS NOT NULL GROUP BY ALL""",
    "dim_regimen": f"""
SELECT rank() OVER (ORDER BY xml_filename, treatment_type) AS regimen_key, xml_filename, treatment_type,
       len(codes) AS drug_count, array_to_string(codes, '+') AS regimen_signature,
       {_FLAGS}
FROM drug_sets""",
    "dim_time": """
SELECT rank() OVER (ORDER BY y) AS time_key, y AS baseline_year, format('{}s', y // 10 * 10) AS decade,
       CASE WHEN y > 2010 THEN '2011+' WHEN y > 2005 THEN '2006-2010' WHEN y >= 2000 THEN '2000-2005' ELSE '<2000' END AS year_bucket
FROM (SELECT unnest(list(DISTINCT CAST(baseline_year AS INTEGER))) AS y FROM tce_case) WHERE y IS NOT NULL""",
    "file_dates": """
SELECT DISTINCT xml_filename, relative_date FROM (
  SELECT xml_filename, unnest([relative_start_date, relative_stop_date]) AS relative_date FROM tce_treatments
  UNION ALL BY NAME SELECT relative_date, xml_filename FROM tce_measurements
  UNION ALL BY NAME SELECT relative_date, xml_filename FROM tce_isolates
  UNION ALL BY NAME SELECT relative_date, xml_filename FROM tce_mutations)""",
    "dim_relative_time": """
SELECT rank() OVER (ORDER BY relative_date, date_unit) AS relative_time_key, relative_date, date_unit,
       x * if(date_unit IS NOT DISTINCT FROM 'months', 4, 1) AS relative_weeks,
       ['pre', 'baseline', 'post'][CAST(sign(x) AS INTEGER) + 2] AS timepoint_phase,
       CASE WHEN x = 0 THEN 'baseline' WHEN x >= 1 AND x <= 24 THEN 'early_post' WHEN x < -52 THEN 'far_pre'
            WHEN x <= -1 THEN 'recent_pre' ELSE 'late_post' END AS timepoint_bucket,
       x = 0 AS is_baseline
FROM (SELECT DISTINCT relative_date, date_unit, CAST(relative_date AS DOUBLE) AS x
      FROM file_dates NATURAL JOIN tce_case WHERE relative_date IS NOT NULL)""",
    "measures": """
SELECT xml_filename,
       max(v) FILTER (timepoint_tag = 'baselineRNA' AND value_type = 'logLoad') AS baseline_log_rna,
       max(v) FILTER (timepoint_tag = 'followupRNA' AND value_type = 'logLoad') AS followup_log_rna,
       max(v) FILTER (timepoint_tag = 'baselineCD4' AND value_type = 'count') AS baseline_cd4,
       max(v) FILTER (timepoint_tag = 'followupCD4' AND value_type = 'count') AS followup_cd4
FROM (SELECT *, CAST(value AS DOUBLE) AS v FROM tce_measurements) GROUP BY xml_filename""",
    "mutation_numbers": """
SELECT xml_filename, count(*) FILTER (isolate_type = 'baseline') AS baseline_mutation_count
FROM tce_mutations GROUP BY xml_filename HAVING baseline_mutation_count > 0""",
    "fact": """
SELECT rank() OVER (ORDER BY xml_filename) AS tce_id, xml_filename, any_value(y) AS baseline_year,
       any_value(nadir) AS cd4_nadir_before_tce, any_value(baseline_log_rna) AS baseline_log_rna,
       any_value(baseline_cd4) AS baseline_cd4, any_value(followup_log_rna) AS followup_log_rna,
       any_value(followup_cd4) AS followup_cd4, CAST(coalesce(any_value(baseline_mutation_count), 0) AS BIGINT) AS baseline_mutation_count,
       arg_max(regimen_key, 1) FILTER (treatment_type = 'past') AS past_regimen_key,
       arg_max(regimen_key, 1) FILTER (treatment_type = 'new') AS new_regimen_key,
       if(baseline_year IS NULL, NULL, dense_rank() OVER (ORDER BY any_value(y) NULLS LAST)) AS time_key
FROM (SELECT xml_filename, true AS is_case, CAST(baseline_year AS INTEGER) AS y, CAST(cd4_nadir_before_tce AS DOUBLE) AS nadir FROM tce_case
      UNION ALL BY NAME FROM measures
      UNION ALL BY NAME FROM mutation_numbers
      UNION ALL BY NAME SELECT xml_filename, treatment_type, regimen_key FROM dim_regimen)
GROUP BY xml_filename HAVING bool_or(is_case)""",
    "dashboard": """
SELECT tce_id, xml_filename, baseline_year, decade, year_bucket, baseline_log_rna, baseline_cd4, followup_log_rna, followup_cd4,
       baseline_mutation_count, COLUMNS('^(regimen_signature|drug_count|contains_.*)$'),
       count(*) OVER (PARTITION BY regimen_signature) AS peers
FROM fact LEFT JOIN dim_time USING (baseline_year) JOIN (FROM dim_regimen WHERE treatment_type = 'new') USING (xml_filename)""",
    "class_counts": """
SELECT coalesce(array_to_string(classes, '+'), '') AS class_signature, count(*) AS tce_count
FROM drug_sets SEMI JOIN tce_case USING (xml_filename) WHERE treatment_type = 'new' GROUP BY 1""",
    "by_year": """
SELECT baseline_year, count(time_key) AS tce_count FROM fact GROUP BY baseline_year HAVING tce_count > 0""",
}

_ORDER = list(MAP_CTES) + list(MODEL_CTES)
_BODIES = {**MAP_CTES, **MODEL_CTES}


def with_ctes(final_sql: str, *names: str) -> str:
    """Prefix ``final_sql`` with the named CTEs and, transitively, the ones they reference (in definition order)."""
    needed: set[str] = set()

    def visit(n: str):
        if n in needed:
            return
        needed.add(n)
        body = _BODIES[n]
        for other in _ORDER:
            if other != n and _refers(body, other):
                visit(other)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({_BODIES[n].strip()})" for n in _ORDER if n in needed]
    return "WITH " + ",\n".join(parts) + "\n" + final_sql.strip()


def _refers(body: str, name: str) -> bool:
    import re
    return re.search(rf"\b{name}\b", body) is not None
