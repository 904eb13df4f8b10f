"""Shred parsed case documents into the five source tables with native array expressions.

Input: ``docs`` with ``xml_filename`` and the nested columns of ``tcelake.schema.document_ddl``. Every output column is a
STRING. Each shredder is one ``explode`` over an array assembled with ``transform``/``concat``, so a document is read
once and the work is spread over the documents' partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tcelake.functions.scalar import is_truthy

# Fixed values of the reference: (element, measurement type, value fields) in extraction order.
MEASUREMENT_ELEMENTS = [
    ("baselineRNA", "RNA", ["logLoad", "rawLoad"]),
    ("pastRNA", "RNA", ["logLoad", "rawLoad"]),
    ("followupRNA", "RNA", ["logLoad", "rawLoad"]),
    ("baselineCD4", "CD4", ["count"]),
    ("pastCD4", "CD4", ["count"]),
    ("followupCD4", "CD4", ["count"]),
]
ISOLATE_ELEMENTS = [("baselineIsolate", "baseline"), ("pastIsolate", "past")]
TREATMENT_ELEMENTS = [("baselineNewTreatment", "new"), ("pastRegimenTreatments", "past")]


def _nonnull(arr: Column, elem_type: str) -> Column:
    return F.coalesce(arr, F.array().cast(elem_type))


def patient_leaf(leaf: str) -> Column:
    """First ``patient/<leaf>`` over all ``patient`` elements (an empty ``<patient/>`` before a filled one is skipped)."""
    return F.get(F.filter(F.transform(F.col("patient"), lambda p: p[leaf]), lambda a: a.isNotNull()), 0)


def shred_case(docs: DataFrame) -> DataFrame:
    return docs.select(
        "xml_filename",
        patient_leaf("patientAlias").alias("patient_alias"),
        F.col("baselineYear").alias("baseline_year"),
        patient_leaf("CD4NadirBeforeTCE").alias("cd4_nadir_before_tce"),
        F.col("dateUnit").alias("date_unit"),
        F.col("schemaVersion").alias("schema_version"),
    )


_MEAS_T = "array<struct<timepoint_tag:string,measurement_type:string,relative_date:string,value:string," \
          "value_type:string>>"


def _measurement_row(tag: str, mtype: str, vf: str):
    def row(n):
        return F.struct(F.lit(tag).alias("timepoint_tag"), F.lit(mtype).alias("measurement_type"),
                        n["relativeDate"].alias("relative_date"), n[vf].alias("value"),
                        F.lit(vf).alias("value_type"))
    return row


def _tagged(label_name: str, label: str, with_index: bool):
    if with_index:
        return lambda n, i: F.struct(F.lit(label).alias(label_name), i.alias("idx"), n.alias("node"))
    return lambda n: F.struct(F.lit(label).alias(label_name), n.alias("node"))


def shred_measurements(docs: DataFrame) -> DataFrame:
    """One row per (measurement element x value field with non-empty text)."""
    parts = []
    for tag, mtype, fields in MEASUREMENT_ELEMENTS:
        for vf in fields:
            parts.append(_nonnull(F.transform(F.col(tag), _measurement_row(tag, mtype, vf)), _MEAS_T))
    rows = docs.select("xml_filename", patient_leaf("patientAlias").alias("patient_alias"),
                       F.explode(F.concat(*parts)).alias("m"))
    return rows.filter(is_truthy(F.col("m.value"))).select(
        "xml_filename", "patient_alias", F.col("m.relative_date").alias("relative_date"),
        F.col("m.measurement_type").alias("measurement_type"), F.col("m.timepoint_tag").alias("timepoint_tag"),
        F.lower(F.replace(F.col("m.timepoint_tag"), F.col("m.measurement_type"), F.lit(""))).alias("timepoint_type"),
        F.col("m.value").alias("value"), F.col("m.value_type").alias("value_type"))


def _isolate_nodes(docs: DataFrame) -> DataFrame:
    parts = []
    for tag, itype in ISOLATE_ELEMENTS:
        elem_t = docs.schema[tag].dataType.elementType.simpleString()
        parts.append(_nonnull(F.transform(F.col(tag), _tagged("isolate_type", itype, True)),
                              f"array<struct<isolate_type:string,idx:int,node:{elem_t}>>"))
    return docs.select("xml_filename", patient_leaf("patientAlias").alias("patient_alias"),
                       F.explode(F.concat(*parts)).alias("iso")) \
        .select("xml_filename", "patient_alias",
                F.concat_ws("_", F.col("xml_filename"), F.col("iso.isolate_type"),
                            F.col("iso.idx").cast("string")).alias("isolate_id"),
                F.col("iso.isolate_type").alias("isolate_type"), F.col("iso.node").alias("node"))


def shred_isolates(docs: DataFrame) -> DataFrame:
    """One row per isolate element; ``isolate_id`` = file_type_i with i the 0-based position within its element."""
    n = F.col("node")
    return _isolate_nodes(docs).select(
        "xml_filename", "patient_alias", "isolate_id", "isolate_type",
        n["gene"].alias("gene"), n["subtype"].alias("subtype"),
        n["relativeDate"].alias("relative_date"), n["aaStart"].alias("aa_start"),
        n["aaStop"].alias("aa_stop"), n["aaSequence"].alias("aa_sequence"),
        n["nucleotideSequence"].alias("nucleotide_sequence"))


def shred_mutations(docs: DataFrame) -> DataFrame:
    """One row per ``aaMutation`` of an isolate; isolates without mutations give no row."""
    n = F.col("node")
    iso = _isolate_nodes(docs).select(
        "xml_filename", "patient_alias", "isolate_id", "isolate_type",
        n["gene"].alias("gene"), n["relativeDate"].alias("relative_date"),
        F.explode(n["aaMutation"]).alias("mut"))
    m = F.col("mut")
    return iso.select("xml_filename", "patient_alias", "isolate_id", "isolate_type", "gene", "relative_date",
                      m["position"].alias("position"), m["aminoAcid"].alias("amino_acid"),
                      m["mixtures"].alias("mixtures"))


def shred_treatments(docs: DataFrame) -> DataFrame:
    """One row per (treatment element x direct-child drug); a treatment without drugs gives no row."""
    parts = []
    for tag, ttype in TREATMENT_ELEMENTS:
        elem_t = docs.schema[tag].dataType.elementType.simpleString()
        parts.append(_nonnull(F.transform(F.col(tag), _tagged("treatment_type", ttype, False)),
                              f"array<struct<treatment_type:string,node:{elem_t}>>"))
    nodes = docs.select("xml_filename", patient_leaf("patientAlias").alias("patient_alias"),
                        F.explode(F.concat(*parts)).alias("t"))
    n = F.col("t.node")
    drugs = nodes.select("xml_filename", "patient_alias", F.col("t.treatment_type").alias("treatment_type"),
                         n["relativeStartDate"].alias("relative_start_date"),
                         n["relativeStopDate"].alias("relative_stop_date"),
                         n["duration"].alias("duration"), F.explode(n["drug"]).alias("drug"))
    d = F.col("drug")
    return drugs.select("xml_filename", "patient_alias", "relative_start_date", "relative_stop_date", "duration",
                        d["drugCode"].alias("drug_code"), d["drugClass"].alias("drug_class"),
                        "treatment_type")


#: Table -> (shredder, document elements that it reads): a table shredded alone needs no others parsed.
SHREDDERS = {
    "tce_case": (shred_case, ("patient", "baselineYear", "dateUnit", "schemaVersion")),
    "tce_measurements": (shred_measurements, ("patient", *[tag for tag, _, _ in MEASUREMENT_ELEMENTS])),
    "tce_isolates": (shred_isolates, ("patient", *[tag for tag, _ in ISOLATE_ELEMENTS])),
    "tce_mutations": (shred_mutations, ("patient", *[tag for tag, _ in ISOLATE_ELEMENTS])),
    "tce_treatments": (shred_treatments, ("patient", *[tag for tag, _ in TREATMENT_ELEMENTS])),
}


def shred_all(docs: DataFrame) -> dict[str, DataFrame]:
    return {name: shred(docs) for name, (shred, _) in SHREDDERS.items()}


def new_regimen_class_flags(docs: DataFrame, flags: dict[str, str]) -> DataFrame:
    """(xml_filename, <flag>...) per document with at least one new-treatment drug with a code: the regimen flags
    computed inside the document (its drugs are only in that document), without shredding and re-joining."""
    drugs = F.flatten(F.transform(F.coalesce(F.col("baselineNewTreatment"), F.array().cast(
        docs.schema["baselineNewTreatment"].dataType)), lambda t: F.coalesce(t["drug"], F.array().cast(
            docs.schema["baselineNewTreatment"].dataType.elementType["drug"].dataType))))
    coded = F.filter(drugs, lambda d: d["drugCode"].isNotNull())
    cols = [F.when(F.exists(coded, _class_is(cls)), F.lit(1)).otherwise(F.lit(0)).alias(flag)
            for flag, cls in flags.items()]
    return docs.select("xml_filename", F.size(coded).alias("__n"), *cols).filter(F.col("__n") > 0).drop("__n")


def _class_is(cls: str):
    return lambda d: d["drugClass"] == F.lit(cls)
