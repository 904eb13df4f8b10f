"""Schemas: the nested columns of a parsed case document and the five source tables.

Every leaf is a STRING, its first occurrence; every element that may repeat is an ARRAY in document order.
"""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

ROOT_TAG = "tce"

# Fixed element names of the case document (the documented shape; values must equal the reference's).
_RNA = ["logLoad", "rawLoad", "relativeDate", "vLoadMatch"]
_CD4 = ["count", "relativeDate"]
_MUTATION = ["position", "aminoAcid", "mixtures"]
_ISOLATE = ["gene", "subtype", "relativeDate", "aaStart", "aaStop", "aaSequence", "nucleotideSequence"]
_TREATMENT = ["relativeStartDate", "relativeStopDate", "duration"]
_DRUG = ["drugCode", "drugClass"]

# element -> children: a list of leaves, or a dict for nested repeated elements.
DOCUMENT_SHAPE: dict[str, object] = {
    "patient": {"leaves": ["patientAlias", "CD4NadirBeforeTCE"]},
    "baselineYear": None,
    "dateUnit": None,
    "schemaVersion": None,
    "baselineRNA": {"leaves": _RNA},
    "pastRNA": {"leaves": _RNA},
    "followupRNA": {"leaves": _RNA},
    "baselineCD4": {"leaves": _CD4},
    "pastCD4": {"leaves": _CD4},
    "followupCD4": {"leaves": _CD4},
    "baselineIsolate": {"leaves": _ISOLATE, "children": {"aaMutation": {"leaves": _MUTATION}}},
    "pastIsolate": {"leaves": _ISOLATE, "children": {"aaMutation": {"leaves": _MUTATION}}},
    "baselineNewTreatment": {"leaves": _TREATMENT, "children": {"drug": {"leaves": _DRUG}}},
    "pastRegimenTreatments": {"leaves": _TREATMENT, "children": {"drug": {"leaves": _DRUG}}},
}


def _element_ddl(spec: dict | None) -> str:
    if spec is None:
        return "STRING"
    fields = [f"`{leaf}`: STRING" for leaf in spec.get("leaves", [])]
    for child, cspec in spec.get("children", {}).items():
        fields.append(f"`{child}`: {_element_ddl(cspec)}")
    return f"ARRAY<STRUCT<{', '.join(fields)}>>"


def document_ddl(shape: dict[str, object] = DOCUMENT_SHAPE) -> str:
    return ", ".join(f"`{name}`: {_element_ddl(spec)}" for name, spec in shape.items())


def document_paths(shape: dict[str, object] = DOCUMENT_SHAPE, root: str = ROOT_TAG) -> list[str]:
    """Every documented element path (used to flag off-schema paths in the profiler)."""
    out = [root]

    def walk(prefix: str, name: str, spec):
        p = f"{prefix}/{name}"
        out.append(p)
        if spec is None:
            return
        for leaf in spec.get("leaves", []):
            out.append(f"{p}/{leaf}")
        for child, cspec in spec.get("children", {}).items():
            walk(p, child, cspec)

    for name, spec in shape.items():
        walk(root, name, spec)
    return out


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


CASE_SCHEMA = _strings("xml_filename", "patient_alias", "baseline_year", "cd4_nadir_before_tce", "date_unit",
                       "schema_version")
MEASUREMENT_SCHEMA = _strings("xml_filename", "patient_alias", "relative_date", "measurement_type", "timepoint_tag",
                              "timepoint_type", "value", "value_type")
ISOLATE_SCHEMA = _strings("xml_filename", "patient_alias", "isolate_id", "isolate_type", "gene", "subtype",
                          "relative_date", "aa_start", "aa_stop", "aa_sequence", "nucleotide_sequence")
MUTATION_SCHEMA = _strings("xml_filename", "patient_alias", "isolate_id", "isolate_type", "gene", "relative_date",
                           "position", "amino_acid", "mixtures")
TREATMENT_SCHEMA = _strings("xml_filename", "patient_alias", "relative_start_date", "relative_stop_date", "duration",
                            "drug_code", "drug_class", "treatment_type")

SOURCE_SCHEMAS = {
    "tce_case": CASE_SCHEMA,
    "tce_measurements": MEASUREMENT_SCHEMA,
    "tce_isolates": ISOLATE_SCHEMA,
    "tce_mutations": MUTATION_SCHEMA,
    "tce_treatments": TREATMENT_SCHEMA,
}
