"""JSON record sources: documents holding an array of records under one field.

Two layouts are read:
  * whole-file documents (``{"products": [...]}`` per file) with ``multiLine`` — one file per task;
  * JSON lines, one such document per line — splittable, the layout written by this package.
Records come back as MAP<STRING,STRING> so an absent key and an explicit ``null`` stay distinguishable
(see ``tcelake.operators.project.project_with_default``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def json_documents_text(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """(doc STRING) per JSON document."""
    if multi_line:
        # (the keyword matters: DataFrameReader.text() would reset an option("wholetext") to its default)
        return spark.read.text(path, wholetext=True).select(F.col("value").alias("doc"))
    return spark.read.text(path).select(F.col("value").alias("doc")).filter(F.trim("doc") != "")


def _parsed(spark: SparkSession, path: str, array_field: str, multi_line: bool) -> DataFrame:
    docs = json_documents_text(spark, path, multi_line)
    return docs.select("doc", F.from_json("doc", f"`{array_field}` ARRAY<MAP<STRING,STRING>>, `__damaged` STRING",
                                          {"columnNameOfCorruptRecord": "__damaged"}).alias("d"))


def json_records(spark: SparkSession, path: str, array_field: str, multi_line: bool = False, strict: bool = False) -> DataFrame:
    """One row per element of ``array_field``: column ``record`` MAP<STRING,STRING> (scalars as their JSON text).

    A document that does not parse fails the job with ``strict``; else it gives no records and is one of :func:`json_rejects`."""
    parsed = _parsed(spark, path, array_field, multi_line)
    records = F.col(f"d.{array_field}")
    if strict:
        refused = F.raise_error(F.concat(F.lit("not JSON: "), F.substring("doc", 1, 200))).cast("array<map<string,string>>")
        records = F.when(F.col("d.__damaged").isNotNull(), refused).otherwise(records)
    else:
        records = F.when(F.col("d.__damaged").isNull(), records)
    return parsed.select(F.explode(records).alias("record"))


def json_rejects(spark: SparkSession, path: str, array_field: str, multi_line: bool = False) -> DataFrame:
    """``doc`` of the documents that do not parse."""
    return _parsed(spark, path, array_field, multi_line).filter(F.col("d.__damaged").isNotNull()).select("doc")


def json_table(spark: SparkSession, path: str, array_field: str, multi_line: bool = False) -> DataFrame:
    """Schema-inferred records (the ``read_json_auto`` equivalent): struct fields become columns."""
    df = spark.read.option("multiLine", "true" if multi_line else "false").json(path)
    return df.select(F.explode(F.col(array_field)).alias("r")).select("r.*")
