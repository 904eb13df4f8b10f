"""The two tabular side jobs: product price by brand (JSON in) and the feature table (CSV out).

Their inputs are built from the driver's ``part`` table so the work grows with the data:
  * products: JSON-lines documents ``{"products": [...]}`` of at most ``PRODUCTS_PER_DOC`` records; the ``brand`` key
    is absent for parts with size % 10 = 0 and an explicit ``null`` for size % 10 = 5;
  * features: one row per part; ``release_version`` is text (``'0.10' < '0.9'``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tcelake.operators.project import project_with_default
from tcelake.sinks.datasets import read_dataset, write_csv
from tcelake.sources.json_records import json_records

PRODUCTS_PER_DOC = 1000
KEEP_COLUMNS = ["brand", "price"]   # fixed value: the columns kept by default in the reference job


def product_documents(part: DataFrame, per_doc: int = PRODUCTS_PER_DOC, damaged_every: int | None = None) -> DataFrame:
    """(doc_id, doc STRING): JSON documents grouped by part-key range (a bounded group per document); with ``damaged_every`` the
    record of every so many parts is no JSON."""
    base = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
                    F.col("p_retailprice").alias("price"), F.col("p_type").alias("category"))
    with_brand = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"),
                          F.when(F.col("p_size") % 10 != 5, F.col("p_brand")).alias("brand"),
                          F.col("p_retailprice").alias("price"), F.col("p_type").alias("category"))
    rec = (F.when(F.col("p_size") % 10 == 0, F.to_json(base))
            .otherwise(F.to_json(with_brand, {"ignoreNullFields": "false"})))
    if damaged_every:
        rec = F.when(F.col("p_partkey") % damaged_every == 0, F.format_string('{"id":%d,"brand":tru}', "p_partkey")).otherwise(rec)
    docs = part.groupBy((F.col("p_partkey") / per_doc).cast("long").alias("doc_id")) \
               .agg(F.array_join(F.array_sort(F.collect_list(F.struct("p_partkey", rec.alias("j"))))
                                 .getField("j"), ",").alias("items"))
    return docs.select("doc_id", F.concat(F.lit('{"products":['), F.col("items"), F.lit("]}")).alias("doc"))


def write_product_documents(part: DataFrame, uri: str) -> str:
    product_documents(part).select("doc").write.mode("overwrite").text(uri)
    return uri


def projected_products(spark: SparkSession, uri: str, columns=KEEP_COLUMNS, default: str = "N/A",
                       multi_line: bool = False) -> DataFrame:
    """Keep ``columns`` of every product; absent key -> ``default``; explicit null stays null (all STRING)."""
    return project_with_default(json_records(spark, uri, "products", multi_line), "record", columns, default)


def cleaned_products_roundtrip(spark: SparkSession, docs_uri: str, cleaned_uri: str, columns=KEEP_COLUMNS,
                               default: str = "N/A", multi_line: bool = False) -> DataFrame:
    """The job's middle steps: keep ``columns`` (absent -> default), write the cleaned records as JSON lines, read them
    back with schema inference (the table-function read of the cleaned file)."""
    from tcelake.sinks.datasets import write_json_lines
    write_json_lines(projected_products(spark, docs_uri, columns, default, multi_line), cleaned_uri)
    return spark.read.json(cleaned_uri)


def brand_price(projected: DataFrame) -> DataFrame:
    """``brand, round(avg(price), 2) AS avg_price`` ordered by avg_price DESC (NULLs last)."""
    return (projected.groupBy("brand")
                     .agg(F.round(F.avg(F.col("price").cast("double")), 2).alias("avg_price"))
                     .orderBy(F.col("avg_price").desc_nulls_last(), F.col("brand").asc_nulls_last()))


def feature_rows(part: DataFrame) -> DataFrame:
    """id, name, description, release_version, edition — every column NOT NULL (checked by :func:`assert_not_null`)."""
    return part.select(
        (F.col("p_partkey") + 1).cast("int").alias("id"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("Part of type "), F.col("p_type"), F.lit(" in size "), F.col("p_size").cast("string"))
         .alias("description"),
        F.concat(F.lit("0."), F.col("p_size").cast("string")).alias("release_version"),
        F.when(F.col("p_size") % 2 == 0, F.lit("Enterprise")).otherwise(F.lit("Open-Source")).alias("edition"))


def assert_not_null(df: DataFrame, columns) -> DataFrame:
    """Fail the job (at execution) when a NOT NULL column holds a NULL, like a constraint on insert."""
    cond = None
    for c in columns:
        term = F.col(c).isNull()
        cond = term if cond is None else cond | term
    return df.withColumn("__chk", F.when(cond, F.raise_error(F.lit("NOT NULL constraint failed")))).drop("__chk")


FEATURE_SCHEMA = "id INT, name STRING, description STRING, release_version STRING, edition STRING"


def feature_csv_roundtrip(spark: SparkSession, part: DataFrame, uri: str) -> DataFrame:
    """Rebuild the table (overwrite), export it as CSV with a header, and read the export back, text-ordered."""
    rows = assert_not_null(feature_rows(part), ["name", "description", "release_version", "edition"])
    write_csv(rows.orderBy("release_version", "id"), uri)
    back = read_dataset(spark, uri, fmt="csv", schema=FEATURE_SCHEMA, options={"header": "true"})
    return back.orderBy("release_version", "id")


# ---- record listing: JSON decode, nested list projection, per-record join, template text (F25, F26) ----------------
LISTING_SCHEMA = "name STRING, types ARRAY<STRUCT<type: STRUCT<name: STRING>>>"


def user_type_documents(events: DataFrame) -> DataFrame:
    """(doc STRING) per user: ``{"name": "user_<id>", "types": [{"type": {"name": <event type>}}, ...]}``, the event
    types of that user in ascending order (at most one entry per distinct type, so a document stays small)."""
    per_user = events.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("ts"))
    doc = F.struct(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("name"),
                   F.transform("ts", lambda t: F.struct(F.struct(t.alias("name")).alias("type"))).alias("types"))
    return per_user.select(F.to_json(doc).alias("doc"))


def record_listing(docs: DataFrame, template: str = "Name: %s\nTypes: %s") -> DataFrame:
    """Decode each document, keep ``name`` and the nested type names joined by ', ', render ``template``."""
    d = docs.select(F.from_json("doc", LISTING_SCHEMA).alias("d"))
    types = F.array_join(F.transform(F.col("d.types"), lambda x: x["type"]["name"]), ", ")
    return d.select(F.col("d.name").alias("name"), types.alias("types"),
                    F.format_string(template, F.col("d.name"), types).alias("text"))


def write_listing(listing: DataFrame, uri: str) -> str:
    """The records' text, one block per record, blank line between them, in name order (range-partitioned sort)."""
    listing.orderBy("name").select(F.concat(F.col("text"), F.lit("\n")).alias("v")).write.mode("overwrite").text(uri)
    return uri
