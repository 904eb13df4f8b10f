"""Views from the driver's TPC-H-like tables to the five TCE source shapes (all columns STRING, like the shredder).

The same mapping is repeated, as DuckDB CTEs, in ``tcelake.plans.oracle`` so the driver can check every model.

Mapping (one order = one case file):
  tce_case         orders.       xml_filename = '<o_orderkey>.xml'; year NULL for every 97th order key;
                   date_unit months (priority 1/2), weeks (3), NULL otherwise.
  tce_treatments   lineitem x part x orders. linestatus O -> 'new', else 'past'; drug = brand;
                   class from the part type; code NULL for quantity 50; stop/duration NULL for line 7.
  tce_measurements lineitem x orders, returnflag R (RNA) / A (CD4); tag by linestatus and line number.
  tce_isolates     lineitem returnflag N; isolate index = document order inside (order, isolate type).
  tce_mutations    one per isolate, except isolates with quantity > 45 (isolates without mutations).
Relative dates are whole "months" between order and ship date: floor(days / 30).

The column expressions are defined once (``*_columns``) over the joined lineitem rows, and shared by the tables and by
the case-document assembly (``tcelake.sources.driver_docs``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                 "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed values of the mapping (part type -> drug class). STANDARD parts alternate between PI and an unknown class so
# both the PI flag and the empty class signature are exercised.
TYPE_TO_CLASS = {
    "ECONOMY": "CRI",
    "LARGE": "FI",
    "MEDIUM": "INI",
    "PROMO": "NNRTI",
    "SMALL": "NRTI",
}
AMINO_ACIDS = "ACDEFGHIKLMNPQRSTVWY"
ISOLATE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey")   # document order of isolates within (file, type)


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def file_of(key: Column) -> Column:
    return F.concat(key.cast("string"), F.lit(".xml"))


def _rel_month() -> Column:
    days = F.datediff(F.to_date(F.col("l_shipdate")), F.to_date(F.col("o_orderdate")))
    return F.floor(days / F.lit(30.0)).cast("long")


def _patient(custkey: str) -> Column:
    return F.concat(F.lit("P"), F.col(custkey).cast("string"))


def case_columns() -> dict[str, Column]:
    """Over ``orders`` rows."""
    return {
        "xml_filename": file_of(F.col("o_orderkey")),
        "patient_alias": _patient("o_custkey"),
        "baseline_year": F.when(F.col("o_orderkey") % 97 == 0, F.lit(None).cast("string"))
                          .otherwise(F.year("o_orderdate").cast("string")),
        "cd4_nadir_before_tce": F.col("o_totalprice").cast("string"),
        "date_unit": F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("months"))
                      .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("weeks")),
        "schema_version": F.when(F.col("o_orderstatus") == "F", F.lit("1.0")).otherwise(F.lit("1.1")),
    }


def treatment_columns() -> dict[str, Column]:
    """Over lineitem x orders x part rows."""
    cls = None
    for t, c in TYPE_TO_CLASS.items():
        cls = F.when(F.col("p_type") == t, F.lit(c)) if cls is None else cls.when(F.col("p_type") == t, F.lit(c))
    cls = cls.when((F.col("p_type") == "STANDARD") & (F.col("p_size") % 2 == 0), F.lit("PI")) \
             .when(F.col("p_type") == "STANDARD", F.lit("XX"))
    start = _rel_month()
    last = F.col("l_linenumber") == 7
    return {
        "xml_filename": file_of(F.col("l_orderkey")),
        "patient_alias": _patient("o_custkey"),
        "relative_start_date": start.cast("string"),
        "relative_stop_date": F.when(last, F.lit(None).cast("string"))
                               .otherwise((start + F.col("l_linenumber")).cast("string")),
        "duration": F.when(last, F.lit(None).cast("string")).otherwise(F.col("l_linenumber").cast("string")),
        "drug_code": F.when(F.col("l_quantity") == 50, F.lit(None).cast("string")).otherwise(F.col("p_brand")),
        "drug_class": cls,
        "treatment_type": F.when(F.col("l_linestatus") == "O", F.lit("new")).otherwise(F.lit("past")),
    }


MEASUREMENT_FLAGS = ("R", "A")
ISOLATE_FLAG = "N"


def measurement_columns() -> dict[str, Column]:
    """Over lineitem x orders rows with returnflag R or A."""
    mtype = F.when(F.col("l_returnflag") == "R", F.lit("RNA")).otherwise(F.lit("CD4"))
    ttype = (F.when(F.col("l_linestatus") == "O", F.lit("followup"))
              .when(F.col("l_linenumber") == 1, F.lit("past")).otherwise(F.lit("baseline")))
    vtype = (F.when(F.col("l_returnflag") == "A", F.lit("count"))
              .when(F.col("l_linenumber") % 2 == 1, F.lit("logLoad")).otherwise(F.lit("rawLoad")))
    return {
        "xml_filename": file_of(F.col("l_orderkey")),
        "patient_alias": _patient("o_custkey"),
        "relative_date": _rel_month().cast("string"),
        "measurement_type": mtype,
        "timepoint_tag": F.concat(ttype, mtype),
        "timepoint_type": ttype,
        "value": F.col("l_quantity").cast("string"),
        "value_type": vtype,
    }


def isolate_columns() -> dict[str, Column]:
    """Over lineitem x orders rows with returnflag N (isolate leaves and its single mutation's leaves)."""
    gene = (F.when(F.col("l_partkey") % 3 == 0, F.lit("PR"))
             .when(F.col("l_partkey") % 3 == 1, F.lit("RT")).otherwise(F.lit("IN")))
    return {
        "xml_filename": file_of(F.col("l_orderkey")),
        "patient_alias": _patient("o_custkey"),
        "isolate_type": F.when(F.col("l_linestatus") == "F", F.lit("baseline")).otherwise(F.lit("past")),
        "gene": gene,
        "subtype": F.when(F.col("l_suppkey") % 2 == 0, F.lit("B")).otherwise(F.lit("C")),
        "relative_date": _rel_month().cast("string"),
        "aa_start": F.lit("1"),
        "aa_stop": (F.lit(90) + F.col("l_linenumber")).cast("string"),
        "aa_sequence": F.lit(None).cast("string"),
        "nucleotide_sequence": F.lit(None).cast("string"),
        "position": F.col("l_linenumber").cast("string"),
        "amino_acid": F.substring(F.lit(AMINO_ACIDS), (F.col("l_partkey") % 20 + 1).cast("int"), 1),
        "mixtures": F.when(F.col("l_suppkey") % 5 == 0, F.lit("XY")),
        "has_mutation": F.col("l_quantity") <= 45,
    }


ISOLATE_TABLE_COLUMNS = ["xml_filename", "patient_alias", "isolate_id", "isolate_type", "gene", "subtype",
                         "relative_date", "aa_start", "aa_stop", "aa_sequence", "nucleotide_sequence"]
MUTATION_TABLE_COLUMNS = ["xml_filename", "patient_alias", "isolate_id", "isolate_type", "gene", "relative_date",
                          "position", "amino_acid", "mixtures"]


@dataclass
class DriverSources:
    """Lazily built source tables over one driver directory."""

    spark: SparkSession
    sf_dir: str

    def t(self, name: str) -> DataFrame:
        return read_driver(self.spark, self.sf_dir, name)

    def lines(self, flags=None, with_part: bool = False, part_join: str = "inner") -> DataFrame:
        """lineitem x orders (x part): the rows every child table is mapped from."""
        li = self.t("lineitem")
        if flags is not None:
            li = li.filter(F.col("l_returnflag").isin(*flags))
        o = self.t("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
        if with_part:
            p = self.t("part").select("p_partkey", "p_brand", "p_type", "p_size")
            j = j.join(p, j.l_partkey == p.p_partkey, part_join)
        return j

    def tce_case(self) -> DataFrame:
        return self.t("orders").select(*[c.alias(n) for n, c in case_columns().items()])

    def tce_treatments(self) -> DataFrame:
        return self.lines(with_part=True).select(*[c.alias(n) for n, c in treatment_columns().items()])

    def tce_measurements(self) -> DataFrame:
        return self.lines(flags=MEASUREMENT_FLAGS).select(*[c.alias(n) for n, c in measurement_columns().items()])

    def _isolate_rows(self) -> DataFrame:
        cols = isolate_columns()
        rows = self.lines(flags=(ISOLATE_FLAG,)).select(*ISOLATE_ORDER, "l_orderkey",
                                                        *[c.alias(n) for n, c in cols.items()])
        # document order of isolates inside one case file and tag (partitioned by the file key: no global ordering)
        w = Window.partitionBy("l_orderkey", "isolate_type").orderBy(*ISOLATE_ORDER)
        return rows.withColumn("isolate_id", F.concat_ws("_", F.col("xml_filename"), F.col("isolate_type"),
                                                         (F.row_number().over(w) - 1).cast("string")))

    def tce_isolates(self) -> DataFrame:
        return self._isolate_rows().select(*ISOLATE_TABLE_COLUMNS)

    def tce_mutations(self) -> DataFrame:
        return self._isolate_rows().filter("has_mutation").select(*MUTATION_TABLE_COLUMNS)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "tce_case": self.tce_case(),
            "tce_measurements": self.tce_measurements(),
            "tce_isolates": self.tce_isolates(),
            "tce_mutations": self.tce_mutations(),
            "tce_treatments": self.tce_treatments(),
        }


def driver_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return DriverSources(spark, sf_dir).tables()
