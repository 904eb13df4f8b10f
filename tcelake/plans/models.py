"""The star schema over the five source tables, as lazy DataFrame builders (one method per model, memoised).

Plan notes (scale):
  * every big join and group-by keys on ``xml_filename``; the fact is built with one conditional-max pass over the
    measurements instead of two group-bys and a FULL OUTER join, and the two regimen keys come from one pivot;
  * surrogate keys come from prefix counts (``dense_rank_key``) and are given to narrow rows before anything is joined to them: the
    fact ranks case rows of three columns, its regimen keys rank (file, type) pairs;
  * the dashboards need no regimen or time key, so they join by file and year and rank no regimens; popularity filters the
    regimen rows of one file each, before the fact's columns are joined to them;
  * no join is hinted: Spark broadcasts the sides whose size it knows or, at run time, measures;
  * class counts and yearly counts start from the case table: the fact has exactly one row per case row (every right
    side of its left joins is unique per file), so joining the whole fact is not needed for them.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tcelake.functions.scalar import (
    CLASS_FLAGS,
    class_label_signature,
    convert_units,
    decade,
    relative_bucket,
    relative_phase,
    year_bucket,
)
from tcelake.operators.aggregate import conditional_max_pivot, count_by, flags_by_value, keep_frequent, \
    set_signature_aggs
from tcelake.operators.join import full_outer_merge, left_enrich, union_distinct
from tcelake.operators.rank import dense_rank_key, prefix_counts, sortable
from tcelake.session import written_table

SOURCE_TABLES = ("tce_case", "tce_measurements", "tce_isolates", "tce_mutations", "tce_treatments")
# Column names of the published models and the values that their measures select by.
REGIMEN_FLAG_COLUMNS = list(CLASS_FLAGS)  # contains_pi, nrti, nnrti, insti, cri, fi
DASHBOARD_COLUMNS = [
    "tce_id", "xml_filename", "baseline_year", "decade", "year_bucket", "baseline_log_rna", "baseline_cd4",
    "followup_log_rna", "followup_cd4", "baseline_mutation_count", "regimen_signature", "drug_count",
    "contains_pi", "contains_nrti", "contains_nnrti", "contains_insti", "contains_cri", "contains_fi",
]
FACT_COLUMNS = ["tce_id", "xml_filename", "baseline_year", "cd4_nadir_before_tce", "baseline_log_rna", "baseline_cd4",
                "followup_log_rna", "followup_cd4", "baseline_mutation_count", "past_regimen_key", "new_regimen_key",
                "time_key"]
NEW_REGIMEN_ATTRIBUTES = ["regimen_signature", "drug_count", *REGIMEN_FLAG_COLUMNS]
POPULAR_MIN_CASES = 10
MONTH_FACTORS = {"months": 4.0}


class Models:
    """Builders M1-M9. ``tables`` maps the five source names to DataFrames (dependency injection for tests)."""

    def __init__(self, tables: dict[str, DataFrame], strict: bool = True):
        missing = [t for t in SOURCE_TABLES if t not in tables]
        if missing:
            raise KeyError(f"missing source tables: {missing}")
        self.t = tables
        self.strict = strict   # True: casts of source text fail the query on bad text (parity); False: NULL instead

    def _cast(self, col, dtype: str):
        c = F.col(col) if isinstance(col, str) else col
        return c.cast(dtype) if self.strict else c.try_cast(dtype)

    # ---- M1 -------------------------------------------------------------------------------------------------------
    def stg_measurements(self) -> DataFrame:
        m = self.t["tce_measurements"]
        return m.select("xml_filename", "patient_alias",
                        self._cast("relative_date", "int").alias("relative_date"),
                        "measurement_type",
                        self._cast("value", "double").alias("value"),
                        "value_type")

    # ---- M2 -------------------------------------------------------------------------------------------------------
    def regimen_aggregate(self, treatment_type: str | None = None) -> DataFrame:
        """One row per (file, treatment_type): drug count, class flags, sorted drug signature (NULL codes dropped)."""
        t = self.t["tce_treatments"].filter(F.col("drug_code").isNotNull())
        aggs = [*set_signature_aggs("drug_code", "+", "drug_count", "regimen_signature"),
                *flags_by_value("drug_class", CLASS_FLAGS)]
        if treatment_type is not None:
            # one type: group by the file alone, so a later join on xml_filename reuses this partitioning
            return (t.filter(F.col("treatment_type") == treatment_type).groupBy("xml_filename").agg(*aggs)
                     .select("xml_filename", F.lit(treatment_type).alias("treatment_type"), *[a for a in
                             ["drug_count", "regimen_signature", *CLASS_FLAGS]]))
        return t.groupBy("xml_filename", "treatment_type").agg(*aggs)

    @cached_property
    def _dim_regimen(self) -> DataFrame:
        # Written once: the counts by prefix and the keys read it, the aggregation of the treatments runs once.
        ranked = dense_rank_key(written_table(self.regimen_aggregate(), "regimens"), ["xml_filename", "treatment_type"], "regimen_key")
        return ranked.select("regimen_key", "xml_filename", "treatment_type", "drug_count", *REGIMEN_FLAG_COLUMNS, "regimen_signature")

    def dim_regimen(self) -> DataFrame:
        return self._dim_regimen

    # ---- M3 -------------------------------------------------------------------------------------------------------
    def years(self) -> DataFrame:
        c = self.t["tce_case"]
        return c.filter(F.col("baseline_year").isNotNull()).select(self._cast("baseline_year", "int").alias("baseline_year"))

    def _years_distinct(self) -> DataFrame:
        return self.years().distinct()

    @cached_property
    def _year_counts(self):
        years = self._years_distinct()
        return prefix_counts(years, sortable(years, "baseline_year"))

    def _time_keys(self) -> DataFrame:
        """``time_key, baseline_year``; a new frame per call, so that callers can join the dimension to a fact made from another one."""
        return dense_rank_key(self._years_distinct(), ["baseline_year"], "time_key", counted=self._year_counts)

    @cached_property
    def _dim_time(self) -> DataFrame:
        return self._time_keys().select("time_key", "baseline_year", decade("baseline_year").alias("decade"),
                                        year_bucket("baseline_year").alias("year_bucket"))

    def dim_time(self) -> DataFrame:
        return self._dim_time

    # ---- M4 -------------------------------------------------------------------------------------------------------
    def relative_dates(self, distinct: bool = True) -> DataFrame:
        """UNION of (relative_date, xml_filename) over measurements, isolates, mutations, treatment start and stop."""
        tt = self.t["tce_treatments"]
        return union_distinct([
            (self.t["tce_measurements"], {"relative_date": "relative_date", "xml_filename": "xml_filename"}),
            (self.t["tce_isolates"], {"relative_date": "relative_date", "xml_filename": "xml_filename"}),
            (self.t["tce_mutations"], {"relative_date": "relative_date", "xml_filename": "xml_filename"}),
            (tt, {"relative_start_date": "relative_date", "xml_filename": "xml_filename"}),
            (tt, {"relative_stop_date": "relative_date", "xml_filename": "xml_filename"}),
        ], distinct=distinct)

    def dated_files(self) -> DataFrame:
        """``relative_date, xml_filename`` of all tables, not de-duplicated; a treatment gives its start and its stop in one pass."""
        tt = self.t["tce_treatments"].select(F.explode(F.array("relative_start_date", "relative_stop_date")).alias("relative_date"), "xml_filename")
        parts = [*(self.t[n].select("relative_date", "xml_filename") for n in ("tce_measurements", "tce_isolates", "tce_mutations")), tt]
        return reduce(DataFrame.unionByName, parts).filter(F.col("relative_date").isNotNull())

    @cached_property
    def _dim_relative_time(self) -> DataFrame:
        # Join first, de-duplicate once at the end, within tasks before the exchange: the (relative_date, date_unit) pairs are what is kept.
        # (Measured: sets of dates per file before the join are slower, their aggregation falls back to sorting.)
        units = self.t["tce_case"].select("xml_filename", "date_unit")
        pairs = self.dated_files().join(units, "xml_filename").select("relative_date", "date_unit").distinct()
        pairs = written_table(pairs, "relative-dates")
        d = self._cast("relative_date", "double")
        final = pairs.select(
            "relative_date", "date_unit",
            convert_units(d, F.col("date_unit"), MONTH_FACTORS).alias("relative_weeks"),
            relative_phase(d).alias("timepoint_phase"),
            relative_bucket(d).alias("timepoint_bucket"),
            F.when(d == 0, F.lit(True)).otherwise(F.lit(False)).alias("is_baseline"),
        )
        return dense_rank_key(final, ["relative_date", "date_unit"], "relative_time_key")

    def dim_relative_time(self) -> DataFrame:
        return self._dim_relative_time

    # ---- M5 -------------------------------------------------------------------------------------------------------
    def _measure_specs(self):
        m, tag, vt = F.col("measurement_type"), F.col("timepoint_tag"), F.col("value_type")
        return {
            "baseline_log_rna": ((m == "RNA") & (tag == "baselineRNA") & (vt == "logLoad"), "value", "double"),
            "followup_log_rna": ((m == "RNA") & (tag == "followupRNA") & (vt == "logLoad"), "value", "double"),
            "baseline_cd4": ((m == "CD4") & (tag == "baselineCD4") & (vt == "count"), "value", "double"),
            "followup_cd4": ((m == "CD4") & (tag == "followupCD4") & (vt == "count"), "value", "double"),
        }

    def measure_pivot(self) -> DataFrame:
        """R1: one pass, one group-by over RNA and CD4 rows (partition filter on measurement_type)."""
        m = self.t["tce_measurements"].filter(F.col("measurement_type").isin("RNA", "CD4"))
        return conditional_max_pivot(m, "xml_filename", self._measure_specs(), self.strict) \
            .select("xml_filename", "baseline_log_rna", "followup_log_rna", "baseline_cd4", "followup_cd4")

    def measure_pivot_full_outer(self) -> DataFrame:
        """J1 as written in the reference: RNA pivot FULL OUTER CD4 pivot, key coalesced."""
        specs = self._measure_specs()
        m = self.t["tce_measurements"]
        rna = conditional_max_pivot(m.filter(F.col("measurement_type") == "RNA"), "xml_filename",
                                    {k: specs[k] for k in ("baseline_log_rna", "followup_log_rna")}, self.strict)
        cd4 = conditional_max_pivot(m.filter(F.col("measurement_type") == "CD4"), "xml_filename",
                                    {k: specs[k] for k in ("baseline_cd4", "followup_cd4")}, self.strict)
        return full_outer_merge(rna, cd4, "xml_filename") \
            .select("xml_filename", "baseline_log_rna", "followup_log_rna", "baseline_cd4", "followup_cd4")

    def baseline_mutation_counts(self) -> DataFrame:
        mu = self.t["tce_mutations"].filter(F.col("isolate_type") == "baseline")
        return count_by(mu, ["xml_filename"], "baseline_mutation_count")

    def regimen_keys(self) -> DataFrame:
        """past/new regimen key per file: the keys of ``dim_regimen``, ranked over its (file, type) pairs alone."""
        t = self.t["tce_treatments"].filter(F.col("drug_code").isNotNull())
        pairs = written_table(t.select("xml_filename", "treatment_type").distinct(), "regimen-pairs")
        keyed = dense_rank_key(pairs, ["xml_filename", "treatment_type"], "regimen_key")
        return keyed.groupBy("xml_filename").agg(*[
            F.max(F.when(F.col("treatment_type") == kind, F.col("regimen_key"))).alias(f"{kind}_regimen_key") for kind in ("past", "new")])

    @cached_property
    def _cases(self) -> DataFrame:
        """``tce_id, xml_filename, baseline_year, cd4_nadir_before_tce``: the fact has one row per case row, so its key is theirs."""
        c = self.t["tce_case"].select(
            "xml_filename",
            self._cast("baseline_year", "int").alias("baseline_year"),
            self._cast("cd4_nadir_before_tce", "double").alias("cd4_nadir_before_tce"))
        return dense_rank_key(c, ["xml_filename"], "tce_id")

    def fact_tce(self) -> DataFrame:
        joined = left_enrich(self._cases, [self.measure_pivot(), self.baseline_mutation_counts(), self.regimen_keys()],
                             "xml_filename", fill={"baseline_mutation_count": 0})
        time = self._time_keys().select(F.col("baseline_year").alias("__year"), F.col("time_key").alias("__time_key"))
        return joined.join(time, F.col("baseline_year") == F.col("__year"), "left").withColumnRenamed("__time_key", "time_key").select(*FACT_COLUMNS)

    # ---- M6 / M7 --------------------------------------------------------------------------------------------------
    def _dashboard(self, regimens: DataFrame) -> DataFrame:
        """fact x regimen x time by their natural keys: a fact row has a new_regimen_key exactly when its file has a new regimen,
        and a time_key exactly when it has a year, whose decade and bucket follow from it."""
        rows = left_enrich(self._cases.filter(F.col("baseline_year").isNotNull()).join(regimens, "xml_filename"),
                           [self.measure_pivot(), self.baseline_mutation_counts()], "xml_filename", fill={"baseline_mutation_count": 0})
        return rows.select("*", decade("baseline_year").alias("decade"), year_bucket("baseline_year").alias("year_bucket")).select(*DASHBOARD_COLUMNS)

    def _new_regimens(self) -> DataFrame:
        return self.regimen_aggregate("new").select("xml_filename", *NEW_REGIMEN_ATTRIBUTES)

    def dashboard_unfiltered(self) -> DataFrame:
        return self._dashboard(self._new_regimens())

    def dashboard(self, min_cases: int = POPULAR_MIN_CASES) -> DataFrame:
        # popularity is counted over fact x regimen rows before the year join (NULL-year cases count toward it)
        regimens = self._new_regimens()
        population = self.t["tce_case"].select("xml_filename").join(regimens.select("xml_filename", "regimen_signature"), "xml_filename")
        return self._dashboard(keep_frequent(regimens, "regimen_signature", min_cases, population))

    # ---- M8 -------------------------------------------------------------------------------------------------------
    def tce_by_year(self) -> DataFrame:
        """Cases per year. fact ⋈ dim_time keeps exactly the case rows with a non-null year, so count those."""
        return count_by(self.years(), ["baseline_year"], "tce_count")

    # ---- M9 -------------------------------------------------------------------------------------------------------
    def new_regimen_classes(self) -> DataFrame:
        """(xml_filename, class_signature) for every file with a new regimen."""
        return self.regimen_aggregate("new").select("xml_filename",
                                                    class_label_signature().alias("class_signature"))

    def v_new_regimen_class_counts(self) -> DataFrame:
        # fact rows = case rows; each case has at most one new regimen row, so count case rows joined to it.
        cases = self.t["tce_case"].select("xml_filename")
        joined = cases.join(self.new_regimen_classes(), "xml_filename", "inner")
        return count_by(joined, ["class_signature"], "tce_count")


MODEL_NAMES = ("stg_measurements", "dim_regimen", "dim_time", "dim_relative_time", "fact_tce", "dashboard",
               "dashboard_unfiltered", "tce_by_year", "v_new_regimen_class_counts")


def publish(models: Models, names=MODEL_NAMES, db: str | None = None, materialize: set[str] | frozenset = frozenset(),
            location: str | None = None) -> dict[str, str]:
    """Expose models by name: temp views by default (lazy, like SQL views); models in ``materialize`` are written as
    external catalog tables at ``<location>/<db>/<name>`` (default: the warehouse folder), overwritten on reruns, so
    nested readers do not recompute them. Returns name -> relation."""
    out = {}
    spark = models.t["tce_case"].sparkSession
    if db:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    root = (location or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    for name in names:
        df = getattr(models, name)()
        if name in materialize:
            if not db:
                raise ValueError("materialized models need a database")
            (df.write.mode("overwrite").format("parquet").option("path", f"{root}/{db}/{name}")
               .saveAsTable(f"`{db}`.`{name}`"))
            out[name] = f"{db}.{name}"
        else:
            df.createOrReplaceTempView(name)
            out[name] = name
    return out
