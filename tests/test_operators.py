
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tcelake.functions.scalar import (
    class_label_signature, convert_units, decade, relative_bucket, relative_phase, year_bucket)
from tcelake.operators.aggregate import (
    conditional_max_pivot, count_by, fold_small, keep_frequent, set_signature, share_of_total)
from tcelake.operators.join import full_outer_merge, left_enrich, union_distinct
from tcelake.operators.project import cast_columns, cast_rejects, project_with_default
from tcelake.operators.rank import dense_rank_key, sortable


@pytest.mark.parametrize("leaf", [1 << 16, 500, 7])
def test_dense_keys_equal_row_number_with_nulls_last(spark, leaf):
    # W1-W4: uneven partitions, text order, NULL keys last, BIGINT 1..n; one leaf, some, many
    rows = [(f"f{i * 37 % 1000:03d}" if i % 11 else None, None if i % 13 == 0 else f"t{i % 5}", i - 1500) for i in range(3000)]
    df = spark.createDataFrame(rows, "a string, b string, v int").repartition(7)
    for order in (["a", "b", "v"], ["v"]):
        ranked = dense_rank_key(df, order, "k", leaf=leaf)
        assert ranked.schema["k"].dataType.simpleString() == "bigint"
        expected = df.select(F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_last() for c in order])).alias("k"), "a", "b", "v")
        assert sorted(ranked.collect(), key=repr) == sorted(expected.collect(), key=repr)
    assert dense_rank_key(df.filter("false"), ["a"], "k", leaf=leaf).count() == 0


def test_dense_keys_of_long_common_prefixes_and_equal_keys(spark):
    df = spark.range(900).select(F.concat(F.lit("bucket/a/very/long/folder/"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("name"))
    ranked = dense_rank_key(df, ["name"], "k", leaf=50)
    assert [r.k for r in ranked.orderBy("name").collect()] == list(range(1, 901))
    same = spark.range(300).select(F.lit("x").alias("name"), "id")
    assert sorted(r.k for r in dense_rank_key(same, ["name", "id"], "k", leaf=50).collect()) == list(range(1, 301))


def test_sortable_text_keeps_the_order_of_numbers(spark):
    values = [-(1 << 63), -5, -1, 0, 1, 9, 10, (1 << 63) - 1, None]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    assert [r.v for r in df.orderBy(sortable(df, "v")).collect()] == values


def test_dense_keys_move_rows_by_prefix_only(spark):
    df = spark.range(1000).withColumn("s", F.col("id").cast("string"))
    plan = dense_rank_key(df, ["s"], "k", leaf=50)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "hashpartitioning(__rank_prefix" in plan


def test_conditional_max_pivot_takes_largest_and_never_casts_unmatched(spark):
    # A1: the largest value (not the latest); a text like '<50' in a non-selected row is never cast (T1)
    df = spark.createDataFrame([("f", "followupRNA", "logLoad", "2.1"), ("f", "followupRNA", "logLoad", "3.0"),
                                ("f", "followupRNA", "rawLoad", "<50"), ("g", "baselineCD4", "count", "7")],
                               "k string, tag string, vt string, value string")
    out = conditional_max_pivot(df, "k", {
        "fu": ((F.col("tag") == "followupRNA") & (F.col("vt") == "logLoad"), "value", "double"),
        "cd4": ((F.col("tag") == "baselineCD4") & (F.col("vt") == "count"), "value", "double")})
    got = {r.k: (r.fu, r.cd4) for r in out.collect()}
    assert got == {"f": (3.0, None), "g": (None, 7.0)}


def test_strict_and_lenient_casts(spark):
    df = spark.createDataFrame([("12",), ("",), ("abc",)], "x string")
    with pytest.raises(Exception):
        cast_columns(df, {"x": "int"}).collect()                       # ANSI: '' and 'abc' raise (T1)
    assert [r.x for r in cast_columns(df, {"x": "int"}, strict=False).collect()] == [12, None, None]
    assert cast_rejects(df, {"x": "int"}).first().x == 2


def test_set_signature_and_flags(spark):
    # A4/A5/F16/F17: NULL members removed, duplicates counted once, sorted binary order, '+' joined
    df = spark.createDataFrame([("f", "new", "CCC"), ("f", "new", "BBB"), ("f", "new", "BBB"), ("f", "new", None),
                                ("g", "new", "Brand#2"), ("g", "new", "Brand#10")],
                               "file string, t string, code string")
    got = {r.file: (r.n_distinct, r.signature) for r in set_signature(df, ["file", "t"], "code").collect()}
    assert got == {"f": (2, "BBB+CCC"), "g": (2, "Brand#10+Brand#2")}


def test_class_label_signature(spark):
    cols = ["contains_pi", "contains_nrti", "contains_nnrti", "contains_insti", "contains_cri", "contains_fi"]
    df = spark.createDataFrame([(1, 1, 0, 0, 0, 0), (0, 0, 0, 0, 0, 0), (1, 0, 1, 1, 1, 1)], ", ".join(
        f"{c} int" for c in cols))
    assert [r.s for r in df.select(class_label_signature().alias("s")).collect()] == [
        "NRTI+PI", "", "CRI+FI+INI+NNRTI+PI"]                             # no flag -> '' (T6)


def test_time_buckets_and_decade(spark):
    years = [1999, 2000, 2005, 2006, 2010, 2011]
    df = spark.createDataFrame([(y,) for y in years], "y int")
    got = [(r.d, r.b) for r in df.select(decade("y").alias("d"), year_bucket(F.col("y")).alias("b")).collect()]
    assert got == [("1990s", "<2000"), ("2000s", "2000-2005"), ("2000s", "2000-2005"), ("2000s", "2006-2010"),
                   ("2010s", "2006-2010"), ("2010s", "2011+")]


def test_relative_buckets_with_gaps(spark):
    vals = ["-53", "-52", "-1", "-0.5", "0", "0.5", "1", "24", "25"]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select(F.col("v").cast("double").alias("d"))
    got = [(r.p, r.b) for r in df.select(relative_phase("d").alias("p"), relative_bucket("d").alias("b")).collect()]
    assert got == [("pre", "far_pre"), ("pre", "recent_pre"), ("pre", "recent_pre"), ("pre", "late_post"),
                   ("baseline", "baseline"), ("post", "late_post"), ("post", "early_post"), ("post", "early_post"),
                   ("post", "late_post")]


def test_convert_units(spark):
    df = spark.createDataFrame([(3.0, "months"), (3.0, "weeks"), (3.0, None)], "d double, u string")
    assert [r.w for r in df.select(convert_units("d", "u", {"months": 4.0}).alias("w")).collect()] == [12.0, 3.0, 3.0]


def test_keep_frequent_counts_population(spark):
    # A7/J6: 10 rows of 'A' in the population (one of them will have a NULL year later) are kept; 9 of 'B' are not
    pop = spark.createDataFrame([("A", i) for i in range(10)] + [("B", i) for i in range(9)], "sig string, i int")
    kept = keep_frequent(pop.filter("i < 9"), "sig", 10, population=pop)
    assert {r.sig for r in kept.collect()} == {"A"} and kept.count() == 9


def test_fold_small_threshold_and_other_last(spark):
    df = spark.createDataFrame([("x", 100), ("y", 7), ("z", 6), ("w", 1)], "label string, n long")
    got = [tuple(r) for r in fold_small(df, "label", "n", 7).collect()]
    assert sorted(got, key=lambda r: r[2]) == [("x", 100, 1), ("y", 7, 2), ("Other", 7, 3)]
    none_small = fold_small(df.filter("n >= 7"), "label", "n", 7)
    assert "Other" not in {r.label for r in none_small.collect()}
    shares = share_of_total(fold_small(df, "label", "n", 7), "n", "share")
    assert abs(sum(r.share for r in shares.collect()) - 1.0) < 1e-12


def test_union_distinct_and_joins(spark):
    a = spark.createDataFrame([("1", "f"), ("1", "f"), (None, "f")], "d string, file string")
    b = spark.createDataFrame([("2", "f", "x"), (None, "f", "y")], "s string, file string, other string")
    u = union_distinct([(a, {"d": "d", "file": "file"}), (b, {"s": "d", "file": "file"})])
    assert sorted(u.collect(), key=str) == sorted([("1", "f"), (None, "f"), ("2", "f")], key=str)
    base = spark.createDataFrame([("f",), ("g",)], "file string")
    c = spark.createDataFrame([("f", 3)], "file string, n long")
    assert sorted(tuple(r) for r in left_enrich(base, [c], "file", fill={"n": 0}).collect()) == [("f", 3), ("g", 0)]
    x = spark.createDataFrame([("f", 1.0)], "file string, r double")
    y = spark.createDataFrame([("g", 2.0)], "file string, c double")
    assert sorted(tuple(r) for r in full_outer_merge(x, y, "file").collect()) == [("f", 1.0, None), ("g", None, 2.0)]


def test_count_by_is_bigint(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    out = count_by(df, ["k"], "n")
    assert out.schema["n"].dataType.simpleString() == "bigint"
    assert sorted(tuple(r) for r in out.collect()) == [("a", 2), ("b", 1)]


def test_project_with_default_keeps_null_vs_absent(spark):
    df = spark.createDataFrame([('{"products":[{"brand":"X","price":1.5},{"price":2},{"brand":null,"price":3}]}',)],
                               "doc string")
    recs = df.select(F.explode(F.from_json("doc", "products array<map<string,string>>")["products"]).alias("r"))
    got = [tuple(r) for r in project_with_default(recs, "r", ["brand", "price"]).collect()]
    assert got == [("X", "1.5"), ("N/A", "2"), (None, "3")]


def test_publish_views_and_tables(spark, tmp_path):
    from tcelake.plans.models import Models, publish
    from tcelake.schema import SOURCE_SCHEMAS
    tables = {n: spark.createDataFrame([], s) for n, s in SOURCE_SCHEMAS.items()}
    tables["tce_case"] = spark.createDataFrame([("1.xml", "P", "1999", "1", "weeks", "1")], SOURCE_SCHEMAS["tce_case"])
    out = publish(Models(tables), names=("dim_time", "tce_by_year"), db="pubdb", materialize={"tce_by_year"},
                  location=str(tmp_path))
    assert out == {"dim_time": "dim_time", "tce_by_year": "pubdb.tce_by_year"}
    assert spark.sql("SELECT decade FROM dim_time").first().decade == "1990s"
    assert spark.table("pubdb.tce_by_year").first().tce_count == 1
