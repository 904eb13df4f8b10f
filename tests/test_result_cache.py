"""Results are read back while query, settings and inputs are the same, and computed anew when one changes."""

import pytest
from pyspark.sql import functions as F

from tcelake.plans.result_cache import ResultCache
from tcelake.sinks.publication import publish_versions


@pytest.fixture()
def cache(spark, tmp_path):
    return ResultCache(spark, str(tmp_path / "cache"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_hit_change_of_input_and_fresh_result(spark, cache, tmp_path):
    uri = str(tmp_path / "in")
    spark.range(100).selectExpr("id", "id % 3 AS g").write.parquet(uri)
    query = lambda: spark.read.parquet(uri).groupBy("g").agg(F.sum("id").alias("s"), F.count("*").alias("n"))
    first, again = cache.get(query()), cache.get(query())
    assert (first.hit, again.hit) == (False, True) and first.key == again.key
    assert rows(first.frame) == rows(again.frame) == rows(query())
    spark.range(100, 150).selectExpr("id", "id % 3 AS g").write.mode("append").parquet(uri)
    changed = cache.get(query())
    assert not changed.hit and rows(changed.frame) == rows(query()) != rows(first.frame)
    assert cache.get(query()).hit


def test_other_query_or_setting_is_another_result(spark, cache, tmp_path):
    uri = str(tmp_path / "in")
    wide = spark.range(50).select("id", *[(F.col("id") * i).alias(f"c{i}") for i in range(40)])
    wide.write.parquet(uri)
    t = lambda: spark.read.parquet(uri)
    keys = [cache.key(q) for q in (
        t().select("c1"), t().select("c2"), t().select(F.col("c1").alias("c2")), t(), t().filter("c39 > 5"), t().filter("c39 > 6"),
        t().filter(F.col("id").isin(list(range(40)))), t().filter(F.col("id").isin([*range(39), 44])), t().filter("id > 3").select("c1"))]
    assert None not in keys and len(set(keys)) == len(keys)
    texts = lambda: t().select(F.col("id").cast("string").alias("a"), F.col("c1").cast("string").alias("b"))
    alike = [texts().filter(F.col("a").isin(*v)) for v in (["1", "2"], ["1,2"], ["1, 2"])]
    alike += [texts().filter(F.concat("a", F.lit(x), F.lit(y)) != "") for x, y in (("p, q", "r"), ("p", "q, r"))]
    assert len({cache.key(q) for q in alike}) == len(alike)
    moment = lambda: t().select(F.timestamp_seconds("id").cast("string").alias("at"))
    before, zone = cache.key(moment()), spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    assert cache.key(moment()) != before
    spark.conf.set("spark.sql.session.timeZone", zone)
    assert cache.key(moment()) == before


def test_what_no_key_describes_is_not_kept(spark, cache, tmp_path):
    uri = str(tmp_path / "in")
    spark.range(5).write.parquet(uri)
    t = spark.read.parquet(uri)
    twice = F.udf(lambda x: 2 * x, "long")
    for df in (t.select(F.rand().alias("r")), t.select(twice("id").alias("x")), t.mapInArrow(lambda b: b, "id long"),
               spark.createDataFrame([(1,), (2,)], "x long"), t.join(spark.createDataFrame([(1,)], "id long"), "id")):
        got = cache.get(df)
        assert got.key is None and not got.hit and got.frame is df
    now = lambda: t.select("id", F.current_timestamp().alias("at"))
    assert not cache.get(now()).hit and not cache.get(now()).hit
    assert cache.key(spark.range(7).filter("id > 2")) is not None


def test_half_written_result_is_computed_again(spark, cache, tmp_path):
    uri = str(tmp_path / "in")
    spark.range(9).write.parquet(uri)
    query = lambda: spark.read.parquet(uri).filter("id > 4")
    spark.range(1).write.parquet(f"{cache.root}/{cache.key(query())}")
    got = cache.get(query())
    assert not got.hit and got.frame.count() == 4 and cache.get(query()).hit


def test_new_version_of_a_published_table(spark, cache, tmp_path):
    db = "tcelake_cached"
    for name, n in (("a", 3), ("b", 8)):
        spark.range(n).write.parquet(str(tmp_path / name))
    query = lambda: spark.sql(f"SELECT count(*) AS n FROM {db}.t")
    got = []
    for name in "aabba":
        publish_versions(spark, db, {"t": str(tmp_path / name)})
        r = cache.get(query())
        got.append((r.hit, r.frame.first()[0]))
    assert got == [(False, 3), (True, 3), (False, 8), (True, 8), (True, 3)]
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_key_does_not_depend_on_the_session(spark, cache, tmp_path):
    uri = str(tmp_path / "in")
    spark.range(9).selectExpr("id", "id % 2 AS g").write.parquet(uri)
    query = lambda s: s.read.parquet(uri).groupBy("g").agg(F.max("id").alias("m"))
    other = spark.newSession()
    assert cache.key(query(spark)) == ResultCache(other, cache.root).key(query(other))
    text, _ = cache._plan(query(spark))
    assert "jvmId" not in text
