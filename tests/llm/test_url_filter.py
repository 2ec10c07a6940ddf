"""Rules, and the cascade against plain membership."""

import time

import pytest
from pyspark.sql import functions as F

from compare import assert_same, duck
from soleprint.llm import url_filter
from soleprint.llm.catalog import QUERIES
from soleprint.llm.oracles import ORACLES


def test_equals_sql(spark, sf_dir):
    sql = duck(sf_dir).execute(ORACLES["op6_url_cascade"]).df()
    assert set(sql["verdict"]) == {"allow", "block"} and sql["rule"].notna().any()
    assert_same(QUERIES["op6_url_cascade"](spark, sf_dir).toPandas(), sql)


@pytest.mark.parametrize(("url", "host", "path"), [
    ("http://A.Example.ORG/es/1?q=/x#y", "a.example.org", "/es/1"),
    ("x://h?q://z/", "h", ""), ("x://h#f/", "h", ""), ("no scheme/path", "", ""), (None, "", ""),
    ("", "", ""), ("://", "", ""), ("a://b://c/d", "b:", "//c/d"), ("s://É.com/Ä", "É.com", "/Ä"),
])
def test_parts(spark, url, host, path):
    rows = spark.createDataFrame([(url,)], "url string")
    assert tuple(rows.select(*url_filter.host_and_path(F.col("url"))).first()) == (host, path)


@pytest.mark.parametrize(("url", "rule", "verdict"), [
    ("http://example.org/es/x", "example.org/es/", "block"),
    ("http://a.b.example.org/en/19", "example.org/en/1", "block"),
    ("http://example.org/en/2", "org/", "allow"), ("http://notexample.org/es/", "org/", "allow"),
    ("http://org/x", "org/", "allow"), ("http://a.org", None, "allow"),
    ("http://a.com/de/", "com/de/", "block"), ("http://a.com/en/", None, "allow"),
    ("http://xcom/de/", None, "allow"),
])
def test_rules(spark, url, rule, verdict):
    pages = spark.createDataFrame([(1, url)], "page_id long, url string")
    row = url_filter.judge_urls(pages, spark.createDataFrame([], "key string")).first()
    assert (row["rule"], row["verdict"]) == (rule, verdict)


def test_cascade_is_exact_in_shards(spark):
    universe = spark.range(30_000).select(
        F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 3 == 0).alias("listed"))
    rows = universe.select("key", F.col("listed").alias("truth"))
    for shard_bytes in (8 << 20, 8_000):
        got = url_filter.mark_listed(rows, "key", universe, shard_bytes)
        assert got.count() == 30_000 and got.where("truth <> listed").count() == 0
    assert url_filter.shard_count(10_000, 8_000) == 3


@pytest.mark.parametrize("listed", [0, 1, 200])
def test_lists_of_all_sizes(spark, listed):
    universe = spark.range(200).select(
        F.col("id").cast("string").alias("key"), (F.col("id") < listed).alias("listed"))
    got = url_filter.mark_listed(universe.select("key"), "key", universe)
    assert got.where("listed").count() == listed


def test_repeats_extra_columns_and_empty_table(spark):
    pages = spark.createDataFrame(
        [(1, "http://h/x", "v", "r"), (1, "http://h/x", "v", "r"), (None, None, None, None)],
        "page_id long, url string, verdict string, key string")
    listed = spark.createDataFrame([("h/x",), ("gone/",), (None,)], "key string")
    got = url_filter.judge_urls(pages, listed)
    assert sorted(r["verdict"] for r in got.collect()) == ["allow", "block", "block"]
    assert url_filter.judge_urls(pages.limit(0), listed).count() == 0


def test_large_level_is_ready_in_seconds(spark):
    words = [(i * 0x9E3779B97F4A7C15 + 1 << 1 & (1 << 64) - 1) - (1 << 63) for i in range(300_000)]
    level = url_filter.Level(1, 1, words)
    keys = spark.range(2000).select(F.col("id").cast("string").alias("key"))
    bit = url_filter.bit_positions(F.col("key"), 1, 1, 64 * len(words))[0]
    start = time.monotonic()
    got = keys.select(level.holds(F.col("key")).alias("holds"), bit.alias("bit")).collect()
    assert time.monotonic() - start < 60
    assert all(r["holds"] == bool(words[r["bit"] >> 6] >> (r["bit"] & 63) & 1) for r in got)
