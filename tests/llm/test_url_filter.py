from __future__ import annotations

import compare
import pytest
from pyspark.sql import functions as F

from wellops.llm.url_filter import ORACLE_SQL, build, build_shards, contains, judge, marked, op5_url_filter


def test_matches_sql(spark, sf_dir):
    assert compare.differences(op5_url_filter(spark, sf_dir), compare.connect(sf_dir), ORACLE_SQL) == []


def test_main_path_has_no_python(spark, sf_dir):
    plan = op5_url_filter(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan


def test_odd_urls(spark):
    urls = {1: None, 2: "", 3: "no scheme.org/en/1", 4: "http://", 5: "HTTP://A.Example.ORG/en/12?x#y", 6: "x://example.org?/es/",
            7: "s://org/", 8: "s://org", 9: "s://notexample.org/es/1", 10: "a://b://example.org/es/", 11: "s://example.org/ES/",
            12: "s://com/de/", 13: "s://x.y.com/fr/a", 14: "s://com.au/fr/", 15: "s://ÄÖ.org/\n/x", 16: "s://.org/", 17: "s://org./"}
    rows = [(k, u, "<html>", "r") for k, u in urls.items()] + [(7, urls[7], None, None)]
    got = judge(spark.createDataFrame(rows, "page_id long, url string, html string, rule string")).collect()
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert len(got) == len(rows)
    assert found[1] == found[2] == found[3] == found[4] == ("", "", None, "allow")
    assert found[5] == ("a.example.org", "/en/12", "example.org/en/1", "block")
    assert found[6] == ("example.org", "", None, "allow")
    assert found[7] == ("org", "/", "org/", "allow") and found[8] == ("org", "", None, "allow")
    assert found[9][2] == "org/" and found[10] == ("b:", "//example.org/es/", None, "allow") and found[11][2] == "org/"
    assert found[12][2:] == ("com/de/", "block") and found[13][2:] == ("com/fr/", "allow") and found[14][2] is None
    assert found[15] == ("ÄÖ.org", "/\n/x", "org/", "allow") and found[16][2] == "org/" and found[17][2] is None
    empty = judge(spark.createDataFrame([], "page_id long, url string"))
    assert empty.count() == 0


@pytest.mark.parametrize("n,share", [(30_000, 7), (5_000, 2), (400, 1), (50, 60)])
def test_cascade_is_exact(spark, n, share):
    universe = spark.range(n).select(F.concat(F.lit("key "), "id").alias("key"), "id")
    listed = universe.filter(F.col("id") % share == 0).select("key")
    cascade = build(listed.union(listed), universe.select("key").union(universe.limit(3).select(F.lit(None).cast("string"))))
    wrong = universe.filter(contains(cascade, F.col("key")) != (F.col("id") % share == 0))
    assert wrong.count() == 0
    assert spark.range(1).select(contains(cascade, F.lit(None).cast("string")).alias("x")).first()["x"] is False


def test_cascade_limits(spark):
    keys = spark.range(100).select(F.col("id").cast("string").alias("key"))
    assert build(keys.limit(0), keys).levels == ()
    with pytest.raises(ValueError, match="join"):
        build(keys, keys, max_bits=64)


@pytest.mark.parametrize("n,share,max_bits", [(4_000, 3, 1_024), (300, 1, 128)])
def test_long_lists_are_split_and_exact(spark, n, share, max_bits):
    universe = spark.range(n).select(F.concat(F.lit("key "), "id").alias("key"), "id")
    listed = universe.filter(F.col("id") % share == 0).select("key")
    cascades = build_shards(listed, universe.select("key"), max_bits)
    assert len(cascades) > 2 and {c.shard for c in cascades} == set(range(len(cascades)))
    assert max(level.bits for c in cascades for level in c.levels) <= max_bits
    rows = universe.union(spark.createDataFrame([(None, None)], "key string, id long"))
    got = marked(rows, {"listed": F.col("key"), "other": F.lit(None).cast("string")}, cascades)
    assert got.count() == n + 1
    assert got.filter("listed != coalesce(id % {0} = 0, false) or other".format(share)).count() == 0


def test_rules_in_shards_give_the_same_verdicts(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    assert judge(pages, max_bits=63).exceptAll(judge(pages)).count() == 0
    assert build_shards(pages.selectExpr("url as key").limit(0), pages.selectExpr("url as key"))[0].levels == ()
