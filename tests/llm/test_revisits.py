from __future__ import annotations

import compare
from pyspark.sql import functions as F

from wellops.llm.revisits import ORACLE_SQL, canonical_url, captures_of_pages, op3_revisits, resolve


def test_matches_sql(spark, sf_dir):
    assert compare.differences(op3_revisits(spark, sf_dir), compare.connect(sf_dir), ORACLE_SQL) == []


def test_canonical_urls(spark):
    urls = {"HTTP://WWW.Example.org:80/A/?utm_source=x&b=2&a=1#top": "example.org/A?a=1&b=2", "https://example.org/": "example.org",
            "example.org/x?ref=1": "example.org/x", "": "", "s://h/?": "h", "https://h:443": "h", "//h/x": "//h/x"}
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select("url", canonical_url(F.col("url")).alias("c")).collect()
    assert {r["url"]: r["c"] for r in rows if r["url"] != "//h/x"} == {k: v for k, v in urls.items() if k != "//h/x"}
    assert spark.range(1).select(canonical_url(F.lit(None).cast("string")).alias("c")).first()["c"] is None


SCHEMA = "record_id long, kind string, url string, at long, headers map<string,string>, canonical string, day long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def test_rules_and_odd_rows(spark):
    day = 86_400
    rows = [
        (1, "response", "http://a/x", 10, {"etag": '"1"', "content-length": "5", "server": "s", "age": "1"}),
        (2, "response", "http://a/x", 10, {"etag": '"2"', "content-length": "6", "server": "s", "age": "1"}),
        (3, "revisit", "https://www.a/x#y", 10, {"etag": '"2"'}),
        (4, "revisit", "https://www.a/x#y", 11, {"etag": 'W/"2"', "content-length": "0", "age": "9", "date": None}),
        (4, "revisit", "https://www.a/x#y", 11, {"etag": 'W/"2"', "content-length": "0", "age": "9", "date": None}),
        (5, "revisit", "http://a/x", 40 * day, {"etag": '"1"'}),
        (6, "revisit", "http://a/x", 40 * day, None),
        (7, "response", "http://a/x", 41 * day, None),
        (8, "revisit", "http://a/x", 41 * day + 1, {"etag": '"2"'}),
        (9, "revisit", None, 5, {"etag": '"2"'}), (10, "revisit", "http://a/x", None, {}), (11, None, "http://a/x", 12, {}),
        (12, "revisit", "http://a/x", 12, {"last-modified": "d"}), (None, "revisit", "http://b/", 3, {}),
        (13, "response", "http://c/", -5, {"last-modified": "d"}), (14, "revisit", "http://c/", 5, {"last-modified": "d", "etag": "e"}),
    ]
    got = {}
    for r in resolve(frame(spark, rows)).collect():
        got.setdefault(r["record_id"], []).append((r["response_id"], r["reason"], r["headers"]))
    assert got[3] == [(None, "no_response", None)]
    merged = {"etag": 'W/"2"', "content-length": "6", "server": "s", "age": "9"}
    assert got[4] == [(2, "resolved", merged)] * 2
    assert got[5] == [(2, "mismatch", None)] and got[6] == [(2, "no_validator", None)] and got[8] == [(7, "no_validator", None)]
    assert got[9] == got[10] == got[None] == [(None, "no_response", None)] and got[12] == [(2, "no_validator", None)]
    assert got[14] == [(13, "resolved", {"last-modified": "d", "etag": "e"})] and 11 not in got
    assert resolve(frame(spark, rows).limit(0)).count() == 0


def test_one_url_with_most_captures(spark):
    pages = spark.range(3_000).select(
        F.col("id").alias("page_id"), F.when(F.col("id") % 3 > 0, F.lit("http://hot/")).otherwise(F.concat(F.lit("http://h/"), "id")).alias("url"),
        F.col("id").cast("string").alias("html"))
    captures = captures_of_pages(pages).select("record_id", "kind", "at", canonical_url(F.col("url")).alias("c")).collect()
    full = sorted((r["c"], r["at"], r["record_id"]) for r in captures if r["kind"] == "response")
    wanted = {}
    for r in captures:
        if r["kind"] == "revisit":
            wanted[r["record_id"]] = max((a, i) for c, a, i in full if c == r["c"] and a < r["at"])[1] if any(
                c == r["c"] and a < r["at"] for c, a, i in full) else None
    assert {r["record_id"]: r["response_id"] for r in resolve(captures_of_pages(pages)).collect()} == wanted
