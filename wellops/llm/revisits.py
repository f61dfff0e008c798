"""Resolution of not-modified revisits in web archives: which earlier full response a record stands for.

A revisit record of a server that answered "not modified" holds headers only. It is joined as of its date
to the latest earlier full response of the same canonical URL. The validators decide whether that response
is what the server meant: a strong or weak entity tag if the revisit has one, else the date of the last
modification. Headers are merged as a cache does on such an answer: those of the revisit replace those of the response,
but for the ones that describe the stored body.

The as-of join goes in two steps, within (URL, day) and over one row per day of a URL, so a URL with very
many captures is spread over as many tasks as it has days, and no step is wider than the captures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellops.llm.common import table

# Headers of a stored body that a not-modified answer must not replace (RFC 9111, 3.2).
BODY_HEADERS = ("connection", "content-encoding", "content-length", "content-range", "content-type", "proxy-authenticate",
                "proxy-authentication-info", "proxy-authorization", "transfer-encoding")
# Query parameters that do not select content.
_TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
RESPONSE, REVISIT = "response", "revisit"
_DAY = 86_400


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, ``www.``, default port, fragment, tracking parameters, or a final slash.

    The host is lower-cased and remaining parameters are sorted. Null stays null.
    """
    host = F.lower(F.regexp_extract(url, r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*([^?#]*)", 1), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(_TRACKING))), "&")
    return F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))


def _opaque(tag: Column) -> Column:
    """An entity tag for the weak comparison that not-modified answers use."""
    return F.regexp_replace(F.trim(tag), r"^W/", "")


def resolve(captures: DataFrame) -> DataFrame:
    """One row per revisit of ``captures`` (record_id, kind, url, at, headers): record_id, canonical, response_id,
    reason and headers.

    ``kind`` is ``response`` or ``revisit``, ``at`` seconds, ``headers`` a map with names in lower case.
    ``reason`` is ``resolved`` (only then headers are merged and response_id is the one that serves),
    ``mismatch`` (the latest earlier response has other validators; response_id names it), ``no_validator``
    (the two share none) or ``no_response``. A response at the same second is not earlier; of several at one
    second the highest record_id counts. A null URL, time or kind resolves nothing; null headers are none. Repeated
    rows are resolved each; other columns are ignored; an empty table gives none.
    """
    rows = captures.select("record_id", "kind", canonical_url(F.col("url")).alias("canonical"),
                           F.col("at").cast("long").alias("at"),
                           F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"))
    usable = rows.filter("canonical is not null and at is not null").withColumn("day", F.floor(F.col("at") / _DAY))
    is_response = F.col("kind") == RESPONSE
    # Records of the same second after its responses, which then must not see them: the range ends a second before.
    within = Window.partitionBy("canonical", "day").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    seen = usable.withColumn("today", F.max(F.when(is_response, F.struct("at", "record_id"))).over(within))
    days = usable.filter(is_response).groupBy("canonical", "day").agg(F.max(F.struct("at", "record_id")).alias("last"))
    marks = usable.select("canonical", "day").distinct().join(days, ["canonical", "day"], "left")
    before = Window.partitionBy("canonical").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.select("canonical", "day", F.last("last", ignorenulls=True).over(before).alias("earlier"))
    revisits = seen.filter(F.col("kind") == REVISIT).join(marks, ["canonical", "day"]).withColumn(
        "found", F.coalesce("today", "earlier"))
    # By the record found, not by URL: only one response meets a revisit, however many captures a URL has.
    stored = usable.filter(is_response).select(
        F.col("record_id").alias("r_id"), F.col("at").alias("r_at"), F.col("canonical").alias("r_canonical"),
        F.col("headers").alias("r_headers")).dropDuplicates(["r_id", "r_at", "r_canonical"])
    met = revisits.select("record_id", "canonical", "headers", "found").join(
        stored, F.expr("found.record_id = r_id and found.at = r_at and canonical = r_canonical"), "left")
    unusable = rows.filter((F.col("kind") == REVISIT) & (F.col("canonical").isNull() | F.col("at").isNull()))
    met = met.select("record_id", "canonical", "headers", "r_id", "r_headers").union(unusable.select(
        "record_id", "canonical", "headers", F.lit(None).cast("long"), F.lit(None).cast("map<string,string>")))

    def both(name: str) -> Column:
        return F.col("headers")[name].isNotNull() & F.col("r_headers")[name].isNotNull()

    same = F.when(both("etag"), _opaque(F.col("headers")["etag"]) == _opaque(F.col("r_headers")["etag"])).when(
        both("last-modified"), F.col("headers")["last-modified"] == F.col("r_headers")["last-modified"])
    reason = (F.when(F.col("r_id").isNull(), "no_response").when(same.isNull(), "no_validator")
              .when(same, "resolved").otherwise("mismatch"))
    fresh = F.map_filter("headers", lambda k, v: ~k.isin(*BODY_HEADERS) & v.isNotNull())
    old = F.map_filter("r_headers", lambda k, v: ~F.map_contains_key(fresh, k))
    return met.select("record_id", "canonical", F.col("r_id").alias("response_id"), reason.alias("reason"),
                      F.when(reason == "resolved", F.map_concat(old, fresh)).alias("headers"))


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Captures derived from every row of ``pages`` (page_id, url, html) by rule.

    Each page is a full response with an entity tag and a date. Each also gives a revisit at a later time,
    under another spelling of its URL: most repeat the tag (some weakly), some have the date alone, a changed
    tag, or no validator. Payloads stay where they are; a response is named by its record_id, 2 * page_id.
    """
    page = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    day = F.concat(F.lit("day "), page % 1000)
    at = page % 977 * 43_200 + page % 13
    size = F.length(F.coalesce("html", F.lit(""))).cast("string")
    response = pages.select(
        (page * 2).alias("record_id"), F.lit(RESPONSE).alias("kind"), "url", at.alias("at"),
        F.create_map(F.lit("etag"), tag, F.lit("last-modified"), day, F.lit("content-length"), size,
                     F.lit("server"), F.lit("a")).alias("headers"))
    sent = (F.when(page % 11 == 0, F.create_map(F.lit("etag"), F.lit('"changed"'), F.lit("server"), F.lit("b")))
            .when(page % 7 == 0, F.create_map(F.lit("last-modified"), day, F.lit("date"), F.lit("later")))
            .when(page % 5 == 0, F.create_map(F.lit("date"), F.lit("later"), F.lit("server"), F.lit("b")))
            .when(page % 3 == 0, F.create_map(F.lit("etag"), F.concat(F.lit("W/"), tag), F.lit("content-length"), F.lit("0"),
                                              F.lit("date"), F.lit("later")))
            .otherwise(F.create_map(F.lit("etag"), tag, F.lit("server"), F.lit("b"))))
    again = F.concat(F.regexp_replace("url", "#.*$", ""), F.when(page % 2 == 0, F.lit("#again")).otherwise(F.lit("")))
    revisit = pages.select((page * 2 + 1).alias("record_id"), F.lit(REVISIT).alias("kind"), again.alias("url"),
                           (at + page % 29 * 7_200).alias("at"), sent.alias("headers"))
    return response.union(revisit)


def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolve(captures_of_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html")))
    lines = F.array_join(F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws(": ", e["key"], e["value"]))), "\n")
    return found.withColumn("headers", lines)


ORACLE_SQL = r"""
WITH page AS (
  SELECT page_id, url, '"' || md5(coalesce(html, '')) || '"' AS tag, 'day ' || (page_id % 1000) AS day,
         page_id % 977 * 43200 + page_id % 13 AS sec, length(coalesce(html, ''))::VARCHAR AS size FROM pages),
capture AS (
  SELECT page_id * 2 AS record_id, true AS full_, url, sec, tag AS etag, day AS modified, size AS length_, 'a' AS server,
         NULL::VARCHAR AS date_ FROM page
  UNION ALL
  SELECT page_id * 2 + 1, false, regexp_replace(url, '#.*$', '') || CASE WHEN page_id % 2 = 0 THEN '#again' ELSE '' END,
         sec + page_id % 29 * 7200,
         CASE WHEN page_id % 11 = 0 THEN '"changed"' WHEN page_id % 7 = 0 OR page_id % 5 = 0 THEN NULL
              WHEN page_id % 3 = 0 THEN 'W/' || tag ELSE tag END,
         CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 7 = 0 THEN day END,
         CASE WHEN page_id % 11 = 0 OR page_id % 7 = 0 OR page_id % 5 = 0 THEN NULL WHEN page_id % 3 = 0 THEN '0' END,
         CASE WHEN page_id % 11 = 0 THEN 'b' WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 0 THEN 'b'
              WHEN page_id % 3 = 0 THEN NULL ELSE 'b' END,
         CASE WHEN page_id % 11 = 0 THEN NULL WHEN page_id % 7 = 0 OR page_id % 5 = 0 OR page_id % 3 = 0 THEN 'later' END
  FROM page),
keyed AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(url, '(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)', 1)),
                                          ':(80|443)$', ''), '^www\.', '')
         || regexp_replace(regexp_extract(url, '(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*([^?#]*)', 1), '/+$', '')
         || CASE WHEN params = '' THEN '' ELSE '?' || params END AS canonical
  FROM (SELECT *, coalesce(array_to_string(list_sort(list_filter(
            string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&'),
            lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))), '&'), '') AS params FROM capture)),
latest AS (SELECT canonical, sec, max(record_id) AS record_id FROM keyed WHERE full_ GROUP BY ALL),
found AS (
  SELECT v.*, r.record_id AS r_id FROM (SELECT * FROM keyed WHERE NOT full_) v
  ASOF LEFT JOIN latest r ON v.canonical = r.canonical AND v.sec > r.sec),
met AS (
  SELECT f.*, r.etag AS r_etag, r.modified AS r_modified, r.length_ AS r_length, r.server AS r_server,
         CASE WHEN f.r_id IS NULL THEN 'no_response'
              WHEN f.etag IS NOT NULL THEN CASE WHEN regexp_replace(f.etag, '^W/', '') = r.etag THEN 'resolved' ELSE 'mismatch' END
              WHEN f.modified IS NOT NULL THEN CASE WHEN f.modified = r.modified THEN 'resolved' ELSE 'mismatch' END
              ELSE 'no_validator' END AS reason
  FROM found f LEFT JOIN keyed r ON f.r_id = r.record_id)
SELECT record_id, canonical, r_id AS response_id, reason,
       CASE WHEN reason = 'resolved' THEN concat_ws(chr(10), 'content-length: ' || r_length, 'date: ' || date_,
            'etag: ' || coalesce(etag, r_etag), 'last-modified: ' || coalesce(modified, r_modified),
            'server: ' || coalesce(server, r_server)) END AS headers
FROM met
"""
