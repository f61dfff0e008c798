"""URL rules by a cascade of Bloom filters: exact membership of keys without joining the list.

The first filter holds the listed keys. Of the corpus's complete universe of keys some unlisted ones pass
it by chance: the second filter holds those. Listed keys that pass the second go into the third, and so on
in turn until nothing passes by mistake. A key is listed if the first filter it does not pass has an
even number (counted from one); over the universe the cascade was built for the answer is exact.

A cascade needs about 1.5 log2(universe / listed) bits a listed key, so it is small next to the list and far
smaller than the corpus. Everything runs as column expressions; nothing but the bits passes the driver. A list whose
bits would be too many for one task is split by a hash of the key into cascades that are asked one after the other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellops.llm.common import discard, scratch, stored, table

MAX_BITS = 1 << 26
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: (host, path prefix, verdict)
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
DEFAULT = "allow"


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: tuple[int, ...]


@dataclass(frozen=True)
class Cascade:
    """``levels`` answer for the keys of one of ``shards`` shards."""
    levels: tuple[Level, ...]
    shard: int = 0
    shards: int = 1


def _positions(key: Column, number: int, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(number * 1000 + k)), F.lit(bits)) for k in range(hashes)]


def _words(level: Level) -> Column:
    """The bits as a constant: a literal while they are few, else a table of one row read as a scalar."""
    if len(level.words) <= 64:
        return F.array(*[F.lit(w).cast("long") for w in level.words])
    return SparkSession.active().createDataFrame([(list(level.words),)], "words array<long>").scalar()


def _passes(key: Column, number: int, level: Level) -> Column:
    words = _words(level)
    out = F.lit(True)
    for place in _positions(key, number, level.bits, level.hashes):
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        out = out & (F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1)
    return out


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(shards))


def contains(cascade: Cascade, key: Column) -> Column:
    """Whether ``key`` is listed; exact for keys of the universe, false for null and for keys of other shards."""
    answer = F.lit(len(cascade.levels) % 2 == 1)
    for number in range(len(cascade.levels) - 1, -1, -1):
        answer = F.when(_passes(key, number, cascade.levels[number]), answer).otherwise(F.lit(number % 2 == 1))
    here = key.isNotNull() if cascade.shards == 1 else _shard(key, cascade.shards) == cascade.shard
    return F.coalesce(key.isNotNull() & here & answer, F.lit(False))


def marked(rows: DataFrame, keys: dict[str, Column], cascades: list[Cascade]) -> DataFrame:
    """``rows`` with a boolean column per name of ``keys``: whether that key is listed.

    One cascade is column expressions only. Of several each is a pass of its own that ends in a written table, so
    a task holds the bits of one.
    """
    folder = scratch(rows.sparkSession, "cascade_marks") if len(cascades) > 1 else ""
    for k, cascade in enumerate(cascades):
        rows = rows.withColumns({name: contains(cascade, key) | F.col(name) if k else contains(cascade, key)
                                 for name, key in keys.items()})
        if folder:
            rows = stored(rows, folder, f"shard-{k}")
            if k:
                discard(rows.sparkSession, folder, f"shard-{k - 1}")
    return rows


def _rate(n: int, other: int) -> float:
    """So sharp a first filter that about as many keys pass it by chance as are listed."""
    return min(0.5, n / (math.sqrt(2) * other)) if other else 0.5


def _bits(n: int, rate: float) -> int:
    return max(64, 64 * math.ceil(-n * math.log(rate) / math.log(2) ** 2 / 64))


def _level(keys: DataFrame, n: int, rate: float, number: int, max_bits: int | None) -> Level:
    bits = _bits(n, rate)
    if max_bits is not None and bits > max_bits:
        raise ValueError(f"{n} keys need {bits} bits, over {max_bits}; filter such a list by build_shards, or by a join")
    hashes = max(1, round(bits / n * math.log(2))) if n < bits else 1
    hashes = min(hashes, max(1, math.ceil(-math.log2(rate))))
    places = keys.select(F.explode(F.array(*_positions(F.col("key"), number, bits, hashes))).alias("place"))
    rows = places.groupBy(F.shiftright("place", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("value")).collect()
    words = [0] * (bits // 64)
    for r in rows:
        words[r["word"]] = r["value"]
    return Level(bits, hashes, tuple(words))


def _distinct(listed: DataFrame, universe: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """The listed keys, and those of the universe that are not."""
    inside = stored(listed.select("key").filter("key is not null").distinct(), folder, "listed")
    outside = universe.select("key").filter("key is not null").distinct().join(inside, "key", "left_anti")
    return inside, stored(outside, folder, "unlisted")


def build_shards(listed: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS) -> list[Cascade]:
    """The cascades of a list of any length: one while its first filter is within ``max_bits``, else one per shard of the keys,
    each about half of that."""
    folder = scratch(listed.sparkSession, "cascade")
    inside, outside = _distinct(listed, universe, folder)
    n = inside.count()
    bits = _bits(n, _rate(n, outside.count())) if n else 0
    shards = 1 if bits <= max_bits else math.ceil(2 * bits / max_bits)
    if shards == 1:
        return [Cascade(_levels(inside, outside, folder, None))]
    own = [F.col("key").isNotNull() & (_shard(F.col("key"), shards) == k) for k in range(shards)]
    return [Cascade(_levels(inside.filter(own[k]), outside.filter(own[k]), f"{folder}/{k}", None), k, shards) for k in range(shards)]


def build(listed: DataFrame, universe: DataFrame, max_bits: int = MAX_BITS) -> Cascade:
    """The cascade of the keys ``listed`` (key) within ``universe`` (key, all keys that will be asked).

    Null keys count as none; repeated ones once. Neither table needs to be inside the other. A list whose
    first filter would be over ``max_bits`` is refused, as the bits are part of every task; ``build_shards`` splits it.
    """
    folder = scratch(listed.sparkSession, "cascade")
    return Cascade(_levels(*_distinct(listed, universe, folder), folder, max_bits))


def _levels(inside: DataFrame, outside: DataFrame, folder: str, max_bits: int | None) -> tuple[Level, ...]:
    n, other = inside.count(), outside.count()
    levels: list[Level] = []
    while n:
        rate = 0.5 if levels else _rate(n, other)
        number = len(levels)
        levels.append(_level(inside, n, rate, number, max_bits))
        passing = stored(outside.filter(_passes(F.col("key"), number, levels[-1])), folder, f"passing-{number}")
        inside, outside, n = passing, inside, passing.count()
    return tuple(levels)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    host = F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> list[Column]:
    """Keys of a URL that a rule could be: for each (labels, characters) the end of the host and start of the path.

    Null where the host has fewer labels or the path fewer characters.
    """
    out = []
    for labels, characters in shapes:
        end = F.substring_index(host, ".", -labels)
        enough = (F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) >= labels - 1) & (
            F.length(path) >= characters) & (host != "")
        out.append(F.when(enough, F.concat(end, F.substring(path, 1, characters))))
    return out


def judge(pages: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, default: str = DEFAULT,
          max_bits: int = MAX_BITS) -> DataFrame:
    """``pages`` (page_id, url) as page_id, host, path, rule, verdict.

    A rule fits its host and all subdomains if the path starts with the rule's; of several the longest wins,
    at equal length the one with the longer host. Where none fits, the rule is null and the verdict ``default``:
    the cascade has found none of the URL's keys in the list. Repeated rows are judged each, an empty
    table gives none, other columns are ignored. A URL of any length is read whole, a null one has neither host nor path.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    shapes = sorted({(h.count(".") + 1, len(p)) for h, p, _ in rules})
    keys = candidates(F.col("host"), F.col("path"), shapes)
    universe = stored(urls.select(F.explode(F.array(*keys)).alias("key")).filter("key is not null").distinct(),
                      scratch(spark, "url_keys"), "universe")
    found, marks = [], urls
    for v, verdict in enumerate(sorted({v for _, _, v in rules})):
        listed = spark.createDataFrame([(h + p,) for h, p, v in rules if v == verdict], "key string")
        named = {f"_listed_{v}_{k}": key for k, key in enumerate(keys)}
        marks = marked(marks, named, build_shards(listed, universe, max_bits))
        found += [F.when(F.col(f"_listed_{v}_{k}"), F.struct(
            F.length(key).alias("size"), (F.length(key) - characters).alias("host_size"), key.alias("rule"),
            F.lit(verdict).alias("verdict"))) for k, (key, (_, characters)) in enumerate(zip(keys, shapes))]
    best = marks.withColumn("_best", F.array_max(F.array(*found)))
    return best.select("page_id", "host", "path", F.col("_best.rule").alias("rule"),
                       F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"))


ORACLE_SQL = r"""
WITH parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(h, p, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                                ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT *, CASE r WHEN 1 THEN 'example.org/en/1' WHEN 2 THEN 'example.org/es/' WHEN 3 THEN 'org/'
                   WHEN 4 THEN 'com/fr/' WHEN 5 THEN 'com/de/' END AS rule
  FROM (SELECT *, CASE
          WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 1
          WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 2
          WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 3
          WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 4
          WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 5 END AS r
        FROM parts))
SELECT page_id, host, path, fits.rule AS rule, coalesce(rules.verdict, 'allow') AS verdict
FROM fits LEFT JOIN rules ON rules.h || rules.p = fits.rule
"""
