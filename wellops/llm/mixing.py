"""Mixing sources to target weights by a min-cost flow over membership patterns.

A document may belong to several sources. All documents with the same set of sources form a pattern, and
only one row per pattern (its number of words) is planned with. A flow routes the words of the
patterns to the quotas of the sources: the first use of a pattern's words is free, the second costs 1 a
word, the third 2, so repetition is convex and used only where a quota needs it. The flow of a pattern says
how often all its documents are taken and how many words more come from a seeded selection of them.

The selection is a prefix in the order of a seeded hash. Its end is found by a histogram of the hash (sums per
pattern and bin, combined before the shuffle), then exactly within the one bin where the prefix ends, so no
task sees the documents of a pattern together, and a rerun takes the same documents.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellops.llm.common import scratch, stored, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
MAX_USES = 3
MAX_PATTERNS = 100_000
SEED = 17
_BIN_BITS = 16
_FILLS = 3

# A source without a name is "", any other one "=" and its name.
Pattern = tuple[str, ...]


def encoded(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))


def ordered(sources: set[str]) -> list[str]:
    """By code point, the nameless one last."""
    return sorted(sources, key=lambda s: (s == "", s))


def targets(sizes: dict[str, int], weights: dict[str, float], total: float, max_uses: int = MAX_USES) -> dict[str, float]:
    """Shares of ``total`` by weight; a source stops at ``max_uses`` times its size, the excess goes to the others."""
    fixed: dict[str, float] = {}
    free = set(sizes)
    while free:
        rest, weight = total - sum(fixed.values()), sum(weights[s] for s in free)
        above = {s for s in free if weight <= 0 or rest * weights[s] / weight > max_uses * sizes[s]}
        if not above:
            return fixed | {s: rest * weights[s] / weight for s in free}
        fixed |= {s: float(max_uses * sizes[s]) for s in above}
        free -= above
    return fixed


@dataclass
class _Edge:
    to: int
    room: int
    cost: int
    back: int


class _Network:
    """Successive shortest paths with potentials; all costs start at zero or more."""

    def __init__(self, nodes: int):
        self.out: list[list[_Edge]] = [[] for _ in range(nodes)]

    def edge(self, a: int, b: int, room: int, cost: int = 0) -> _Edge:
        self.out[a].append(_Edge(b, room, cost, len(self.out[b])))
        self.out[b].append(_Edge(a, 0, -cost, len(self.out[a]) - 1))
        return self.out[a][-1]

    def run(self, source: int, sink: int) -> None:
        potential = [0] * len(self.out)
        while True:
            distance: list[float] = [float("inf")] * len(self.out)
            came: list[_Edge | None] = [None] * len(self.out)
            distance[source], heap = 0, [(0, source)]
            while heap:
                d, a = heapq.heappop(heap)
                if d > distance[a]:
                    continue
                for e in self.out[a]:
                    if e.room > 0 and (n := d + e.cost + potential[a] - potential[e.to]) < distance[e.to]:
                        distance[e.to], came[e.to] = n, e
                        heapq.heappush(heap, (n, e.to))
            if distance[sink] == float("inf"):
                return
            reach = distance[sink]
            potential = [p + min(d, reach) for p, d in zip(potential, distance)]
            path, at = [], sink
            while at != source:
                path.append(came[at])
                at = self.out[at][came[at].back].to
            room = min(e.room for e in path)
            for e in path:
                e.room -= room
                self.out[e.to][e.back].room += room


def route(words: dict[Pattern, int], quotas: dict[str, float], max_uses: int = MAX_USES) -> dict[Pattern, dict[str, int]]:
    """Words of each pattern for each of its sources: as much of the quotas as can be met, at least cost.

    Patterns that share no source, directly or through others, are solved apart.
    """
    root: dict[str, str] = {s: s for s in quotas}

    def find(s: str) -> str:
        while root[s] != s:
            root[s] = root[root[s]]
            s = root[s]
        return s

    for pattern in words:
        for s in pattern[1:]:
            root[find(s)] = find(pattern[0])
    parts: dict[str, list[Pattern]] = defaultdict(list)
    for pattern in sorted(words):
        if pattern:
            parts[find(pattern[0])].append(pattern)
    flows: dict[Pattern, dict[str, int]] = {p: {} for p in words}
    for patterns in parts.values():
        sources = ordered({s for p in patterns for s in p})
        if len(patterns) == 1 and len(sources) == 1:
            flows[patterns[0]] = {sources[0]: min(round(quotas[sources[0]]), max_uses * words[patterns[0]])}
            continue
        net = _Network(2 + len(patterns) + len(sources))
        node = {s: 2 + len(patterns) + k for k, s in enumerate(sources)}
        for s in sources:
            net.edge(node[s], 1, round(quotas[s]))
        links = {}
        for k, pattern in enumerate(patterns):
            for use in range(max_uses):
                net.edge(0, 2 + k, words[pattern], use)
            for s in pattern:
                links[pattern, s] = net.edge(2 + k, node[s], max_uses * words[pattern]), max_uses * words[pattern]
        net.run(0, 1)
        for (pattern, s), (edge, room) in links.items():
            flows[pattern][s] = room - edge.room
    return flows


@dataclass(frozen=True)
class Plan:
    """What the mix takes: per pattern the uses of all documents and the end of the seeded selection."""
    takes: DataFrame          # per pattern the uses of all its documents and the end of the selection
    sources: dict[str, tuple[int, float]]  # size and target of each source; empty where they are too many
    flows: dict[Pattern, dict[str, int]]   # of the patterns that the driver planned
    quotas: DataFrame         # size and target of each source, as a table
    tables: _Tables


def sized(docs: DataFrame, members: Column, seed: int = SEED) -> DataFrame:
    """``docs`` with ``_pattern`` (sorted set of encoded sources), ``_size`` (words) and ``_hash``."""
    return docs.withColumns({
        "_pattern": F.array_join(F.array_sort(F.array_distinct(members)), "\x00"),
        "_size": F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long"),
        "_hash": F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))})


def _parsed(pattern: str) -> Pattern:
    return tuple(pattern.split("\x00"))


def _level() -> Column:
    times = F.try_divide(F.col("_size") * 50, F.col("more"))  # null where nothing is selected
    return F.when(times > 1, F.ceil(F.log2(times))).otherwise(0).cast("long")


def _place() -> Column:
    """Where a document stands in the selection of its pattern; needs the column ``more``.

    By the seeded hash (as an unsigned number), but documents that alone are over a fiftieth of the words
    wanted come last, by powers of two. Those exist in small sources only, where they would make the mix
    miss its target.
    """
    return F.struct(_level().alias("level"),
                    F.col("_hash").bitwiseXOR(F.lit(-2**63)).alias("hash"),
                    F.coalesce("doc_id", F.lit(-2**63)).alias("id"))


class _Tables:
    """Tables of one row per pattern, and the documents that meet them.

    At most ``MAX_PATTERNS`` rows are broadcast: a join by pattern would deal a third of all documents to one task. More
    are stored; there the patterns with over a thousandth of the documents, fewer than a thousand, are still broadcast, and
    the documents of the others shuffled.
    """

    def __init__(self, spark: SparkSession, hot: DataFrame | None = None):
        self.spark, self.hot, self.folder, self.n = spark, hot, scratch(spark, "mixing"), 0

    def keep(self, table: DataFrame) -> DataFrame:
        if self.hot is None:
            return F.broadcast(self.spark.createDataFrame(table.collect(), table.schema))
        self.n += 1
        return stored(table, self.folder, f"patterns-{self.n}")

    def meet(self, rows: DataFrame, table: DataFrame, on: tuple[str, ...] = ("_pattern",)) -> DataFrame:
        if self.hot is None:
            return rows.join(F.broadcast(table), list(on))
        hot = F.broadcast(self.hot)
        cold = rows.join(hot, "_pattern", "left_anti").join(table.join(hot, "_pattern", "left_anti"), list(on))
        return rows.join(F.broadcast(table.join(hot, "_pattern", "left_semi")), list(on)).unionByName(cold)


def _shares(flows: dict[Pattern, dict[str, int]], words: dict[Pattern, int], max_uses: int) -> list[tuple[str, int, int]]:
    """Per pattern how often all its documents are taken, and how many words more."""
    out = []
    for pattern, n in words.items():
        flow = sum(flows[pattern].values())
        uses = min(max_uses, flow // n) if n else 1
        out.append(("\x00".join(pattern), int(uses), int(flow - uses * n) if n and uses < max_uses else 0))
    return out


_SHARE = "_pattern string, uses long, more long"


def _few(patterns: DataFrame, rows: list, weights: dict[str, float] | None, total: float | None, max_uses: int) -> Plan:
    """The shares of patterns that fit the driver; ``takes`` is not filled in yet."""
    spark = patterns.sparkSession
    words = {_parsed(r["_pattern"]): r["words"] for r in rows}
    by_source: dict[str, int] = defaultdict(int)
    for pattern, n in words.items():
        for s in pattern:
            by_source[s] += n
    weights = weights or {s: WEIGHTS[k % len(WEIGHTS)] for k, s in enumerate(ordered(set(by_source)))}
    total = sum(words.values()) if total is None else total
    wanted = targets(dict(by_source), weights, total, max_uses)
    flows = route(words, wanted, max_uses)
    tables = _Tables(spark)
    quotas = spark.createDataFrame([(s, n, float(wanted[s])) for s, n in by_source.items()], _QUOTAS)
    share = F.broadcast(spark.createDataFrame(_shares(flows, words, max_uses), _SHARE))
    return Plan(share, {s: (by_source[s], wanted[s]) for s in by_source}, flows, quotas, tables)


_QUOTAS = "source string, source_size long, target double"


def _numbered(sources: DataFrame, tables: _Tables) -> DataFrame:
    """``sources`` with ``number``, their place by code point, the nameless one last. Sorted by ranges; only the number of
    rows of each range reaches the driver."""
    at = tables.keep(sources.orderBy(F.col("source") == "", "source").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    before, offsets = 0, []
    for r in at.groupBy(part.alias("part")).count().orderBy("part").collect():
        offsets.append((r["part"], before))
        before += r["count"]
    offset = F.broadcast(at.sparkSession.createDataFrame(offsets, "part long, offset long"))
    numbered = at.withColumn("part", part).join(offset, "part")
    return numbered.select("source", "source_size", (F.col("offset") + F.col("_at").bitwiseAND(F.lit(2**33 - 1))).alias("number"))


def _many(patterns: DataFrame, weights: dict[str, float] | None, total: float | None, max_uses: int, max_patterns: int) -> Plan:
    """The same for any number of patterns. Sizes, weights and targets are tables; a source that shares no pattern with
    another has its quota as its flow, and the flow network is for the others only."""
    spark = patterns.sparkSession
    all_docs = patterns.agg(F.sum("docs")).first()[0]
    tables = _Tables(spark, patterns.filter(F.col("docs") * 1000 > all_docs).select("_pattern"))
    several = F.col("_pattern").contains("\x00")
    pairs = patterns.select("_pattern", "words", F.explode(F.split("_pattern", "\x00")).alias("source"))
    sources = pairs.groupBy("source").agg(F.sum("words").alias("source_size"))
    if weights is None:
        weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("number") % len(WEIGHTS) + 1).cast("int"))
        weighed = _numbered(sources, tables).withColumn("weight", weight).drop("number")
    else:
        given = spark.createDataFrame([(s, float(w)) for s, w in weights.items()], "source string, weight double")
        missing = F.raise_error(F.concat(F.lit("no weight for source "), F.col("source"))).cast("double")
        weighed = sources.join(given, "source", "left").withColumn("weight", F.coalesce("weight", missing))
    weighed = tables.keep(weighed)
    total = patterns.agg(F.sum("words")).first()[0] if total is None else total
    # The level of targets for a weight of one rises until no further source is above its most.
    most, rest, weight, level, fixed = F.col("source_size") * max_uses, float(total), None, None, -1
    while True:
        above = F.lit(False) if level is None else F.col("weight") * F.lit(level) > most
        n, taken, weight = weighed.agg(F.count_if(above), F.coalesce(F.sum(F.when(above, most)), F.lit(0)),
                                       F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0))).first()
        rest = float(total) - taken
        if n == fixed:
            break
        fixed, level = n, rest / weight if weight > 0 else float("inf")
    target = F.when(above, most.cast("double")).otherwise(F.lit(rest) * F.col("weight") / F.lit(weight or 1.0))
    quotas = tables.keep(weighed.select("source", "source_size", target.alias("target")))

    together = pairs.filter(several).select("source").distinct()
    linked = pairs.join(together, "source", "left_semi").select("_pattern", "words").distinct()
    rows = linked.limit(max_patterns + 1).collect()
    if len(rows) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns of sources that overlap")
    words = {_parsed(r["_pattern"]): r["words"] for r in rows}
    known = {r["source"]: r["target"] for r in quotas.join(together, "source", "left_semi").collect()}
    flows = route(words, known, max_uses)
    flow = F.least(F.rint("target").cast("long"), F.col("words") * max_uses)
    uses = F.when(F.col("words") == 0, F.lit(1)).otherwise(F.least(F.lit(max_uses), F.floor(F.col("flow") / F.greatest("words", F.lit(1)))))
    more = F.when((F.col("words") > 0) & (F.col("uses") < max_uses), F.col("flow") - F.col("uses") * F.col("words")).otherwise(0)
    lone = patterns.join(together.withColumnRenamed("source", "_pattern"), "_pattern", "left_anti").filter(~several).join(
        quotas.withColumnRenamed("source", "_pattern"), "_pattern")
    lone = lone.withColumn("flow", flow).withColumn("uses", uses.cast("long")).select("_pattern", "uses", more.cast("long").alias("more"))
    share = tables.keep(lone.unionByName(spark.createDataFrame(_shares(flows, words, max_uses), _SHARE)))
    return Plan(share, {}, flows, quotas, tables)


def plan(sizes: DataFrame, weights: dict[str, float] | None = None, total: float | None = None,
         max_uses: int = MAX_USES, max_patterns: int = MAX_PATTERNS) -> Plan:
    """The mix of the documents in ``sizes`` (doc_id, _pattern, _size, _hash, as from ``sized``).

    ``weights`` by encoded source; by default 5, 2, 1 in turn, by code point. ``total`` is all words by default.
    Up to ``max_patterns`` patterns are planned on the driver, more by tables, to the same result. Only patterns of
    sources that overlap always need the driver, for their flow; more of those than ``max_patterns`` are an error.
    """
    spark = sizes.sparkSession
    patterns = stored(sizes.groupBy("_pattern").agg(F.sum("_size").alias("words"), F.count(F.lit(1)).alias("docs")),
                      scratch(spark, "mixing"), "patterns")
    rows = patterns.limit(max_patterns + 1).collect()
    mix = (_few(patterns, rows, weights, total, max_uses) if len(rows) <= max_patterns
           else _many(patterns, weights, total, max_uses, max_patterns))
    share, tables = mix.takes, mix.tables
    bin_ = _level() * 2**_BIN_BITS + F.shiftrightunsigned("_hash", 64 - _BIN_BITS)
    binned = tables.meet(sizes, share.filter("more > 0").select("_pattern", "more")).withColumn("bin", bin_)
    upto = Window.partitionBy("_pattern").orderBy("bin")
    last = binned.groupBy("_pattern", "more", "bin").agg(F.sum("_size").alias("words")).withColumn(
        "before", F.sum("words").over(upto) - F.col("words")).filter("more > before and more <= before + words")
    # The documents of the bin where the selection ends, a 65,536th part of the pattern on average.
    last = last.select("_pattern", "bin", "before")
    inside = tables.meet(binned, last, ("_pattern", "bin")).withColumn("place", _place())
    along = Window.partitionBy("_pattern").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    reached = inside.withColumn("reached", F.col("before") + F.sum("_size").over(along))
    within = F.col("reached") <= F.col("more")
    ends = reached.groupBy("_pattern", "more", "bin", "before").agg(
        F.max(F.when(within, F.col("place"))).alias("end"), F.max(F.when(within, F.col("reached"))).alias("got"))
    # Without any document of that bin the selection ends where the bin begins.
    begin = F.struct(F.floor(F.col("bin") / 2**_BIN_BITS).alias("level"),
                     F.shiftleft(F.col("bin") % 2**_BIN_BITS, 64 - _BIN_BITS).bitwiseXOR(F.lit(-2**63)).alias("hash"),
                     F.lit(-2**63).alias("id"))
    ends = ends.select("_pattern", "more", F.coalesce("end", begin).alias("end"),
                       (F.col("more") - F.coalesce("got", "before")).alias("gap"))
    ends = ends.withColumn("fills", F.array().cast(f"array<{ends.schema['end'].dataType.simpleString()}>"))
    ends = tables.keep(ends)
    # A few more documents, of those not selected each time the one nearest to what is missing.
    miss = F.abs(F.col("_size") - F.col("gap"))
    for _ in range(_FILLS):
        fill = tables.meet(sizes, ends).withColumn("place", _place()).filter(
            (F.col("place") > F.col("end")) & ~F.array_contains("fills", F.col("place")) & (miss < F.col("gap"))).groupBy(
            "_pattern").agg(F.min(F.struct(miss.alias("miss"), "place", "_size")).alias("fill"))
        ends = ends.join(fill, "_pattern", "left").select(
            "_pattern", "more", "end", (F.col("gap") - F.coalesce("fill._size", F.lit(0))).alias("gap"),
            F.when(F.col("fill").isNull(), F.col("fills")).otherwise(F.concat("fills", F.array("fill.place"))).alias("fills"))
        ends = tables.keep(ends)
    takes = share.join(ends.select("_pattern", "end", "fills"), "_pattern", "left").select(
        "_pattern", "uses", "more", "end", "fills")
    return replace(mix, takes=tables.keep(takes))


def with_uses(sizes: DataFrame, mix: Plan) -> DataFrame:
    """``sizes`` with ``uses``: how often the mix takes each document."""
    selected = (F.col("_place") <= F.col("end")) | F.array_contains("fills", F.col("_place"))
    joined = mix.tables.meet(sizes, mix.takes.withColumnRenamed("uses", "_uses")).withColumn("_place", _place())
    uses = F.col("_uses") + F.coalesce(selected, F.lit(False)).cast("long")
    return joined.withColumn("uses", uses).drop("_uses", "more", "_place", "end", "fills")


def mixed(docs: DataFrame, members: Column | None = None) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with the same columns.

    ``members``: array of the encoded sources of a row, by default its column ``source``. A null text has no
    words. Documents without words are taken as often as the rest of their pattern at least. Rows that are equal in id and text
    are taken alike. An empty table stays empty.
    """
    members = F.array(encoded(F.col("source"))) if members is None else members
    columns = docs.columns
    rows = sized(docs.select(F.struct(*columns).alias("_row"), "doc_id", "text", members.alias("_members")),
                 F.col("_members"))
    sizes = stored(rows.select("doc_id", "_pattern", "_size", "_hash"), scratch(docs.sparkSession, "mixing"), "sizes")
    taken = with_uses(rows, plan(sizes))
    return taken.withColumn("_use", F.explode(F.sequence(F.lit(1), F.col("uses")))).filter("uses > 0").select("_row.*")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    rows = sized(docs, F.array(encoded(F.col("source")))).select("doc_id", "_pattern", "_size", "_hash")
    sizes = stored(rows, scratch(spark, "mixing"), "sizes")
    mix = plan(sizes)
    return mix.tables.meet(with_uses(sizes, mix), mix.quotas.withColumnRenamed("source", "_pattern")).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target",
        (F.col("uses") * F.col("_size")).alias("taken"))
