"""Near-duplicate texts by MinHash with tensored banding.

A table key of ordinary banding takes its own ``rows`` hashes, so 256 tables of 10 rows cost 2,560 hashes.
Here a text has two small collections A and B of ``keys`` half-keys with ``rows`` hashes each; table (i, j)
has the key (A_i, B_j). 16 + 16 half-keys of 5 hashes, 160 in all, give the same 256 tables. Two texts meet
in a table if they agree in some half-key of A and in some of B: at similarity 0.85 one of 16 half-keys
agrees with probability 0.99992, so 0.02 % of such pairs are missed, of pairs at 0.9 practically none. Where hashes are counted, a pair at the limit is dropped with a chance of 1 in 10,000.

1. One pass over the texts: shingle sets, their sizes, fingerprints and half-keys. Equal sets are one class.
2. Half-keys that only one class has are dropped before any two are combined, which loses no pair.
3. In each table group the class that shares most half-keys is the hub, and all others are compared with it: one pair per
   member, not all pairs of a group. Pairs that agree in too few of the hashes are dropped, the others are verified on
   their texts, and the links are joined to components.
4. Components that still meet in some table are gathered, and a gathering is compared once, not table by table. The members
   outside its largest component are compared with all others in blocks of bounded size: first by their hashes, which
   leaves few, then by their full shingle sets, where one matrix product gives the sizes of all intersections of a
   block. What leaves the task is a spanning forest of the components that links join, never the links. So no link is
   lost to the choice of the hub, and no group is expanded into pairs. A gathering that would take more rows than its tables
   have is compared table by table.

Links are confirmed on the full sets of shingles (in step 4 on their 64-bit hashes), not on sketches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellops.llm.common import discard, early_filter, in_worker, scratch, ship, small_batches, stored, table, utf8
from wellops.llm.components import components
from wellops.llm.words import BLANKS, Hasher, mix

_BATCH_BYTES = 1 << 19
_HASHES_AT_ONCE = 1 << 15
_COLUMNS_AT_ONCE = 1 << 11
_BLOCK_BYTES = 4 << 20
_ROWS_A_TABLE_ROW = 1  # a gathering is compared as a whole where that takes at most so many rows for each row of its tables
_TURN = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


@dataclass(frozen=True)
class Settings:
    """``percent``: links have 100 * intersection >= percent * union. ``shingle``: words each."""
    percent: int = 85
    shingle: int = 3
    keys: int = 16
    rows: int = 5
    seed: int = 11
    block: int = 1024

    @property
    def least_equal(self) -> int:
        """Equal hashes that a pair at the limit has but for a chance of 1 in 10,000 (3.7 deviations)."""
        total, p = 2 * self.keys * self.rows, self.percent / 100
        return int(total * p - 3.7 * (total * p * (1 - p)) ** 0.5)


def shingle_sets(hasher: Hasher, texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, without words none."""
    words, counts = hasher(texts)
    sets, start = [], 0
    turns = mix(np.arange(1, width + 1, dtype=np.uint64) * _TURN[0]) | np.uint64(1)
    for n in counts.tolist():
        own, start = words[start:start + n], start + n
        if not n:
            sets.append(own)
            continue
        size = min(n, width)
        total = np.full(n - size + 1, size, np.uint64) * _TURN[1]
        for k in range(size):
            total += own[k:n - size + 1 + k] * turns[k]
        sets.append(np.unique(mix(total)))
    return sets


def _least_hashes(sets: list[np.ndarray], total: int, seed: int) -> np.ndarray:
    """(total, texts): of each hash function its least value over each set; no set may be empty."""
    rng = np.random.default_rng(seed)
    turn = rng.integers(0, 2**32, total, dtype=np.uint32) | np.uint32(1)
    shift = rng.integers(0, 2**32, total, dtype=np.uint32)
    sizes = np.array([len(s) for s in sets])
    least = np.full((total, len(sets)), 2**32 - 1, np.uint32)
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    owner = np.repeat(np.arange(len(sets)), sizes)
    room = np.empty(_HASHES_AT_ONCE, np.uint32)
    for start in range(0, len(flat), _HASHES_AT_ONCE):
        part, whose = flat[start:start + _HASHES_AT_ONCE], owner[start:start + _HASHES_AT_ONCE]
        first = np.flatnonzero(np.diff(whose, prepend=-1))
        names, out = whose[first], room[:len(part)]
        for k in range(total):
            np.multiply(part, turn[k], out=out)
            out += shift[k]
            lows = np.minimum.reduceat(out, first)
            least[k, names] = np.minimum(least[k, names], lows)
    return least


def _half_keys(sets: list[np.ndarray], how: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Half-keys (texts, 2 * keys), and a byte of each of their hashes (texts, 2 * keys * rows)."""
    keys = np.zeros((2 * how.keys, len(sets)), np.uint64)
    least = _least_hashes(sets, 2 * how.keys * how.rows, how.seed)
    grouped = least.reshape(2 * how.keys, how.rows, len(sets)).astype(np.uint64)
    keys += np.arange(2 * how.keys, dtype=np.uint64)[:, None] * _TURN[2]
    for r in range(how.rows):
        keys = mix(keys * _TURN[3] + grouped[:, r])
    return np.ascontiguousarray(keys.T), np.ascontiguousarray((least & 255).astype(np.uint8).T)


def _sketches(docs: DataFrame, how: Settings) -> DataFrame:
    """doc_id, text_hash, n_shingles, cls (16-byte fingerprint of the set, null without words), half (the half-keys) and
    mark (a byte of each hash)."""

    @in_worker("minhash_dedup")
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(BLANKS)
        for batch in batches:
            step = max(1, batch.num_rows * _BATCH_BYTES // max(_BATCH_BYTES, batch.nbytes))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                sets = shingle_sets(hasher, utf8(part.column("text")), how.shingle)
                full = [k for k, s in enumerate(sets) if len(s)]
                halves: list = [None] * len(sets)
                marks: list = [None] * len(sets)
                if full:
                    keys, bytes_ = _half_keys([sets[k] for k in full], how)
                    for k, row, mark in zip(full, keys.view(np.int64), bytes_):
                        halves[k], marks[k] = row, mark.tobytes()
                prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()),
                     pa.array(halves, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                    names=["doc_id", "text_hash", "n_shingles", "cls", "half", "mark"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        sketch, "doc_id long, text_hash long, n_shingles long, cls binary, half array<long>, mark binary")


def _marks(column: pa.Array, count: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(count, -1)


def _likely(pairs: DataFrame, classes: DataFrame, how: Settings) -> DataFrame:
    """The pairs (u, v) that agree in enough hashes."""

    @in_worker("minhash_dedup")
    def agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                equal = (_marks(batch.column("x"), batch.num_rows) == _marks(batch.column("y"), batch.num_rows)).sum(axis=1)
                yield batch.select(["u", "v"]).filter(pa.array(equal >= how.least_equal))

    of = {c: classes.select(F.col("cls").alias(c), F.col("mark").alias(m)) for c, m in (("u", "x"), ("v", "y"))}
    return pairs.join(of["u"], "u").join(of["v"], "v").select("u", "v", "x", "y").mapInArrow(agree, "u binary, v binary")


def _similar(x: bytes, y: bytes, seen: dict[bytes, set], how: Settings) -> bool:
    both = []
    for text in (x, y):
        if text not in seen:
            if len(seen) >= 4:
                seen.clear()
            words = text.lower().split()  # of bytes: splits at blanks of ASCII alone
            size = max(1, min(how.shingle, len(words)))
            seen[text] = {b" ".join(words[k:k + size]) for k in range(len(words) - size + 1)}
        both.append(seen[text])
    shared = len(both[0] & both[1])
    return 100 * shared >= how.percent * (len(both[0]) + len(both[1]) - shared)


def _verified(pairs: DataFrame, texts: DataFrame, how: Settings) -> DataFrame:
    """The pairs (u, v) whose full shingle sets are similar enough."""

    @in_worker("minhash_dedup")
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, set] = {}
        for batch in batches:
            keep = [_similar(x, y, seen, how) for x, y in zip(utf8(batch.column("x")), utf8(batch.column("y")))]
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    of = {c: texts.select(F.col("cls").alias(c), F.col("text").alias(t)) for c, t in (("u", "x"), ("v", "y"))}
    return pairs.join(of["u"], "u").join(of["v"], "v").select("u", "v", "x", "y").mapInArrow(
        verify, "u binary, v binary")


# A row by its id, rows without one last, and a hash of its text. No part is null, so they can be joined.
_ROW = ("no_id", "id", "text_hash")
_JOINED = [*reversed(_ROW)]  # what tells most rows apart comes first, see ``early_filter``


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"no_id": F.col("doc_id").isNull(), "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0))})


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, text) of the classes ``wanted`` (cls, first, n): the text of the first row of each. The list should be stored, and
    the result be written under ``early_filter``: then the other texts are not shuffled. All classes have shingles."""
    rows = _named(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"))
    return rows.join(wanted.filter("n > 0").select("cls", "first.*"), _JOINED).groupBy("cls").agg(F.first("text").alias("text"))


def _sets(texts: DataFrame, how: Settings) -> DataFrame:
    """(cls, shingles): the sorted hashes of each full set, eight bytes each."""

    @in_worker("minhash_dedup")
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(BLANKS)
        for batch in batches:
            step = max(1, batch.num_rows * _BATCH_BYTES // max(_BATCH_BYTES, batch.nbytes))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                sets = shingle_sets(hasher, utf8(part.column("text")), how.shingle)
                yield pa.RecordBatch.from_arrays([part.column("cls"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "shingles"])

    return texts.select("cls", "text").mapInArrow(hashed, "cls binary, shingles binary")


def joined_components(component: list[bytes], sets: list[np.ndarray], percent: int) -> list[tuple[bytes, bytes]]:
    """Pairs of components that links between ``sets`` join, as a spanning forest.

    The sizes of the intersections come from one product of the sets as rows of zeros and ones, taken over a bounded number of
    shingles at a time; shingles of a single set cannot count. Members of the largest component are not compared
    among themselves.
    """
    names, of = np.unique(np.array(component, object), return_inverse=True)
    if len(names) == 1:
        return []
    apart = np.flatnonzero(of != np.bincount(of).argmax())
    sizes = np.array([len(s) for s in sets], np.int64)
    _, column, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, several = np.repeat(np.arange(len(sets)), sizes), holders[column] > 1
    owner, column = owner[several], (np.cumsum(holders > 1) - 1)[column[several]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(apart), len(sets)), np.float32)  # whole numbers below 2**24 are exact
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS_AT_ONCE):
        low, high = np.searchsorted(column, [first, first + _COLUMNS_AT_ONCE])
        rows = np.zeros((len(sets), min(_COLUMNS_AT_ONCE, int(column[-1]) + 1 - first)), np.float32)
        rows[owner[low:high], column[low:high] - first] = 1
        shared += rows[apart] @ rows.T
    union = sizes[apart][:, None] + sizes - shared.astype(np.int64)
    x, y = np.nonzero((100 * shared.astype(np.int64) >= percent * union) & (of[apart][:, None] != of))
    root = list(range(len(names)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    forest = []
    for i, j in np.unique(np.stack([of[apart][x], of[y]], axis=1), axis=0).tolist():
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            forest.append((names[i], names[j]))
    return forest


def _grouped_rows(batches: Iterator[pa.RecordBatch], key: list[str], values: list[str]) -> Iterator[tuple[tuple, list[list]]]:
    """Consecutive rows of equal ``key``, each with its columns ``values`` as lists."""
    name, held = None, [[] for _ in values]
    for batch in batches:
        rows = zip(zip(*(batch.column(c).to_pylist() for c in key)), *(batch.column(c) for c in values))
        for own, *cells in rows:
            if own != name:
                if held[0]:
                    yield name, held
                name, held = own, [[] for _ in values]
            for out, cell in zip(held, cells):
                out.append(cell.as_py())
    if held[0]:
        yield name, held


def _in_component(rows: DataFrame, final: DataFrame, column: str, name: str) -> DataFrame:
    """``rows`` with ``name``, the component of the class in ``column``; a class without links is its own."""
    of = final.select(F.col("node").alias(column), F.col("component").alias(name))
    return rows.join(of, column, "left").withColumn(name, F.coalesce(name, column))


def _measured(members: DataFrame, how: Settings) -> DataFrame:
    """Of each gathering of ``members`` (gathering, cls, component, n): its largest component, the blocks of that (behind) and of
    the other members (before), and the rows that comparing it takes. What fits one block is one block."""

    def blocks(count: Column, size: Column) -> Column:
        return F.greatest(F.ceil(count / how.block), F.ceil(size / _BLOCK_BYTES)).cast("int")

    each = members.groupBy("gathering", "component").agg(F.count(F.lit(1)).alias("k"), (F.sum("n") * 8).alias("bytes"))
    sums = each.groupBy("gathering").agg(F.max(F.struct("k", "bytes", "component")).alias("most"), F.sum("k").alias("k"), F.sum("bytes").alias("bytes"))
    most, k, size = F.col("most.k"), F.col("k"), F.col("bytes")
    one = blocks(k, size) <= 1
    return sums.select("gathering", "k", "most", F.when(one, 0).otherwise(blocks(most, F.col("most.bytes"))).alias("behind"),
                       F.when(one, 1).otherwise(blocks(k - most, size - F.col("most.bytes"))).alias("before")).select(
        "gathering", F.col("most.component").alias("largest"), "before", "behind",
        ((k - most) * (F.col("before") + F.col("behind")) + most * F.col("before")).alias("rows"))


def _gathered(star: DataFrame, groups: DataFrame, sizes: DataFrame, final: DataFrame, how: Settings, folder: str) -> DataFrame:
    """gathering, cls, component and n of the classes (``sizes``: cls, n) that may be linked across the components ``final``.

    Two components are tied if a member of one has the other's hub in a table of ``star`` (cls, hub, tables); all members of a table
    are in components that ties join. Tables of a single component tie nothing.
    """
    spark = groups.sparkSession
    ties = stored(_in_component(_in_component(star, final, "cls", "u"), final, "hub", "v").groupBy("u", "v").agg(
        F.sum("tables").alias("tables")), folder, "ties")
    joined = components(ties.select("u", "v"), f"{folder}/gathering", "step").select(
        F.col("node").alias("component"), F.xxhash64("component").alias("gathering"))
    joined = stored(joined, folder, "gathered")
    discard(spark, folder, "gathering")
    whole = _in_component(sizes.select("cls", "n"), final, "cls", "component").join(joined, "component")
    whole = stored(whole.select("gathering", "cls", "component", "n"), folder, "members")
    tables = ties.withColumnRenamed("v", "component").join(joined, "component").groupBy("gathering").agg(F.sum("tables").alias("tables"))
    costly = stored(_measured(whole, how).join(tables, "gathering").filter(
        (F.col("behind") > 0) & (F.col("rows") > F.col("tables") * _ROWS_A_TABLE_ROW)).select("gathering"), folder, "costly")
    if costly.isEmpty():
        return whole
    members = groups.filter("size > 2").select("cell", "size", "cls").join(
        whole.join(costly, "gathering", "left_semi").drop("gathering"), "cls")
    same = [F.bit_xor(F.xxhash64(F.lit(k), "cls")).alias(f"set_{k}") for k in (0, 1)]
    apart = members.groupBy("cell", "size").agg((F.min("component") < F.max("component")).alias("apart"), *same)
    # Tables with the same members are one group.
    apart = apart.filter("apart").groupBy("size", "set_0", "set_1").agg(F.min("cell").alias("cell")).select("cell")
    by_table = members.join(apart, "cell", "left_semi").select(F.col("cell").alias("gathering"), "cls", "component", "n")
    return whole.join(costly, "gathering", "left_anti").unionByName(by_table)


_BLOCK = ["gathering", "low", "high"]


def _comparable(members: DataFrame, classes: DataFrame, how: Settings) -> DataFrame:
    """gathering, low, high, cls and component of the ``members`` (gathering, cls, component, n) that agree in enough hashes with a
    member of another component, by pair of blocks."""
    schema = pa.schema([("gathering", pa.int64()), ("low", pa.int32()), ("high", pa.int32()), ("cls", pa.binary()), ("component", pa.binary())])

    @in_worker("minhash_dedup")
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (gathering, low, high), (cls, component, mark, block) in _grouped_rows(batches, _BLOCK, ["cls", "component", "mark", "block"]):
            _, of = np.unique(np.array(component, object), return_inverse=True)
            marks = np.frombuffer(b"".join(mark), np.uint8).reshape(len(cls), -1)
            found = np.zeros(len(cls), bool)
            if low == high:
                rows, columns = np.flatnonzero(of != np.bincount(of).argmax()), np.arange(len(cls))
            else:
                rows, columns = (np.flatnonzero(np.array(block) == own) for own in (low, high))
            for start in range(0, len(rows), 64):
                part = rows[start:start + 64]
                near = ((marks[part][:, None] == marks[columns]).sum(axis=2) >= how.least_equal) & (of[part][:, None] != of[columns])
                found[part] |= near.any(axis=1)
                found[columns] |= near.any(axis=0)
            keep = np.flatnonzero(found).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([v] * len(keep), t) for v, t in ((gathering, pa.int64()), (low, pa.int32()), (high, pa.int32()))]
                + [pa.array([c[k] for k in keep], pa.binary()) for c in (cls, component)], schema=schema)

    # The largest component's members meet the blocks of all others, which meet every block; blocks of the
    # largest do not meet each other. Gatherings of one block are not repeated.
    most = (F.col("component") == F.col("largest")) & (F.col("behind") > 0)
    spot = F.xxhash64("cls")
    own = F.when(most, F.col("before") + F.pmod(spot, F.greatest("behind", F.lit(1)))).otherwise(F.pmod(spot, F.greatest("before", F.lit(1))))
    last = F.when(most, F.col("before")).otherwise(F.col("before") + F.col("behind")) - 1
    dealt = members.join(_measured(members, how), "gathering").withColumns(
        {"block": own.cast("int"), "other": F.explode(F.sequence(F.lit(0), last.cast("int")))}).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    return dealt.select(*_BLOCK, "block", "cls", "component").join(classes.select("cls", "mark"), "cls").repartition(
        *_BLOCK).sortWithinPartitions(*_BLOCK).mapInArrow(compare, "gathering long, low int, high int, cls binary, component binary")


def _across(rest: DataFrame, how: Settings) -> DataFrame:
    """Pairs (u, v) of components that links join, within the blocks of ``rest`` (gathering, low, high, component, shingles)."""

    @in_worker("minhash_dedup")
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (component, shingles) in _grouped_rows(batches, _BLOCK, ["component", "shingles"]):
            found = joined_components(component, [np.frombuffer(s, np.uint64) for s in shingles], how.percent)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.binary()) for k in (0, 1)], names=["u", "v"])

    return rest.select(*_BLOCK, "component", "shingles").repartition(*_BLOCK).sortWithinPartitions(*_BLOCK).mapInArrow(
        compare, "u binary, v binary").distinct()


def near_duplicates(docs: DataFrame, how: Settings | None = None, folder: str | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Null, empty and blank texts have no shingles and are linked with nothing. Rows that repeat an id are
    rows of their own and are returned each. A row without an id gets no component (null) and is not kept,
    but counts as text that links others. Other columns are ignored. An empty table gives an empty result.
    """
    return _judged(docs, how, folder).drop("text_hash", "component")


def _judged(docs: DataFrame, how: Settings | None, folder: str | None) -> DataFrame:
    """As ``near_duplicates``, with a hash of the text to tell rows of one id apart, and the component by class."""
    spark, how = docs.sparkSession, how or Settings()
    ship(spark)
    folder = folder or scratch(spark, "minhash_dedup")
    with small_batches(spark):
        rows = stored(_sketches(docs, how), folder, "sketches")
    classes = stored(_named(rows.filter("cls is not null")).groupBy("cls").agg(
        F.min(F.struct(*_ROW)).alias("first"), F.first("n_shingles").alias("n"), F.first("half").alias("half"),
        F.first("mark").alias("mark")), folder, "classes")

    # Half-keys that several classes have; a class needs one of A and one of B to meet anything.
    keys = classes.select("cls", F.explode("half").alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("holders")).filter("holders > 1")
    held = keys.join(shared, "key").groupBy("cls").agg(F.collect_list("key").alias("keys"), F.sum("holders").alias("popular"))
    met = stored(
        held.join(classes, "cls").select(
            "cls", "first", "n", "popular",
            F.array_intersect(F.slice("half", 1, how.keys), "keys").alias("a"),
            F.array_intersect(F.slice("half", how.keys + 1, how.keys), "keys").alias("b"))
        .filter((F.size("a") > 0) & (F.size("b") > 0)), folder, "met")

    # The table of each pair of half-keys, and its group.
    cells = met.select("cls", "n", "popular", "b", F.explode("a").alias("a")).select(
        "cls", "n", "popular", "a", F.explode("b").alias("b")).select("cls", "n", "popular", F.xxhash64("a", "b").alias("cell"))
    hubs = cells.groupBy("cell").agg(F.max(F.struct("popular", "cls", "n")).alias("hub"), F.count(F.lit(1)).alias("size"))
    hubs = hubs.filter("size > 1").select("cell", "size", F.col("hub.cls").alias("hub"), F.col("hub.n").alias("hub_n"))
    groups = stored(cells.select("cell", "cls", "n").join(hubs, "cell"), folder, "groups")
    fits = f"100 * least(n, hub_n) >= {how.percent} * greatest(n, hub_n)"
    star = stored(groups.filter("cls <> hub").groupBy("cls", "hub", "n", "hub_n").agg(F.count(F.lit(1)).alias("tables")), folder, "star")
    pairs = star.filter(fits).select(F.least("cls", "hub").alias("u"), F.greatest("cls", "hub").alias("v")).distinct()
    pairs = stored(_likely(pairs, classes, how), folder, "pairs")

    ends = pairs.select(F.explode(F.array("u", "v")).alias("cls")).distinct()
    wanted = stored(met.join(ends, "cls", "left_semi").select("cls", "first", "n"), folder, "wanted")
    with early_filter(spark):
        texts = stored(_texts(docs, wanted), folder, "texts")
    with small_batches(spark):
        links = stored(_verified(pairs, texts, how), folder, "links")
    final = stored(components(links, folder, "components"), folder, "joined")
    # What the hubs did not join is compared across the components.
    members = _gathered(star, groups, met, final, how, folder)
    rest = stored(_comparable(members, classes, how), folder, "apart")
    if not rest.isEmpty():
        known = stored(rest.select("cls").distinct().join(met.select("cls", "first", "n"), "cls"), folder, "known")
        with small_batches(spark), early_filter(spark):
            sets = stored(_sets(_texts(docs, known), how), folder, "sets")
        with small_batches(spark):
            bridges = stored(_across(rest.join(sets, "cls"), how), folder, "bridges")
        wider = components(bridges, folder, "bridged").select(F.col("node").alias("component"), F.col("component").alias("wider"))
        # A component of one class is not among the nodes joined so far.
        alone = bridges.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(final, "node", "left_anti")
        final = final.unionByName(alone.withColumn("component", F.col("node"))).join(wider, "component", "left").select(
            "node", F.coalesce("wider", "component").alias("component"))

    labelled = classes.select("cls", F.when(~F.col("first.no_id"), F.col("first.id")).alias("first_id")).join(final.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "component", F.coalesce("component", "cls"))
    labelled = stored(labelled, folder, "labelled")
    discard(spark, folder, "classes", "met", "groups", "star", "pairs", "wanted", "texts", "links", "joined", "ties", "gathered",
            "members", "costly", "apart", "known", "sets", "bridges")
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_class = labelled.join(smallest, "component").select("cls", "component", "component_id")
    answer = rows.select("doc_id", "text_hash", "n_shingles", "cls").join(by_class, "cls", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return answer.select("doc_id", "text_hash", "n_shingles", "component", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def _grouped(docs: DataFrame, hows: tuple[Settings, ...]) -> DataFrame:
    """doc_id, text_hash and group of each row of ``docs``: texts that any of ``hows`` links, directly or through
    others, have one group; texts without words have none (null).
    """
    folder = scratch(docs.sparkSession, "minhash_groups")
    parts = []
    for k, how in enumerate(hows):
        judged = _judged(docs, how, f"{folder}/run").select("doc_id", "text_hash", F.col("component").alias("group"))
        parts.append(stored(judged, folder, f"groups-{k}"))
        discard(docs.sparkSession, folder, "run")
    out = parts[0]
    for k, more in enumerate(parts[1:], 1):
        both = out.select("text_hash", "group").distinct().join(
            more.select("text_hash", F.col("group").alias("over")).distinct(), "text_hash")
        both = stored(both.filter("group is not null").select("group", "over").distinct(), folder, f"both-{k}")
        # Only a group of this run that spans several of the earlier ones joins anything.
        spans = both.groupBy("over").agg(F.min("group").alias("v"), F.max("group").alias("last")).filter("v < last")
        links = both.join(spans, "over").filter("group <> v").select(F.col("group").alias("u"), "v").distinct()
        merged = components(links, folder, f"merged-{k}")
        out = stored(out.join(merged.withColumnRenamed("node", "group"), "group", "left").select(
            "doc_id", "text_hash", F.coalesce("component", "group").alias("group")), folder, f"merged-{k}")
    return out


def deduplicated(docs: DataFrame, *hows: Settings, unnamed: bool = False) -> DataFrame:
    """``docs`` with one row of each group of near copies, the one with the smallest doc_id; same columns.

    Texts are near copies if any of ``hows`` (the default settings, if none) says so. Of several texts of the
    smallest id the one with the smallest hash stays. Rows that repeat both id and text stay once. Rows without
    an id go, as they cannot be named, unless ``unnamed``: then they come after all others of their group, so one
    stays where no row with an id is near.
    """
    folder = scratch(docs.sparkSession, "minhash_dedup")
    grouped = _named(_grouped(docs, hows or (Settings(),)))
    rows = _named(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct(*docs.columns).alias("_row")))
    if not unnamed:
        grouped, rows = grouped.filter("not no_id"), rows.filter("not no_id")
    texts = grouped.groupBy(*_ROW).agg(F.count(F.lit(1)).alias("copies"), F.first("group").alias("group"))
    first = texts.filter("group is not null").groupBy("group").agg(F.min(F.struct(*_ROW)).alias("first"))
    first = first.select("first.*", F.lit(True).alias("is_first"))
    judged = texts.join(first, [*_ROW], "left").select(
        *_ROW, "copies", (F.col("group").isNull() | F.col("is_first").isNotNull()).alias("stays"))
    # Texts that go, or that repeat, are fewer than those that stay as they are: their list may be small enough for Spark to send
    # it to the documents, which are then not shuffled.
    other = stored(judged.filter("copies > 1 or not stays").select(*_ROW, "stays", "copies"), folder, "other")
    with early_filter(docs.sparkSession):
        again = rows.join(other.filter("stays and copies > 1"), _JOINED, "left_semi").groupBy(*_ROW).agg(F.first("_row").alias("_row"))
        again = stored(again, folder, "again")
    return rows.join(other, [*_ROW], "left_anti").select("_row.*").union(again.select("_row.*"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
