"""Benchmark decontamination by suffix arrays over the training texts.

Each task takes its texts in shards of about a megabyte, builds the suffix array of a shard at word level and
searches it for every suffix of every benchmark item by bisection. The interval found for a suffix
holds all places where its first ``window`` words occur; neighbouring places on one diagonal join to the
longest verbatim match. Texts are never moved: a document is whole in one shard, so its answer is final there.

Words outside the benchmark's vocabulary end any match. Suffixes that reach such a word before the shortest
window is complete cannot match and are left out of the array before it is sorted.

The benchmark is handed to the tasks in blocks of bounded size. More blocks are more steps of the same pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellops.llm.common import in_worker, ship, table, unused, utf8
from wellops.llm.words import NOT_ALPHANUMERIC, Hasher

WINDOW = 10
BLOCK_BYTES = 8 << 20
_SHARD_BYTES = 1 << 20

_STATE = ("struct<n_words:bigint,n_hit:bigint,runs:array<bigint>,items:array<string>,"
          "longest:bigint,longest_item:string,longest_at:bigint>")


@dataclass(frozen=True)
class Index:
    """One block of the benchmark: items as numbers of their words, laid end to end with a zero after each."""
    names: list[str]
    vocabulary: np.ndarray
    sequence: np.ndarray
    owner: np.ndarray     # item of each place of the sequence
    starts: np.ndarray    # places where a window begins
    depths: np.ndarray    # words of that window
    bits: int

    @property
    def per_key(self) -> int:
        return 62 // self.bits


def build_index(items: list[tuple[str, bytes]], window: int = WINDOW) -> Index:
    hashes, counts = Hasher(NOT_ALPHANUMERIC)([text for _, text in items])
    vocabulary = np.unique(hashes)
    ends = np.cumsum(counts + 1)
    sequence = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
    owner = np.repeat(np.arange(len(items)), counts + 1)
    words = np.ones(len(sequence), bool)
    words[ends - 1] = False
    sequence[words] = np.searchsorted(vocabulary, hashes) + 1
    left = ends[owner] - 1 - np.arange(len(sequence))  # words from a place to the end of its item
    depth = np.minimum(window, counts)[owner]
    starts = np.flatnonzero(words & (left >= depth))
    return Index([name for name, _ in items], vocabulary, sequence, owner, starts, depth[starts],
                 max(1, int(len(vocabulary) + 1).bit_length()))


def _keys(sequence: np.ndarray, per: int, bits: int) -> np.ndarray:
    """The next ``per`` words of every place in one number; zeros follow the end."""
    padded = np.concatenate([sequence, np.zeros(per, np.int64)])
    key = np.zeros(len(sequence), np.int64)
    for k in range(per):
        key <<= bits
        key |= padded[k:k + len(sequence)]
    return key


def suffix_array(keys: np.ndarray, places: np.ndarray, per: int, depth: int) -> np.ndarray:
    """``places`` in the order of the words that follow them, to ``depth`` words at least.

    Sorted by one key, then runs of equal keys by the next one, until none are equal or the depth is reached.
    """
    at = np.concatenate([keys, np.zeros(1, np.int64)])

    def key(p: np.ndarray) -> np.ndarray:
        return at[np.minimum(p, len(keys))]

    order = places[np.argsort(key(places), kind="stable")]
    group = np.cumsum(np.diff(key(order), prepend=-1) != 0)
    for done in range(per, depth, per):
        tied = np.zeros(len(order), bool)
        same = group[1:] == group[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        next_key = key(order[slots] + done)
        inner = np.lexsort((next_key, group[slots]))
        order[slots] = order[slots][inner]
        full = np.full(len(order), -1, np.int64)
        full[slots] = next_key[inner]
        group = np.cumsum((np.diff(group, prepend=0) != 0) | (np.diff(full, prepend=-2) != 0))
    return order


def _bisect(values: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, right: bool) -> np.ndarray:
    """For each wanted value its place within [low, high) of ``values``, which are sorted there."""
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        seen = values[np.minimum(middle, len(values) - 1)]
        after = (seen <= wanted) if right else (seen < wanted)
        low = np.where(open_ & after, middle + 1, low)
        high = np.where(open_ & ~after, middle, high)
    return low


def occurrences(index: Index, sequence: np.ndarray, shortest: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """All (window, place): the window of ``index.starts`` begins at that place of the shard's sequence."""
    per, bits = index.per_key, index.bits
    zero = sequence == 0
    ends = np.flatnonzero(zero)
    run = ends[np.minimum(np.cumsum(zero) - zero, len(ends) - 1)] - np.arange(len(sequence))
    places = np.flatnonzero(~zero & (run >= shortest))
    if not len(places):
        return places, places
    keys = _keys(sequence, per, bits)
    order = suffix_array(keys, places, per, longest)
    own = _keys(index.sequence, per, bits)
    low, high = np.zeros(len(index.starts), np.int64), np.full(len(index.starts), len(order), np.int64)
    at = np.concatenate([keys, np.zeros(1, np.int64)])
    own = np.concatenate([own, np.zeros(1, np.int64)])
    for done in range(0, int(index.depths.max()), per):
        here = np.flatnonzero((index.depths > done) & (low < high))
        part = index.depths[here] - done
        values = at[np.minimum(order + done, len(keys))]
        wanted = own[np.minimum(index.starts[here] + done, len(own) - 1)]
        for size in np.unique(np.minimum(part, per)):
            which = here[np.minimum(part, per) == size]
            shift = bits * (per - int(size))
            cut, want = values >> shift, wanted[np.minimum(part, per) == size] >> shift
            first = _bisect(cut, want, low[which], high[which], right=False)
            high[which] = _bisect(cut, want, first, high[which], right=True)
            low[which] = first
    count = np.maximum(0, high - low)
    window = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
    return window, order[low[window] + inside]


def _merged(runs: np.ndarray) -> np.ndarray:
    """Disjoint sorted runs (n, 2) that cover the same places."""
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(runs[:, 1])
    new = np.concatenate(([True], runs[1:, 0] > reach[:-1]))
    first = np.flatnonzero(new)
    return np.stack([runs[first, 0], reach[np.append(first[1:], len(runs)) - 1]], axis=1)


def search_shard(index: Index, hasher: Hasher, texts: list[bytes]) -> list[dict]:
    """Hits of one shard, one entry per text, in the form of the state column."""
    hashes, counts = hasher(texts)
    found = [{"n_words": int(n), "n_hit": 0, "runs": [], "items": [], "longest": 0, "longest_item": None,
              "longest_at": None} for n in counts]
    if not len(index.starts) or not len(hashes):
        return found
    slot = np.minimum(np.searchsorted(index.vocabulary, hashes), len(index.vocabulary) - 1)
    known = index.vocabulary[slot] == hashes
    sequence = np.zeros(len(hashes) + len(texts), np.int64)
    words = np.ones(len(sequence), bool)
    words[np.cumsum(counts + 1) - 1] = False
    sequence[words] = np.where(known, slot + 1, 0)
    sizes = np.bincount(index.owner)
    window, place = occurrences(index, sequence, int(index.depths.min()), int(sizes.max()))
    if not len(window):
        return found
    begins = np.concatenate(([0], np.cumsum(counts + 1)))[:-1]
    doc = np.searchsorted(begins, place, side="right") - 1
    item, depth = index.owner[index.starts[window]], index.depths[window]

    # Neighbouring windows on one diagonal are one verbatim match.
    diagonal = place - index.starts[window]
    order = np.lexsort((place, diagonal))
    d, p = diagonal[order], place[order]
    first = np.flatnonzero(np.concatenate(([True], (np.diff(d) != 0) | (np.diff(p) != 1))))
    length = np.diff(np.append(first, len(order))) - 1 + depth[order][first]
    m_doc, m_item, m_at = doc[order][first], item[order][first], p[first] - begins[doc[order][first]]
    by_doc = np.lexsort((m_at, m_item, -length, m_doc))
    edges = np.flatnonzero(np.diff(m_doc[by_doc], prepend=-1))
    for start, stop in zip(edges.tolist(), np.append(edges[1:], len(by_doc)).tolist()):
        own = by_doc[start:stop]
        runs = _merged(np.stack([m_at[own], m_at[own] + length[own]], axis=1))
        best = own[0]
        found[int(m_doc[best])].update(
            n_hit=int((runs[:, 1] - runs[:, 0]).sum()), runs=runs.ravel().tolist(),
            items=sorted({index.names[k] for k in np.unique(m_item[own]).tolist()}),
            longest=int(length[best]), longest_item=index.names[int(m_item[best])], longest_at=int(m_at[best]))
    return found


def _shards(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = max(1, batch.num_rows * _SHARD_BYTES // max(_SHARD_BYTES, batch.nbytes))
    for start in range(0, batch.num_rows, size):
        yield batch.slice(start, size)


def _joined(old: dict | None, new: dict) -> dict:
    """The state after another block of the benchmark."""
    if not old or not old["n_hit"]:
        return new
    if not new["n_hit"]:
        return old
    runs = _merged(np.array(old["runs"] + new["runs"], np.int64).reshape(-1, 2))
    best = new if new["longest"] > old["longest"] else old
    return {**best, "n_hit": int((runs[:, 1] - runs[:, 0]).sum()), "runs": runs.ravel().tolist(),
            "items": sorted({*old["items"], *new["items"]})}


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Index]:
    """The benchmark in blocks that each fit the driver and the tasks, split by a hash of the text."""
    items = benchmark.filter("text is not null").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n_blocks = -(-total // block_bytes)
    for k in range(n_blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).distinct()
        yield build_index(sorted((r["item_id"], r["text"].encode()) for r in part.collect()), window)


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
           name: str = "hits") -> DataFrame:
    """``docs`` with a column ``name`` (replacing one of that name) and every other column as it is.

    The column holds n_words, n_hit (words inside any occurrence of a window), runs (begin and end of the hit words,
    flat), items (distinct item_ids, sorted), longest, longest_item and longest_at (the longest verbatim
    match in words, its item and first word). Words are lower-cased runs of digits, letters a-z and anything
    beyond ASCII. An item of fewer words than ``window`` is one window; an item without words, or null, has
    none. A null text has no words. Items without an id are named by an empty string. Repeated documents are
    answered each, repeated items count once, an empty benchmark hits nothing.
    """
    spark = docs.sparkSession
    ship(spark)
    columns = [c for c in docs.columns if c != name]
    state = docs.select(*columns).withColumn(name, F.lit(None).cast(_STATE))
    schema = state.schema
    indexes = list(_blocks(benchmark, window, block_bytes)) or [build_index([], window)]
    for index in indexes:
        shared = spark.sparkContext.broadcast(index)  # of bounded size

        @in_worker("decontamination")
        def step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hasher, own = Hasher(NOT_ALPHANUMERIC), shared.value
            for batch in batches:
                for part in _shards(batch):
                    new = search_shard(own, hasher, utf8(part.column("text")))
                    hits = [_joined(a, b) for a, b in zip(part.column(name).to_pylist(), new)]
                    kind = part.schema.field(name).type
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], pa.array(hits, kind)],
                                                     names=[*columns, name])

        state = state.mapInArrow(step, schema)
    return state


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any hit, with the same columns."""
    name = unused(docs.columns, "hits")
    return search(docs, benchmark, window, name=name).filter(F.col(name)["n_hit"] == 0).drop(name)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("hits.n_words"), F.col("hits.n_hit"), F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hits.items"), ","), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"), F.col("hits.longest").alias("longest_match"))
