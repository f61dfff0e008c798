"""Merkle manifest of a dataset, kept as a log of nodes in postorder.

A tree has up to 16 children a node. Its log lists the nodes in the order in which they are completed: a leaf, and after
it every node that ends with that leaf. So the place of a node follows from numbers alone. With n leaves and H levels
above them, the node of height h and index i ends with leaf e = min((i + 1) * 16**h, n) - 1, and

    place(h, i) = e + e // 16 + e // 16**2 + .. + e // 16**H + h

as e leaves and the subtrees that end before leaf e were completed earlier. A whole subtree of height h has
(16**(h + 1) - 1) / 15 nodes, so a node's elder sibling stands that many places before it, and siblings are addressed
without any index or pointer.

1. Every row becomes a leaf. Leaves are sorted by range and numbered within their tree from the sizes of the ranges, so a
   tree that holds most rows is spread like any other.
2. Builders work on aligned runs of 16**3 leaves: each completes the subtree above its run and appends its nodes, in
   order of completion, as one segment of the log: a log of its own with LEVELS levels. Its top is a leaf of the next round, whose builders add three levels more.
   Rounds grow with the logarithm of the rows to the base 4,096.
3. The roots of the sources are the leaves of one more tree, built in the same way.
4. Proofs go down the same segments, from the last round to the first: all leaves of a segment share what lies above
   it, so a segment is joined with one path, however many rows it holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellops.llm.common import scratch, ship, stored, table

FAN_OUT = 16
LEVELS = 3  # that one builder completes, so a run is of 4,096 leaves
TAMPERED = 5
DIGEST = 32
_AT_ONCE = 512

_PATH = "array<struct<place:int,others:binary>>"


def parent(children: Sequence[bytes]) -> bytes:
    """The digest of a node: sha256 of its children's digests as lowercase hex, one after the other."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def height_of(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves; a lone leaf is its own root."""
    height = 0
    while FAN_OUT ** height < n:
        height += 1
    return height


def place(height: int, index: int, n: int, levels: int) -> int:
    """The place of a node in the log of ``n`` leaves with ``levels`` levels above them."""
    end = min((index + 1) * FAN_OUT ** height, n) - 1
    return end + sum(end // FAN_OUT ** k for k in range(1, levels + 1)) + height


class Segment:
    """The log of the nodes above an aligned run of leaves, as one string of digests in order of completion."""

    def __init__(self, leaves: int, levels: int, nodes: bytes):
        self.leaves, self.levels, self.nodes = leaves, levels, nodes
        self._last: dict[int, tuple[int, bytes]] = {}

    @staticmethod
    def built(leaves: Sequence[bytes], levels: int) -> Segment:
        """Append leaves one by one; each completes the nodes that end with it."""
        out: list[bytes] = []
        unfinished: list[list[bytes]] = [[] for _ in range(levels)]
        last = len(leaves) - 1
        for k, digest in enumerate(leaves):
            out.append(digest)
            for children in unfinished:
                children.append(digest)
                if len(children) < FAN_OUT and k < last:
                    break
                digest = parent(children)
                children.clear()
                out.append(digest)
        return Segment(len(leaves), levels, b"".join(out))

    def node(self, height: int, index: int) -> bytes:
        at = place(height, index, self.leaves, self.levels) * DIGEST
        return self.nodes[at:at + DIGEST]

    def top(self) -> bytes:
        return self.nodes[-DIGEST:]

    def siblings(self, height: int, first: int) -> bytes:
        """The digests of the children of one parent, from index ``first`` on."""
        if self._last.get(height, (None,))[0] != first:
            end = min(first + FAN_OUT, -(-self.leaves // FAN_OUT ** height))
            self._last[height] = first, b"".join(self.node(height, k) for k in range(first, end))
        return self._last[height][1]

    def path(self, leaf: int) -> list[tuple[int, bytes]]:
        """Per level the place of the leaf's ancestor among its parent's children, and the digests of the others."""
        out, index = [], leaf
        for height in range(self.levels):
            own = index % FAN_OUT
            run = self.siblings(height, index - own)
            out.append((own, run[:own * DIGEST] + run[(own + 1) * DIGEST:]))
            index //= FAN_OUT
        return out


def folded(digest: bytes, path: Sequence[tuple[int, bytes]]) -> bytes:
    """The root that follows from a node and its siblings."""
    for own, others in path:
        cut = own * DIGEST
        digest = parent([others[:cut], digest, others[cut:]])
    return digest


def field(value: Column) -> Column:
    """A value with its length in bytes, ``-`` where it is null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*map(field, (doc_id, source, lang, n_chars, text))).cast("binary"), 256))


def numbered(rows: DataFrame, order: Sequence[str], folder: str, name: str) -> DataFrame:
    """``rows`` with ``index`` (its place within ``tree``, by ``order``) and ``n`` (the rows of the tree).

    Rows are sorted by range and written; the places follow from the sizes of the ranges.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = stored(ranged.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), folder, f"{name}-sorted")
    sizes = ranged.groupBy("tree", "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_size"))
    # A tree has a row per range it lies in.
    by_tree = Window.partitionBy("tree")
    before = by_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("tree", "_part", "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
                          F.sum("_size").over(by_tree).alias("n"))
    return ranged.join(starts, ["tree", "_part"]).withColumn("index", F.col("_row") - F.col("_first") + F.col("_start")).drop(
        "_part", "_row", "_first", "_start")


_SEGMENT = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("run", pa.int64()), ("nodes", pa.binary()), ("top", pa.binary())])


def _built(leaves: DataFrame, extra: Sequence[str], levels: int) -> DataFrame:
    """Segments of the aligned runs of ``leaves`` (tree, n, index, digest): tree, n (leaves of the tree in this round), run,
    nodes, top, and for each column of ``extra`` the array of its values in order of the leaves."""
    types = dict(leaves.dtypes)
    schema = pa.schema([*_SEGMENT, *[pa.field(c, pa.list_(pa.int64() if types[c] == "bigint" else pa.binary())) for c in extra]])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, rows, n = None, [], 0
        held: list[dict] = []

        def segment() -> dict:
            digests = [r[0] for r in rows]
            made = Segment.built(digests, min(levels, height_of(n)))
            return {"tree": name[0], "n": n, "run": name[1], "nodes": made.nodes, "top": made.top(),
                    **{c: [r[k] for r in rows] for k, c in enumerate(extra, 1)}}

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("tree", "run", "n", "digest", *extra)]
            for tree, run, total, *values in zip(*columns):
                if (tree, run) != name:
                    if rows:
                        held.append(segment())
                        if len(held) == 16:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held = []
                    name, rows, n = (tree, run), [], total
                rows.append(values)
        if rows:
            held.append(segment())
        yield pa.RecordBatch.from_pylist(held, schema=schema)

    fields = "tree string, n long, run long, nodes binary, top binary" + "".join(f", {c} array<{types[c]}>" for c in extra)
    placed = leaves.withColumn("run", F.floor(F.col("index") / FAN_OUT ** levels).cast("long"))
    return (placed.select("tree", "run", "index", "n", "digest", *extra).repartition("tree", "run")
            .sortWithinPartitions("tree", "run", "index").drop("index").mapInArrow(build, fields))


def build(leaves: DataFrame, folder: str, name: str, levels: int, extra: Sequence[str] = ()) -> list[DataFrame]:
    """The rounds of segments of a set of trees from ``leaves`` (tree, n, index, digest); the last round holds the roots."""
    run = FAN_OUT ** levels
    rounds = [stored(_built(leaves, extra, levels), folder, f"{name}-0")]
    most = rounds[0].agg(F.max("n")).first()[0] or 0
    while most > run:
        most = -(-most // run)
        # The tree of this round has the tops of the last one as leaves. Trees that are complete take no part.
        tops = rounds[-1].filter(F.col("n") > run).select(
            "tree", F.ceil(F.col("n") / run).cast("long").alias("n"), F.col("run").alias("index"), F.col("top").alias("digest"))
        rounds.append(stored(_built(tops, (), levels), folder, f"{name}-{len(rounds)}"))
    return rounds


def roots(rounds: list[DataFrame], levels: int) -> DataFrame:
    """(tree, root)."""
    done = [r.filter(F.col("n") <= FAN_OUT ** levels).select("tree", F.col("top").alias("root")) for r in rounds]
    return reduce(DataFrame.union, done)


def _opened(r: dict, levels: int) -> tuple[Segment, list[tuple[int, bytes]]]:
    """The segment in a row, and the path from its top to the root."""
    run = FAN_OUT ** levels
    segment = Segment(min(run, r["n"] - r["run"] * run), min(levels, height_of(r["n"])), r["nodes"])
    return segment, [(s["place"], s["others"]) for s in r["above"] or []]


def _paths(segments: DataFrame, levels: int) -> DataFrame:
    """(tree, index, subroot, path): the siblings of every leaf of ``segments`` up to the root."""
    schema = pa.schema([("tree", pa.string()), ("index", pa.int64()), ("subroot", pa.binary()),
                        ("path", pa.list_(pa.struct([("place", pa.int32()), ("others", pa.binary())])))])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                segment, above = _opened(r, levels)
                for start in range(0, segment.leaves, _AT_ONCE):
                    yield pa.RecordBatch.from_pylist([
                        {"tree": r["tree"], "index": r["run"] * FAN_OUT ** levels + i, "subroot": r["subroot"],
                         "path": [{"place": own, "others": others} for own, others in [*segment.path(i), *above]]}
                        for i in range(start, min(start + _AT_ONCE, segment.leaves))], schema=schema)

    return segments.select("tree", "n", "run", "nodes", "subroot", "above").mapInArrow(
        extract, f"tree string, index long, subroot binary, path {_PATH}")


def _with_paths(rounds: list[DataFrame], above: DataFrame, folder: str, name: str, levels: int) -> DataFrame:
    """The first round's segments with ``subroot`` and ``above``, the path from their top to the root.

    ``above``: tree, subroot and path of the roots of the trees. A segment meets one row: that of its tree where it is
    the last of it, or the path of its top in the next round.
    """
    below = None
    for k in reversed(range(len(rounds))):
        ends = rounds[k].filter(F.col("n") <= FAN_OUT ** levels).join(above.withColumnRenamed("path", "above"), "tree")
        if below is not None:
            upper = below.select("tree", F.col("index").alias("run"), "subroot", F.col("path").alias("above"))
            ends = ends.unionByName(rounds[k].filter(F.col("n") > FAN_OUT ** levels).join(upper, ["tree", "run"]))
        if k == 0:
            return ends
        below = stored(_paths(ends, levels), folder, f"{name}-paths-{k}")


def manifest(docs: DataFrame, folder: str | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, source, lang, n_chars, text): doc_id, leaf, subroot, root, proof_sha256,
    folded_root, verified.

    A null in any column is the field ``-``; an empty text is ``0:``. Within a source rows without an id come first and
    rows of one id by the digest of their leaf, so rows that repeat are leaves of their own and their order does not
    matter. Rows without a source form one of their own, before all others. Texts of any length are hashed whole by
    Spark. Other columns are ignored. An empty table gives an empty result.

    Tampered are rows whose id has a crc32 that 5 divides; a row without an id has none. ``folded_root`` follows
    from the tampered leaf and the untampered siblings. ``levels`` are completed by one builder.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = folder or scratch(spark, "merkle_manifest")
    doc_id, source, lang, n_chars, text = (F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    changed = F.when(F.crc32(doc_id.cast("string").cast("binary")) % TAMPERED == 0, F.when(
        text.rlike("[A-Z]"), leaf_digest(doc_id, source, lang, n_chars, F.translate(text, capitals, capitals.lower()))))
    # Trees are named so that rows without a source have one, and come first.
    rows = docs.select(F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("")).alias("tree"),
                       F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(doc_id, source, lang, n_chars, text).alias("digest"),
                       changed.alias("changed"))
    leaves = numbered(rows, ["doc_id", "digest"], folder, "leaves")
    sources = build(leaves, folder, "sources", levels, ["doc_id", "changed"])

    subroots = stored(roots(sources, levels), folder, "subroots")
    tops = numbered(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("root").alias("digest")),
                    ["source"], folder, "tops")
    above = build(tops, folder, "above", levels)
    root = roots(above, levels).first()  # one row: the sources are the leaves of one tree
    if root is None:
        return spark.createDataFrame([], _MANIFEST)
    end = spark.createDataFrame([("", None, [])], f"tree string, subroot binary, path {_PATH}")
    of_source = _paths(_with_paths(above, end, folder, "above", levels), levels).select("index", "path").join(tops, "index").select(
        F.col("source").alias("tree"), F.col("digest").alias("subroot"), "path")
    of_source = stored(of_source, folder, "paths")
    return _proved(_with_paths(sources, of_source, folder, "sources", levels), bytes(root["root"]), levels)


_MANIFEST = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
             "verified boolean")


def _proved(segments: DataFrame, root: bytes, levels: int) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                        ("verified", pa.bool_())])

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                segment, above = _opened(r, levels)
                upper = b"".join(others for _, others in above).hex().encode()
                whole = {segment.top(): folded(segment.top(), above)}
                subroot, named = r["subroot"].hex(), root.hex()
                for start in range(0, segment.leaves, _AT_ONCE):
                    out = []
                    for i in range(start, min(start + _AT_ONCE, segment.leaves)):
                        leaf, path = segment.node(0, i), segment.path(i)
                        top = folded(r["changed"][i] or leaf, path)
                        if top not in whole:
                            whole = {segment.top(): whole[segment.top()], top: folded(top, above)}
                        proof = hashlib.sha256(b"".join(others for _, others in path).hex().encode() + upper)
                        out.append((r["doc_id"][i], leaf.hex(), subroot, named, proof.hexdigest(), whole[top].hex(), whole[top] == root))
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return segments.select("tree", "n", "run", "nodes", "doc_id", "changed", "above", "subroot").mapInArrow(prove, _MANIFEST)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))
