"""Near-duplicate vectors by an epsilon grid order join.

Cosine at least c between unit vectors is distance at most eps = sqrt(2 - 2 c). Vectors are projected on a few
leading principal directions (which never lengthens a distance), cells of width eps are laid over the
projection, and the vectors of a label are sorted by their cells in lexicographic order. The sorted
sequence is cut into blocks; two blocks whose boxes are more than eps apart cannot hold a pair and are never brought
together. Blocks that may are joined recursively: both sequences are halved, halves with distant boxes are
skipped, and small ones are compared by a matrix product in double precision.

Equal vectors are one class with a count, so copies cost nothing. The links of a block pair leave its task as
counts and as a spanning forest, never as pairs, so a dense cluster makes no more rows than it has members and blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellops.llm.common import scratch, ship, stored, table
from wellops.llm.components import components


@dataclass(frozen=True)
class Settings:
    """``directions``: leading principal dimensions of the grid; ``block`` and ``leaf`` in vectors."""
    min_cosine: float = 0.98
    directions: int = 6
    block: int = 1024
    leaf: int = 128
    widest: int = 256  # coordinates that the principal directions are taken from

    @property
    def eps(self) -> float:
        return float(np.sqrt(max(0.0, 2.0 - 2.0 * self.min_cosine))) + 1e-9


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of at most ``width`` numbers as rows, padded with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)  # first, so that squares neither overflow nor vanish
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def principal_directions(classes: DataFrame, width: int, how: Settings) -> np.ndarray:
    """(width, directions) orthonormal: leading eigenvectors of the covariance of all unit vectors.

    Per task one matrix of the first ``widest`` coordinates; Spark adds them up.
    """
    used = min(width, how.widest)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((used + 1, used))
        for batch in batches:
            if batch.num_rows:
                x = _unit(_matrix(batch.column("vector"), width))[:, :used]
                total[:used] += x.T @ x
                total[used] += x.sum(axis=0)
        i, j = np.divmod(np.arange(total.size), used)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "s"])

    total = np.zeros((used + 1, used))
    for r in classes.select("vector").mapInArrow(moments, "i long, j long, s double").groupBy("i", "j").agg(
            F.sum("s").alias("s")).collect():
        total[r["i"], r["j"]] = r["s"]
    n = max(1.0, float(np.trace(total[:used])))  # unit vectors: the trace is their number
    mean = total[used] / n
    _, vectors = np.linalg.eigh(total[:used] / n - np.outer(mean, mean))
    out = np.zeros((width, min(how.directions, used)))
    out[:used] = vectors[:, ::-1][:, :how.directions]
    return out


_BLOCK = ("label string, dim int, block long, low array<double>, high array<double>, "
          "ids array<long>, copies array<long>, place binary, unit binary")


def _blocks(classes: DataFrame, width: int, axes: np.ndarray, how: Settings) -> DataFrame:
    """The sorted sequence of every (label, dim), cut into blocks with their boxes."""
    eps, p = how.eps, axes.shape[1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = np.floor(_unit(_matrix(batch.column("vector"), width)) @ axes / eps).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c) for c in cells.T]],
                                                 names=[*batch.schema.names, *[f"c{k}" for k in range(p)]])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        rows: list[dict] = []

        def block() -> pa.RecordBatch:
            vectors = np.zeros((len(rows), width))
            for k, r in enumerate(rows):
                vectors[k, :len(r["vector"])] = r["vector"]
            unit = _unit(vectors)
            spot = unit @ axes
            return pa.RecordBatch.from_pylist([{
                "label": rows[0]["label"], "dim": rows[0]["dim"], "block": number, "low": spot.min(axis=0), "high": spot.max(axis=0),
                "ids": [r["id"] for r in rows], "copies": [r["copies"] for r in rows],
                "place": spot.tobytes(), "unit": unit[:, :rows[0]["dim"]].tobytes()}], schema=_BLOCK_SCHEMA)

        for batch in batches:
            for r in batch.select(["label", "dim", "id", "copies", "vector"]).to_pylist():
                if rows and (len(rows) == how.block or (r["label"], r["dim"]) != (rows[0]["label"], rows[0]["dim"])):
                    yield block()
                    rows, number = [], number + 1
                rows.append(r)
        if rows:
            yield block()

    cells = [f"c{k}" for k in range(p)]
    placed = classes.mapInArrow(place, "label string, dim int, id long, copies long, vector array<double>, "
                                + ", ".join(f"{c} int" for c in cells))
    order = ["label", "dim", *cells, "id"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, _BLOCK)


_BLOCK_SCHEMA = pa.schema([
    ("label", pa.string()), ("dim", pa.int32()), ("block", pa.int64()), ("low", pa.list_(pa.float64())),
    ("high", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64())),
    ("place", pa.binary()), ("unit", pa.binary())])


def _near_blocks(blocks: DataFrame, how: Settings) -> DataFrame:
    """(a, b): pairs of blocks, each also with itself, whose boxes are at most eps apart."""
    eps = how.eps

    def strips(low: str, high: str) -> str:
        return f"explode(sequence(cast(floor(({low}) / {eps!r}) as int), cast(floor(({high}) / {eps!r}) as int)))"

    a = blocks.select("label", "dim", F.col("block").alias("a"), F.col("low").alias("low_a"), F.col("high").alias("high_a"),
                      F.expr(strips(f"low[0] - {eps!r}", f"high[0] + {eps!r}")).alias("strip"))
    b = blocks.select("label", "dim", F.col("block").alias("b"), F.col("low").alias("low_b"), F.col("high").alias("high_b"),
                      F.expr(strips("low[0]", "high[0]")).alias("strip"))
    gaps = ("zip_with(zip_with(low_a, high_b, (x, y) -> x - y), zip_with(low_b, high_a, (x, y) -> x - y), "
            "(x, y) -> greatest(0D, x, y))")
    near = F.expr(f"aggregate({gaps}, 0D, (s, x) -> s + x * x) <= {eps * eps!r}")
    return a.join(b, ["label", "dim", "strip"]).filter(F.col("a") <= F.col("b")).filter(near).select("a", "b").distinct()


class _Side:
    """One block in a task."""

    def __init__(self, ids: list[int], copies: list[int], place: bytes, unit: bytes):
        self.ids, self.copies = np.array(ids, np.int64), np.array(copies, np.int64)
        self.place = np.frombuffer(place).reshape(len(ids), -1)
        self.unit = np.frombuffer(unit).reshape(len(ids), -1)
        self.links = np.zeros(len(ids), np.int64)


def _forest(linked: np.ndarray, x: np.ndarray, y: np.ndarray) -> set[tuple[int, int]]:
    """Links from every linked id to the smallest one of its component within this comparison."""
    low_x, low_y, big = x.copy(), y.copy(), np.iinfo(np.int64).max
    while True:
        new_x = np.minimum(low_x, np.where(linked, low_y, big).min(axis=1))
        new_y = np.minimum(low_y, np.where(linked, new_x[:, None], big).min(axis=0))
        if (new_x == low_x).all() and (new_y == low_y).all():
            break
        low_x, low_y = new_x, new_y
    return {(int(u), int(v)) for ids, low in ((x, low_x), (y, low_y)) for u, v in zip(ids, low) if u != v}


def ego_join(a: _Side, b: _Side, same: bool, how: Settings) -> set[tuple[int, int]]:
    """Counts links of two sequences into ``links`` of both sides and returns a spanning forest."""
    eps2, edges = how.eps ** 2, set()

    def join(a0: int, a1: int, b0: int, b1: int) -> None:
        if same and b1 <= a0:
            return
        pa_, pb = a.place[a0:a1], b.place[b0:b1]
        gap = np.maximum(0.0, np.maximum(pa_.min(axis=0) - pb.max(axis=0), pb.min(axis=0) - pa_.max(axis=0)))
        if float(gap @ gap) > eps2:
            return
        if a1 - a0 <= how.leaf and b1 - b0 <= how.leaf:
            linked = a.unit[a0:a1] @ b.unit[b0:b1].T >= how.min_cosine
            if same:
                linked &= np.arange(a0, a1)[:, None] < np.arange(b0, b1)
            if linked.any():
                a.links[a0:a1] += linked @ b.copies[b0:b1]
                b.links[b0:b1] += a.copies[a0:a1] @ linked
                edges.update(_forest(linked, a.ids[a0:a1], b.ids[b0:b1]))
        elif a1 - a0 >= b1 - b0:
            middle = (a0 + a1) // 2
            join(a0, middle, b0, b1)
            join(middle, a1, b0, b1)
        else:
            middle = (b0 + b1) // 2
            join(a0, a1, b0, middle)
            join(a0, a1, middle, b1)

    join(0, len(a.ids), 0, len(b.ids))
    return edges


def _links(pairs: DataFrame, blocks: DataFrame, how: Settings) -> DataFrame:
    """(u, v, n): with v null the number of links of u, else a link of the forest."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                x = _Side(r["ids_a"], r["copies_a"], r["place_a"], r["unit_a"])
                same = r["a"] == r["b"]
                y = x if same else _Side(r["ids_b"], r["copies_b"], r["place_b"], r["unit_b"])
                edges = sorted(ego_join(x, y, same, how))
                sides = (x,) if same else (x, y)
                ids = np.concatenate([s.ids[s.links > 0] for s in sides])
                n = np.concatenate([s.links[s.links > 0] for s in sides])
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids.tolist() + [u for u, _ in edges], pa.int64()),
                    pa.array([None] * len(ids) + [v for _, v in edges], pa.int64()),
                    pa.array(n.tolist() + [None] * len(edges), pa.int64())], names=["u", "v", "n"])

    def side(s: str) -> DataFrame:
        return blocks.select(F.col("block").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("ids", "copies", "place", "unit")])

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(compare, "u long, v long, n long")


def near_duplicates(vectors: DataFrame, how: Settings | None = None, folder: str | None = None) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors are compared within a label and a length. A null id, label or vector, a vector without numbers, of
    zeros only, or with a null or non-finite number links with nothing. Rows that repeat an id are vectors of
    their own. A row without an id has no component (null) and is not kept. Other columns are ignored.
    """
    spark, how = vectors.sparkSession, how or Settings()
    ship(spark)
    folder = folder or scratch(spark, "embedding_dedup")
    vector = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall("vector", lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), vector.alias("vector"))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
              & finite & F.exists("vector", lambda x: x != 0))
    usable = F.coalesce(usable, F.lit(False))
    classes = rows.filter(usable).groupBy("label", "vector").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    # A number of its own for each class: where ids repeat, classes may share their smallest one.
    classes = stored(classes.withColumn("dim", F.size("vector")), folder, "classes")
    classes = stored(classes.withColumnRenamed("id", "first_id").withColumn("id", F.monotonically_increasing_id()),
                     folder, "numbered")
    width = classes.agg(F.max("dim")).first()[0]
    answer = rows.join(classes.select("label", "vector", "id", "copies", "first_id"), ["label", "vector"], "left")
    if width:
        plain = classes.select("label", "dim", "id", "copies", "vector")
        axes = principal_directions(plain, width, how)
        blocks = stored(_blocks(plain, width, axes, how), folder, "blocks")
        found = stored(_links(_near_blocks(blocks, how), blocks, how), folder, "links")
        counts = found.filter("v is null").groupBy(F.col("u").alias("id")).agg(F.sum("n").alias("near"))
        parts = components(found.filter("v is not null").select("u", "v"), folder, "components").select(
            F.col("node").alias("id"), "component")
        judged = classes.select("id", "first_id", "copies").join(counts, "id", "left").join(parts, "id", "left").withColumn(
            "component", F.coalesce("component", "id"))
        smallest = judged.groupBy("component").agg(F.min("first_id").alias("smallest"))
        judged = stored(judged.join(smallest, "component").select("id", "near", "smallest"), folder, "judged")
        answer = answer.join(judged, "id", "left")
    else:
        answer = answer.withColumns({"near": F.lit(None).cast("long"), "smallest": F.lit(None).cast("long")})
    component = F.coalesce("smallest", "vec_id")
    return answer.select(
        "vec_id", F.when(F.col("vec_id").isNull(), 0).otherwise(
            F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("near", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
