"""Whitening of vectors by a weighted covariance over distinct vectors.

Vectors become whole numbers first, so equal ones can be grouped exactly: each distinct vector is a class with a multiplicity.
Every later step works on classes and weighs them by their multiplicity (or by one):

1. Weighted sums of whole numbers per dimension, exact. So is n * x - S, and (n * x - S) / n is the centred vector with
   one rounding, however large the numbers are against their spread.
2. Weighted centred product: a task adds up c.T @ (w * c) over its classes; Spark adds the tasks' matrices.
3. The eigenvectors of that matrix, whose size is given by the dimensions alone, are taken on the driver.
4. Each class is projected and scaled once, then joined back to its rows by a digest of the vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellops.llm.common import scratch, ship, stored, table

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
MAX_DIM = 2048

_LONG = 2**63
_ROWS_AT_ONCE = 1024
# Classes of more than a thousandth of all rows, of which there are at most a thousand, are joined by broadcast.
_FREQUENT = 1000


@dataclass(frozen=True)
class Fit:
    """What the vectors of one length have in common. ``axes``: (dim, components), ``values``: their eigenvalues (zero
    where rounding explains them), ``trace``: that of the whole covariance."""
    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def scales(self) -> np.ndarray:
        """What a projection is multiplied by; not a number where there is no spread."""
        return np.array([1 / e ** 0.5 if e > 0 else np.nan for e in self.values.tolist()])


def whole_numbers(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """floor(scale * c) + offset of each entry as long; null where the vector is null, or an entry is null, not finite or
    too large for it."""
    scaled = F.transform(vector, lambda c: c.cast("double") * scale)
    fits = F.forall(scaled, lambda c: F.coalesce(F.abs(c) < 2.0**62, F.lit(False)))
    return F.when(fits, F.transform(scaled, lambda c: F.floor(c).cast("long") + F.lit(offset)))


def _key(x: str) -> Column:
    return F.unhex(F.sha2(F.col(x).cast("string").cast("binary"), 256))


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """Parts of one length each: the length, x as (rows, length), and the rows."""
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        part = batch.take(pa.array(np.flatnonzero(dims == dim)))
        step = max(1, min(_ROWS_AT_ONCE, (1 << 22) // dim))
        for start in range(0, part.num_rows, step):
            rows = part.slice(start, step)
            yield dim, rows.column("x").flatten().to_numpy().reshape(-1, dim), rows


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min())))


def _centred(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """n * x - S, exact (in Python's whole numbers where long is too small), and that divided by n."""
    wide = 2 * n * max(_largest(x), 1) >= 2**62
    exact = x.astype(object) * n - np.array(sums, object) if wide else x * n - np.array(sums, np.int64)
    return exact, exact.astype(np.float64) / n


def _deviations(exact: np.ndarray) -> list[int]:
    """The sum of squares of each row, exact."""
    if exact.dtype == object or exact.shape[1] * _largest(exact) ** 2 >= 2**62:
        exact = exact.astype(object)
    return [int(d) for d in (exact * exact).sum(axis=1)]


def weighted_sums(classes: DataFrame) -> DataFrame:
    """dim, pos, s: the weighted sum of each dimension over the vectors of each length, exact."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, x, rows in _groups(batch):
                w = rows.column("weight").to_numpy()
                wide = int(w.sum()) * max(_largest(x), 1) >= 2**62
                part = w.astype(object) @ x.astype(object) if wide else (w @ x).astype(object)
                total[dim] = total.get(dim, 0) + part
        for dim, sums in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()),
                 pa.array([Decimal(int(v)) for v in sums], pa.decimal128(38, 0))], names=["dim", "pos", "s"])

    parts = classes.select("dim", "x", "weight").mapInArrow(add, "dim int, pos int, s decimal(38,0)")
    return parts.groupBy("dim", "pos").agg(F.sum("s").cast("decimal(38,0)").alias("s"))


def weighted_products(classes: DataFrame, counts: dict[int, int], sums: dict[int, list[int]]) -> DataFrame:
    """dim, i, j, s: the sum of weight * c.T @ c over the centred vectors c of each length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, x, rows in _groups(batch):
                _, c = _centred(x, counts[dim], sums[dim])
                total[dim] = total.get(dim, 0.0) + c.T @ (c * rows.column("weight").to_numpy()[:, None])
        for dim, matrix in total.items():
            for i, row in enumerate(matrix):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(dim, dim, np.int32)), pa.array(np.full(dim, i, np.int32)), pa.array(np.arange(dim, dtype=np.int32)),
                     pa.array(row)], names=["dim", "i", "j", "s"])

    parts = classes.select("dim", "x", "weight").mapInArrow(add, "dim int, i int, j int, s double")
    return parts.groupBy("dim", "i", "j").agg(F.sum("s").alias("s"))


def fit(classes: DataFrame, components: int = COMPONENTS, max_dim: int = MAX_DIM) -> dict[int, Fit]:
    """The fit of each length of ``classes`` (dim, x, weight); the rows that reach the driver are the lengths, and the
    square of each.

    A length above ``max_dim`` with more than one distinct vector is an error, as a covariance has the square of its
    dimensions. One distinct vector has no spread, whatever its length, and no matrix is made for it.
    """
    fits: dict[int, Fit] = {}
    counts: dict[int, int] = {}
    for r in classes.groupBy("dim").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("classes")).collect():
        if r["classes"] > 1:
            counts[r["dim"]] = r["n"]
        else:
            k = min(components, r["dim"])
            fits[r["dim"]] = Fit(r["n"], [], np.zeros((r["dim"], k)), np.zeros(k), 0.0)
    if wide := sorted(d for d in counts if d > max_dim):
        raise ValueError(f"vectors of {wide} numbers: a covariance is made of up to {max_dim}")
    if not counts:
        return fits
    several = classes.filter(F.col("dim").isin(list(counts)))
    sums = {dim: [0] * dim for dim in counts}
    for r in weighted_sums(several).collect():
        sums[r["dim"]][r["pos"]] = int(r["s"])
    products = weighted_products(several, counts, sums).toArrow()
    dims, i, j, s = (products.column(c).to_numpy() for c in ("dim", "i", "j", "s"))
    for dim, n in counts.items():
        own = dims == dim
        v = np.zeros((dim, dim))
        v[i[own], j[own]] = s[own] / n
        values, vectors = np.linalg.eigh((v + v.T) / 2)
        order = np.argsort(-values, kind="stable")[:components]
        top = values[order]
        top[top <= dim * np.finfo(float).eps * max(0.0, float(values.max()))] = 0.0
        fits[dim] = Fit(n, sums[dim], vectors[:, order], top, float(np.trace(v)))
    return fits


def whitened(classes: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    """key, dim, weight, deviation and whitened (one entry a component) of each class."""
    schema = pa.schema([("key", pa.binary()), ("dim", pa.int32()), ("weight", pa.int64()), ("deviation", pa.decimal128(38, 0)),
                        ("whitened", pa.list_(pa.float64()))])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, x, rows in _groups(batch):
                own = fits[dim]
                if own.sums:
                    exact, c = _centred(x, own.n, own.sums)
                    # A component without spread has no scale, and null for every vector.
                    values = [[None if y != y else y for y in row] for row in (c @ own.axes * own.scales).tolist()]
                    deviations = [Decimal(d) if d < 10**38 else None for d in _deviations(exact)]
                else:
                    values, deviations = [[None] * len(own.values)] * len(x), [Decimal(0)] * len(x)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("key"), rows.column("dim"), rows.column("weight"), pa.array(deviations, pa.decimal128(38, 0)),
                     pa.array(values, pa.list_(pa.float64()))], schema=schema)

    return classes.select("key", "dim", "x", "weight").mapInArrow(
        project, "key binary, dim int, weight long, deviation decimal(38,0), whitened array<double>")


def identity_errors(done: DataFrame, components: int) -> DataFrame:
    """dim, identity_error: the largest entry of the whitened vectors' covariance minus the identity, centred before
    it is multiplied; components without spread are left out."""
    y = [F.get("whitened", F.lit(k)) for k in range(components)]
    n = F.sum("weight")
    means = done.groupBy("dim").agg(F.array(*[F.sum(c * F.col("weight")) / n for c in y]).alias("mean"))
    d = [c - F.get("mean", F.lit(k)) for k, c in enumerate(y)]
    errors = [F.abs(F.sum(d[a] * d[b] * F.col("weight")) / n - F.lit(float(a == b))) for a in range(components) for b in range(a + 1)]
    return done.join(means, "dim").groupBy("dim").agg(F.array_max(F.array(*errors)).alias("identity_error"))


def whiten(vectors: DataFrame, components: int = COMPONENTS, by_count: bool = True, folder: str | None = None) -> DataFrame:
    """One row per usable row of ``vectors`` (vec_id, embedding) and component: vec_id, component, n, deviation, whitened,
    explained, identity_error, deviation_decimal.

    Rows without a vector, or whose vector holds a null, an entry that is not finite or one beyond 2**62 / 1024 are left
    out; empty vectors have no components and no rows. Vectors of different lengths are whitened apart, each with
    the fit of its length. ``by_count`` weighs a distinct vector by its rows, otherwise by one, and ``n`` is the sum of the
    weights. Rows that repeat, repeat an id or have none are rows of their own. Ties between eigenvalues are broken as
    the solver has them. A component without spread has null as ``whitened``; where nothing spreads, ``explained`` and
    ``identity_error`` are null as well. ``deviation`` is null where a long cannot hold it, ``deviation_decimal`` where 38
    digits cannot. Other columns are ignored. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    folder = folder or scratch(spark, "embedding_whitening")
    rows = vectors.select("vec_id", whole_numbers(F.col("embedding")).alias("x")).filter(F.size("x") > 0)
    classes = rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")).select(
        _key("x").alias("key"), F.size("x").alias("dim"), "x", "copies", (F.col("copies") if by_count else F.lit(1).cast("long")).alias("weight"))
    classes = stored(classes, folder, "classes")
    fits = fit(classes, components)
    if not fits:
        return spark.createDataFrame([], _RESULT)
    done = stored(whitened(classes, fits), folder, "whitened")
    per_length = spark.createDataFrame(
        [(dim, f.n, [e / f.trace if f.trace > 0 else None for e in f.values.tolist()]) for dim, f in fits.items()],
        "dim int, n long, shares array<double>")
    facts = stored(per_length.join(identity_errors(done, components), "dim"), folder, "fits")  # one row a length

    keyed = rows.select("vec_id", _key("x").alias("key"))
    total = classes.agg(F.sum("copies")).first()[0]
    frequent = classes.filter(F.col("copies") > total / _FREQUENT).select("key")
    hot = done.join(F.broadcast(frequent), "key", "left_semi")
    cold = keyed.join(F.broadcast(frequent), "key", "left_anti").join(done, "key")
    answer = keyed.join(F.broadcast(hot), "key").unionByName(cold.select("key", "vec_id", *hot.columns[1:]))
    answer = answer.join(F.broadcast(facts), "dim").select(
        "vec_id", "n", "deviation", "identity_error", "shares", F.posexplode("whitened").alias("k", "whitened"))
    return answer.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), "n",
        F.when(F.col("deviation") < F.lit(Decimal(_LONG)), F.col("deviation").cast("long")).alias("deviation"), "whitened",
        F.get("shares", F.col("k")).alias("explained"), "identity_error", F.col("deviation").alias("deviation_decimal"))


_RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
           "deviation_decimal decimal(38,0)")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
