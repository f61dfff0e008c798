"""Helpers that the operators share: inputs, stored intermediate results, shipping code to executors."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
_LIBC = ctypes.CDLL(None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run below ``spark.checkpoint.dir``, or the warehouse where that is unset.

    A warehouse without a scheme is a folder of each machine, so on a cluster it can't be shared: that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.master.startswith("local") and (
            base.startswith("file:") or "://" not in base):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{base.rstrip('/')}/llm/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CACHE: dict = {}
_OWNER = ""


def give_back() -> None:
    """Return to the system what this process has freed but still holds."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def worker_cache(owner: str) -> dict:
    """What the tasks of one operator keep in a Python worker from one task to the next.

    Workers are used again by whatever comes next; one that goes over to another operator drops what it kept.
    """
    global _OWNER
    if owner != _OWNER:
        _OWNER = owner
        _CACHE.clear()
        give_back()
    return _CACHE


def in_worker(owner: str) -> Callable:
    """For functions over Arrow batches: the worker belongs to ``owner`` and gives memory back when the task ends."""

    def wrap(run: Callable) -> Callable:
        def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            worker_cache(owner)
            try:
                yield from run(batches)
            finally:
                give_back()

        return wrapped

    return wrap


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def limit_batches(spark: SparkSession, rows: int) -> None:
    """From now on the session's jobs send their rows to Python in batches of at most ``rows``."""
    now = int(spark.conf.get(_BATCH))
    spark.conf.set(_BATCH, str(min(rows, now) if now > 0 else rows))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """Jobs that run inside send their rows to Python in batches of at most ``rows``, for rows of long texts: a batch is held
    several times over, by the JVM and by the worker."""
    before = spark.conf.get(_BATCH)
    limit_batches(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


_EARLY = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
          "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
          "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
          "spark.sql.optimizer.runtimeFilter.number.threshold": "2"}


@contextmanager
def early_filter(spark: SparkSession) -> Iterator[None]:
    """Joins that run inside, of a large table with a list of some of its rows, drop most other rows before the shuffle.

    Spark builds Bloom filters of the first two join columns of the list, of 1 MB each, where the list is too long to be
    broadcast. It does so for lists with a comparison in a filter, which it takes for selective.
    """
    before = {name: spark.conf.get(name) for name in _EARLY}
    for name, value in _EARLY.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def discard(spark: SparkSession, folder: str, *names: str) -> None:
    """Remove intermediate results that nothing reads any more: what was made from them is itself stored."""
    for name in names:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> None:
    """Make this package importable on executors; once per application.

    The archive is a small file that the driver serves, so replacement executors get it as well.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(package)
    archive = os.path.join(tempfile.mkdtemp(), f"{name}-code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(package):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.join(name, os.path.relpath(path, package)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores before it until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def utf8(column: pa.Array) -> list[bytes]:
    """The bytes of a string column, null as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


