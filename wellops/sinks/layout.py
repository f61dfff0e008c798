"""Where things live below one root folder, on any file system Spark can reach."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

SOURCES = ("wells_csv", "production_csv", "orders_json", "production_live")


@dataclass(frozen=True)
class Layout:
    """One root holds the tables of either the batch jobs or the streams, not of both."""

    root: str

    def landing(self, source: str) -> str:
        return f"{self.root}/landing/{source}"

    def schema(self, name: str) -> str:
        return f"{self.root}/schemas/{name}"

    def schema_versions(self, name: str) -> str:
        """What a schema became later, by numbered commits."""
        return f"{self.root}/schema_versions/{name}"

    def dataset(self, name: str) -> str:
        """A new folder for one version; which version it becomes is decided by the commit."""
        return f"{self.root}/datasets/{name}/{uuid.uuid4().hex}"

    def stream(self, name: str) -> str:
        return f"{self.root}/streams/{name}"

    def partials(self, name: str) -> str:
        return f"{self.root}/partials/{name}"

    def packed(self, name: str) -> str:
        return f"{self.root}/packed/{name}"

    def compaction(self, name: str) -> str:
        return f"{self.root}/compactions/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def scratch(self, name: str) -> str:
        return f"{self.root}/scratch/{name}-{uuid.uuid4().hex}"

    def history(self, name: str = "*") -> str:
        """The commits of one dataset, or of all."""
        return f"{self.root}/run_history/{name}"

    def registry(self, table: str) -> str:
        return f"{self.root}/registry/{table}"

    def model(self, run_id: str) -> str:
        return f"{self.root}/models/{run_id}"


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def numbered(spark: SparkSession, folder: str) -> list[int]:
    """The entries of a folder that are numbers, in order: micro-batches in a checkpoint, or folders of them."""
    if not exists(spark, folder):
        return []
    fs, hadoop_path = file_system(spark, folder)
    return sorted(int(n) for status in fs.listStatus(hadoop_path) if (n := status.getPath().getName()).isdigit())


def create_landing(spark: SparkSession, layout: Layout) -> list[str]:
    """Create the four landing folders where they are absent."""
    paths = [layout.landing(source) for source in SOURCES]
    for path in paths:
        fs, hadoop_path = file_system(spark, path)
        fs.mkdirs(hadoop_path)
    return paths


def saved_schema(spark: SparkSession, location: str) -> T.StructType | None:
    if not exists(spark, location):
        return None
    return T.StructType.fromJson(json.loads(spark.read.text(location, wholetext=True).first()[0]))


def save_schema(spark: SparkSession, location: str, schema: T.StructType) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("errorifexists").text(location)


#: Folders a task may have open files in at a time; it sorts only the rows of further ones.
OPEN_FOLDERS = 64
_OPEN = "spark.sql.maxConcurrentOutputFileWriters"


def keep_folders_open(spark: SparkSession) -> None:
    """Writes by folder keep a file open per folder, where Spark would sort all rows of a task first.

    For streams: their sink reads the setting of the session at every micro-batch, so it stays.
    """
    spark.conf.set(_OPEN, str(OPEN_FOLDERS))


@contextmanager
def unsorted_folders(spark: SparkSession) -> Iterator[None]:
    """The same for the batch writes within; the setting is put back at the end."""
    before = spark.conf.get(_OPEN)
    keep_folders_open(spark)
    try:
        yield
    finally:
        spark.conf.set(_OPEN, before)


#: Bytes of files, and of shuffled rows, that a task of a batch write takes. A file holds a reading in 10 to 20 bytes; as rows that wait
#: for a shuffle, a sort or a rollup they take ten times that, so at Spark's 128 MB of files a task would spill.
FILE_PART, SHUFFLE_PART = 16 << 20, 32 << 20
_PARTS = {"spark.sql.files.maxPartitionBytes": FILE_PART, "spark.sql.adaptive.advisoryPartitionSizeInBytes": SHUFFLE_PART}


@contextmanager
def small_parts(spark: SparkSession) -> Iterator[None]:
    """Jobs that run within take tables in parts that fit the memory of a task, however large the tables are; smaller settings stay."""
    before = {name: spark.conf.get(name) for name in _PARTS}
    in_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, most in _PARTS.items():
        spark.conf.set(name, str(min(most, in_bytes(before[name]))))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
