"""Batch datasets and the run history.

Each refresh writes a new folder and then commits one version to the history; readers take the folder of the
newest version. A run that fails half-way (or a ``fail`` rule) leaves the previous result in place, and of several
writers each gets a version of its own (see ``commits``). The history keeps version, time, operation and metrics of
every run and micro-batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wellops.sinks import commits, compaction, evolution
from wellops.sinks.layout import Layout, exists, small_parts, unsorted_folders

HISTORY_SCHEMA = ("dataset string, layer string, version bigint, timestamp timestamp, operation string, "
                  "operation_metrics map<string,string>, path string, comment string, writer string")


def history(spark: SparkSession, layout: Layout) -> DataFrame:
    """Version, timestamp, operation, metrics and writer of every dataset."""
    if not exists(spark, layout.history().rstrip("*")):
        return spark.createDataFrame([], HISTORY_SCHEMA)
    return spark.read.schema(HISTORY_SCHEMA).json(f"{layout.history()}/*")


def entry(name: str, operation: str, metrics: Mapping[str, object], path: str, comment: str, writer: str = "") -> dict:
    """What a commit holds beside its version."""
    now = dt.datetime.now(dt.timezone.utc).isoformat(timespec="milliseconds")
    return {"dataset": name, "layer": name.split("_")[0].upper(), "timestamp": now, "operation": operation,
            "operation_metrics": {k: str(v) for k, v in metrics.items()}, "path": path, "comment": comment, "writer": writer}


def newest(spark: SparkSession, layout: Layout, name: str) -> dict | None:
    """The newest commit of a dataset."""
    version = commits.newest(spark, layout.history(name))
    return None if version < 0 else commits.read(spark, layout.history(name), version)


def latest(spark: SparkSession, layout: Layout, name: str) -> tuple[int, str | None, str | None]:
    """(version, path, comment) of the newest run; version -1 where there is none."""
    last = newest(spark, layout, name)
    return (last["version"], last["path"], last["comment"]) if last else (-1, None, None)


def current(spark: SparkSession, layout: Layout, names: Sequence[str]) -> dict[str, tuple[int, str, str]]:
    """The same for those of ``names`` that exist."""
    found = {name: latest(spark, layout, name) for name in names}
    return {name: last for name, last in found.items() if last[0] >= 0}


def publish(spark: SparkSession, layout: Layout, name: str, df: DataFrame, comment: str = "",
            partition_by: str | None = None, metrics: Observation | None = None, operation: str = "CREATE OR REFRESH",
            facts: Mapping[str, object] | None = None) -> Mapping[str, object]:
    """Write a new version of a dataset and return its metrics.

    ``metrics`` is an observation already attached to ``df``; without one the rows written are
    counted while they pass. The observation sits in the last stage of the job, where the result of
    a lost task is counted once. ``facts`` are kept beside the metrics. With ``partition_by`` each value is a folder;
    gather its rows before (see ``silver.production``), or every task writes a file for every value it holds.
    """
    path = layout.dataset(name)
    if metrics is None:
        metrics = Observation(f"{name}_{path[-32:]}")
        df = df.observe(metrics, F.count(F.lit(1)).alias("kept"))
    writer = df.write.mode("errorifexists")
    with small_parts(spark):
        if partition_by:
            with unsorted_folders(spark):
                writer.partitionBy(partition_by).parquet(path)
        else:
            writer.parquet(path)
    seen = {**metrics.get, **(facts or {})}
    commits.commit_next(spark, layout.history(name), entry(name, operation, seen, path, comment))
    return seen


def read(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """The newest version of a dataset (batch) or the rows a stream has committed, compacted or not."""
    _, path, _ = latest(spark, layout, name)
    if path is None:
        raise ValueError(f"dataset {name} not found below {layout.root}")
    if path != layout.stream(name):
        return spark.read.parquet(path)
    return evolution.read(spark, layout, name, compaction.read(spark, layout, name))


def read_stream(spark: SparkSession, layout: Layout, name: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """A streaming table as the source of the next stream, added columns as they are stored."""
    schema = evolution.stored_schema(spark, layout, name)
    return spark.readStream.options(**(options or {})).schema(schema).parquet(layout.stream(name))


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a table once and go on from the files, for inputs that several jobs read."""
    with small_parts(df.sparkSession):
        df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
