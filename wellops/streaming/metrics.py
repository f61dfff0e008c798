"""Rule metrics of streaming tables, each micro-batch exactly once.

A listener commits the metrics of a micro-batch under its number as soon as Spark reports it. The report comes after the
batch is committed, so a driver that is lost in between leaves a batch without metrics. ``reconcile`` finds those by
comparing the commits of the checkpoint with the history and runs each of them again to nowhere: on a copy of the
checkpoint as it was before the batch, where Spark repeats it with the offsets it logged and the state it had. So the
numbers are those of the batch, not of what the sources hold by now.

A number can be committed once only, so a report that comes late or twice changes nothing.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from wellops.plans.pipeline import COMMENTS
from wellops.sinks import commits, datasets
from wellops.sinks.layout import Layout, file_system, numbered

METRICS = "dq"
OPERATION = "STREAMING UPDATE"
#: How long a report may take to arrive after its batch has ended.
PATIENCE = 10.0

# Running queries by name: the table, and the only batch that counts (None: all).
_WATCHED: dict[str, tuple[SparkSession, Layout, str, int | None]] = {}
_LISTENING: set[str] = set()


class Recorder(StreamingQueryListener):
    """Commits the observed metrics of the watched queries. Reports without metrics, as those of idle triggers, which carry
    the number of the batch to come, are no batches."""

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        watched = _WATCHED.get(progress.name)
        seen = (progress.observedMetrics or {}).get(METRICS)
        if watched is None or seen is None:
            return
        spark, layout, name, only = watched
        if only is None or only == progress.batchId:
            entry = datasets.entry(name, OPERATION, seen.asDict(), layout.stream(name), COMMENTS[name], writer_of(spark, layout, name))
            commits.commit_at(spark, layout.history(name), progress.batchId, entry)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def writer_of(spark: SparkSession, layout: Layout, name: str) -> str:
    """The id of the query that writes a table, from its checkpoint; it stays the same over restarts."""
    return json.loads(spark.read.text(f"{layout.checkpoint(name)}/metadata", wholetext=True).first()[0])["id"]


def watch(spark: SparkSession, layout: Layout, name: str, query_name: str, only: int | None = None) -> None:
    app = spark.sparkContext.applicationId
    if app not in _LISTENING:
        spark.streams.addListener(Recorder())
        _LISTENING.add(app)
    _WATCHED[query_name] = (spark, layout, name, only)


def unwatch(query_name: str) -> None:
    _WATCHED.pop(query_name, None)


def missing(spark: SparkSession, layout: Layout, name: str) -> list[int]:
    """Committed micro-batches without metrics. Checkpoints keep the last hundred; what came before the first one kept is
    compared by number."""
    done = numbered(spark, f"{layout.checkpoint(name)}/commits")
    known = set(commits.versions(spark, layout.history(name)))
    return [b for b in range(done[-1] + 1) if b not in known] if done else []


def _copy(spark: SparkSession, layout: Layout, name: str, batch: int) -> str:
    """The checkpoint of a table as it was before ``batch`` ended."""
    source, target = layout.checkpoint(name), layout.scratch(f"replay-{name}")
    fs, _ = file_system(spark, source)
    path, util = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.org.apache.hadoop.fs.FileUtil
    conf = spark._jsc.hadoopConfiguration()
    for status in fs.listStatus(path(source)):
        part = status.getPath().getName()
        if part in ("offsets", "commits"):
            fs.mkdirs(path(f"{target}/{part}"))
            last = batch if part == "offsets" else batch - 1
            for k in (b for b in numbered(spark, f"{source}/{part}") if b <= last):
                util.copy(fs, path(f"{source}/{part}/{k}"), fs, path(f"{target}/{part}/{k}"), False, conf)
        else:
            util.copy(fs, status.getPath(), fs, path(f"{target}/{part}"), False, conf)
    return target


def _replay(spark: SparkSession, layout: Layout, name: str, batch: int, build: Callable[[], DataFrame]) -> None:
    if batch not in numbered(spark, f"{layout.checkpoint(name)}/offsets"):
        raise RuntimeError(f"{name}: metrics of micro-batch {batch} are gone, and so are its offsets")
    query_name = f"replay-{batch}-{name}@{layout.root}"
    watch(spark, layout, name, query_name, only=batch)

    def run(df: DataFrame, k: int) -> None:
        if k == batch:  # later ones are not run
            df.write.format("noop").mode("overwrite").save()

    query = (build().writeStream.foreachBatch(run).queryName(query_name).outputMode("append")
             .option("checkpointLocation", _copy(spark, layout, name, batch)).trigger(availableNow=True).start())
    try:
        query.awaitTermination()
        _wait(lambda: batch in commits.versions(spark, layout.history(name)))
    finally:
        query.stop()
        unwatch(query_name)
    if batch in missing(spark, layout, name):
        raise RuntimeError(f"{name}: micro-batch {batch} gave no metrics when it was run again")


def _wait(done: Callable[[], bool], patience: float = PATIENCE) -> None:
    end = time.monotonic() + patience
    while not done() and time.monotonic() < end:
        time.sleep(0.05)


def reconcile(spark: SparkSession, layout: Layout, name: str, build: Callable[[], DataFrame], running: bool = False) -> list[int]:
    """Give every committed micro-batch its metrics; returns those that were run again.

    ``running``: the reports of the last batches may still be under way, so they are waited for.
    """
    if running:
        _wait(lambda: not missing(spark, layout, name))
    lost = missing(spark, layout, name)
    for batch in lost:
        _replay(spark, layout, name, batch, build)
    return lost
