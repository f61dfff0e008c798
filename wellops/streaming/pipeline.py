"""Streaming tables: append-only, each landing file taken once, restartable from the checkpoint.

``run_available`` takes what has landed and stops; ``start`` keeps the streams running. Both use the
same checkpoints, so they can follow each other. The file sink commits per micro-batch: a ``fail``
rule stops the query and leaves the table as it was. Rule metrics go to the run history, one version per
micro-batch, also where a driver was lost (see ``metrics``).
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wellops.operators.quality import Rule
from wellops.plans import bronze, silver
from wellops.sinks import compaction, datasets, evolution
from wellops.sinks.layout import Layout, keep_folders_open, save_schema
from wellops.streaming import incremental, metrics
from wellops.streaming.metrics import METRICS

BRONZE = ("bronze_wells", "bronze_production", "bronze_orders")
PARTITIONED = {"silver_production": ("year",)}
SILVER = ("silver_wells", "silver_production", "silver_orders")


def build(spark: SparkSession, layout: Layout, name: str, as_of: str | None = None, variant: str = "dedup",
          order_rules: Sequence[Rule] | None = None, options: dict[str, str] | None = None,
          portuguese: bool = False) -> DataFrame:
    """The streaming DataFrame of one table."""
    columns = "plain" if variant == "plain" else "all"
    if name in BRONZE:
        if name == "bronze_wells":
            df = bronze.wells(spark, layout, options=options)
        elif name == "bronze_production":
            df = bronze.production(spark, layout, options=options, portuguese=portuguese)
        else:
            df = bronze.orders(spark, layout, options=options)
        return df.observe(METRICS, F.count(F.lit(1)).alias("rows"))
    raw = datasets.read_stream(spark, layout, name.replace("silver", "bronze"))
    if name == "silver_wells":
        return silver.wells(raw, as_of, variant, observe=METRICS)
    if name == "silver_production":
        return silver.production(raw, as_of, columns, observe=METRICS)
    if name == "silver_orders":
        return silver.orders(raw, columns, order_rules, observe=METRICS)
    raise ValueError(f"unknown table {name!r}")


def _check_schema(spark: SparkSession, layout: Layout, name: str, df: DataFrame) -> None:
    """A streaming table keeps its schema but for columns its source gained; any other difference is listed and stops the start."""
    known = evolution.table_schema(spark, layout, name)
    if known is None:
        save_schema(spark, layout.schema(name), df.schema)
        return
    before = {f.name: f.dataType.simpleString() for f in known}
    now = {f.name: f.dataType.simpleString() for f in df.schema}
    new = now.keys() - before.keys()
    if new and new <= evolution.allowed(spark, layout, name) and all(now.get(c) == kind for c, kind in before.items()):
        evolution.save_table_schema(spark, layout, name, df.schema)
    elif before != now:
        changed = sorted(f"{c}: {before.get(c, 'absent')} -> {now.get(c, 'absent')}"
                         for c in before.keys() | now.keys() if before.get(c) != now.get(c))
        raise ValueError(f"schema of {name} changed: {'; '.join(changed)}")


def start(spark: SparkSession, layout: Layout, name: str, interval: str | None = None, recorded: bool = True,
          **settings) -> StreamingQuery:
    """Create or continue a streaming table. Without ``interval`` it takes what is there and ends.

    With ``recorded=False`` nobody listens to its metrics; the next start makes up for it. With the option ``newColumns`` as
    ``add`` a raw table first makes columns of the fields it rescued; start the tables after it then, so that they have them too.
    """
    if name in BRONZE and name in evolution.FED_BY and (settings.get("options") or {}).get(bronze.NEW_COLUMNS) == "add":
        evolution.evolve(spark, layout, name)
    df = build(spark, layout, name, **settings)
    _check_schema(spark, layout, name, df)
    # What an earlier driver did not come to record, before this one goes on.
    metrics.reconcile(spark, layout, name, lambda: build(spark, layout, name, **settings))
    query_name = f"{name}@{layout.root}"
    if recorded:
        metrics.watch(spark, layout, name, query_name)
    else:
        metrics.unwatch(query_name)
    writer = (df.writeStream.format("parquet").outputMode("append").queryName(query_name)
              .option("checkpointLocation", layout.checkpoint(name)))
    if name in PARTITIONED:
        writer = writer.partitionBy(*PARTITIONED[name])
        keep_folders_open(spark)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start(layout.stream(name))


def record(spark: SparkSession, layout: Layout, name: str, **settings) -> None:
    """Make sure that every micro-batch committed so far is in the run history."""
    metrics.reconcile(spark, layout, name, lambda: build(spark, layout, name, **settings), running=True)


def compact(spark: SparkSession, layout: Layout, name: str, **options) -> tuple[int, int] | None:
    """Pack the closed small files of a table for its batch readers (see ``sinks.compaction``)."""
    return compaction.compact(spark, layout, name, partition_by=PARTITIONED.get(name, ()), **options)


def run_available(spark: SparkSession, layout: Layout, names: Sequence[str] = BRONZE + SILVER, **settings) -> None:
    """Bring the tables up to date with the landing folders, one after the other."""
    for name in names:
        query = start(spark, layout, name, **settings)
        query.awaitTermination()
        record(spark, layout, name, **settings)


def start_all(spark: SparkSession, layout: Layout, interval: str = "30 seconds", **settings) -> list[StreamingQuery]:
    """First catch up, then keep all six tables running. ``serve`` does the rest as well."""
    run_available(spark, layout, **settings)
    return [start(spark, layout, name, interval, **settings) for name in BRONZE + SILVER]


def serve(spark: SparkSession, layout: Layout, interval: str = "30 seconds", record_every: float = 60.0,
          refresh_every: float = 900.0, compact_every: float = 86_400.0, stop: Callable[[], bool] = lambda: False,
          lowest_wells: bool = False, **settings) -> None:
    """Always-on service: tables running, metrics recorded, aggregates refreshed, closed small files packed, until ``stop``
    says so.

    A stream that fails ends the service with an error; the streams are stopped in any case and go on from their
    checkpoints at the next start. ``record_every`` is how often the history is compared with the checkpoints.
    """
    running = dict(zip(BRONZE + SILVER, start_all(spark, layout, interval, **settings)))
    refreshed, compacted = float("-inf"), time.monotonic()
    try:
        while True:
            ending = stop()
            for name, query in running.items():
                if ending:
                    query.processAllAvailable()
                record(spark, layout, name, **settings)
                if (failure := query.exception()) is not None:
                    raise failure
            if ending or time.monotonic() - refreshed >= refresh_every:
                incremental.refresh(spark, layout, lowest_wells=lowest_wells, as_of=settings.get("as_of"))
                refreshed = time.monotonic()
            if time.monotonic() - compacted >= compact_every:
                for name in running:
                    compact(spark, layout, name)
                compacted = time.monotonic()
            if ending:
                return
            time.sleep(record_every)
    finally:
        for query in running.values():
            query.stop()
