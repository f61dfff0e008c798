"""Session settings and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale. Shuffle partitions start high and adaptive execution merges the
# small ones, so one value serves a laptop-sized run and a cluster-sized one.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "wellops", master: str | None = None,
                  shuffle_partitions: int | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above; ``master`` only for local runs, a cluster sets its own."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SCALE_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run, below the folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset it is below the warehouse, which a cluster shares as well. Folders are named after the
    run and never removed here: their owner decides when a result is no longer read.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/wellops/{purpose}-{uuid.uuid4().hex}"
