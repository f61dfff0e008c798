"""Aggregates that are refreshed from what is new.

Every measure of the aggregates is a sum or a count, so partial results per well add up:

1. A stream over each validated table sums the rows of a micro-batch per well and writes them to the folder of the
   batch. Spark's checkpoint decides which rows are new; a batch that is repeated replaces its folder.
2. A refresh adds the partial results since the last one to the stored total and publishes that as its next version, which
   names the last batch it holds. So it reads the total, one row per well, and the new batches, and never an old
   reading again.
3. The aggregates follow from the totals and the wells.

The wells themselves can follow the same way: per code the row with the lowest id of all that ever came, so that the result is that of
a batch run whatever the order of arrival (``refresh_wells``), where the streaming table keeps the first arrival.

Distinct wells by field and day are kept as sketches, which merge as well. A well that is not among the validated wells
yet waits, with its days, until it is.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wellops.operators.quality import Rule
from wellops.operators.rollup import merged
from wellops.plans import gold, silver
from wellops.plans.pipeline import publish_gold
from wellops.sinks import datasets
from wellops.sinks.layout import Layout, numbered

#: A sketch has 2 ** SKETCH_BITS registers; the error of an estimate is about 1.04 / sqrt of that, 0.8 %.
SKETCH_BITS = 14
OPERATION = "INCREMENTAL REFRESH"
SEEN, SKETCHES = "total_wells_waiting", "total_active_wells"


@dataclass(frozen=True)
class Partial:
    """What is kept of each micro-batch of a validated table, and the key by which it adds up."""
    table: str
    of: Callable[[DataFrame], DataFrame]
    by: Sequence[str]
    merge: Callable[[DataFrame, Sequence[str]], DataFrame] = merged


def days_of_wells(production: DataFrame) -> DataFrame:
    return production.select("well_id", "prod_date").distinct()


READINGS = Partial("silver_production", gold.readings_per_well, ("well_id",))
ORDERS = Partial("silver_orders", gold.orders_per_well, (*gold.KIND, "well_id"))
DAYS = Partial("silver_production", days_of_wells, ("well_id", "prod_date"))
PARTIALS = {"total_readings_per_well": READINGS, "total_orders_per_well": ORDERS, SEEN: DAYS}


def lowest(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per key the row that comes first by id and then by its other columns, and when the key was last seen.

    Combines before the shuffle, and in any order: the lowest of partial results is the lowest of all rows. Rows without a
    code are one group, an id that is null is the lowest, as in a batch run.
    """
    rest = [c for c in rows.columns if c not in (*by, "well_id", LAST_SEEN)]
    row = F.min(F.struct("well_id", *rest)).alias("row")
    return rows.groupBy(*by).agg(row, F.max(LAST_SEEN).alias(LAST_SEEN)).select(
        *[c if c in (*by, LAST_SEEN) else F.col(f"row.{c}") for c in rows.columns])


def wells_by_code(raw: DataFrame) -> DataFrame:
    return lowest(silver.normalise_wells(raw).withColumn(LAST_SEEN, F.col("ingested_at")), ("sap_code",))


LAST_SEEN, LOWEST, WELLS = "last_seen", "total_wells_by_code", "current_wells"
_KEPT = {**PARTIALS, LOWEST: Partial("bronze_wells", wells_by_code, ("sap_code",), lowest)}


def collect_partials(spark: SparkSession, layout: Layout, name: str, options: dict[str, str] | None = None) -> None:
    """Bring the partial results of a total up to date with its table, and stop."""
    what, folder = _KEPT[name], layout.partials(name)

    def write(df: DataFrame, batch: int) -> None:
        what.of(df).write.mode("overwrite").parquet(f"{folder}/{batch}")

    query = (datasets.read_stream(spark, layout, what.table, options).writeStream.foreachBatch(write).queryName(f"{name}@{layout.root}")
             .option("checkpointLocation", layout.checkpoint(name)).trigger(availableNow=True).start())
    query.awaitTermination()


def _new(spark: SparkSession, layout: Layout, name: str) -> tuple[dict | None, list[int]]:
    """The newest version of a total, and the finished micro-batches that it lacks."""
    last = datasets.newest(spark, layout, name)
    through = int(last["operation_metrics"]["through"]) if last else -1
    done = numbered(spark, f"{layout.checkpoint(name)}/commits")
    return last, [b for b in numbered(spark, layout.partials(name)) if through < b <= (done[-1] if done else -1)]


def pending(spark: SparkSession, layout: Layout, name: str) -> DataFrame | None:
    """The stored total and the partial results it lacks, as rows to be added up; None where there are none."""
    last, batches = _new(spark, layout, name)
    paths = ([last["path"]] if last else []) + [f"{layout.partials(name)}/{b}" for b in batches]
    if not paths:
        return None
    return spark.read.schema(spark.read.parquet(paths[0]).schema).parquet(*paths)


def _refreshed(spark: SparkSession, layout: Layout, name: str, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The total with everything that is new, published where something is. ``keep`` selects what the total goes on with."""
    last, batches = _new(spark, layout, name)
    if batches:
        total = _KEPT[name].merge(pending(spark, layout, name), _KEPT[name].by)
        if keep is not None:
            total = keep(total)
        datasets.publish(spark, layout, name, total, operation=OPERATION, facts={"through": batches[-1]})
    elif last is None:  # a table without rows
        return _KEPT[name].of(datasets.read(spark, layout, _KEPT[name].table))
    return datasets.read(spark, layout, name)


def _sketched(spark: SparkSession, layout: Layout, wells: DataFrame) -> None:
    """Sketches by field and day with the days of wells that are new, or known at last."""
    last, batches = _new(spark, layout, SEEN)
    rows = pending(spark, layout, SEEN)
    if rows is None:
        return
    days, known = rows.distinct(), wells.select("well_id", "field")
    found = days.join(known, "well_id").groupBy("field", "prod_date").agg(F.hll_sketch_agg("well_id", F.lit(SKETCH_BITS)).alias("sketch"))
    before = datasets.newest(spark, layout, SKETCHES)
    if before:
        found = found.unionByName(spark.read.parquet(before["path"])).groupBy("field", "prod_date").agg(
            F.hll_union_agg("sketch").alias("sketch"))
    # Sketches take a well any number of times, so a refresh that ends between these two loses and falsifies nothing.
    datasets.publish(spark, layout, SKETCHES, found, operation=OPERATION)
    through = batches[-1] if batches else int(last["operation_metrics"]["through"])
    datasets.publish(spark, layout, SEEN, days.join(known, "well_id", "left_anti"), operation=OPERATION, facts={"through": through})


def active_wells(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct wells from ``SKETCHES``, by any of field and prod_date (or a column made of them)."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("active_wells"))


def refresh_wells(spark: SparkSession, layout: Layout, as_of: str | None = None, rules: Sequence[Rule] | None = None,
                  forget_after_days: int | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Validated wells, one per code by the lowest id, from the raw rows that are new; published as ``WELLS`` and returned.

    What is kept is one row per code. With ``forget_after_days`` a code that no row had for so long before the newest one
    is forgotten, and a later row of it counts as its first. A run that fails by a rule leaves the published wells as they were.
    """
    collect_partials(spark, layout, LOWEST, options)

    def recent(total: DataFrame) -> DataFrame:
        newest = total.agg(F.max(LAST_SEEN) - F.make_dt_interval(F.lit(forget_after_days)))
        return total.filter(F.col(LAST_SEEN) >= newest.scalar())

    kept = _refreshed(spark, layout, LOWEST, None if forget_after_days is None else recent)
    seen = Observation(f"{WELLS}_{uuid.uuid4().hex}")
    checked = silver.wells(kept.drop(LAST_SEEN), as_of, "dedup", rules, seen)
    datasets.publish(spark, layout, WELLS, checked, "Validated wells, the lowest id of each code", metrics=seen, operation=OPERATION)
    return datasets.read(spark, layout, WELLS)


def refresh(spark: SparkSession, layout: Layout, options: dict[str, str] | None = None, lowest_wells: bool = False,
            as_of: str | None = None) -> None:
    """Refresh the three aggregates and the sketches of a layout of streaming tables from what is new since the last time.

    With ``lowest_wells`` the wells are those of ``refresh_wells``, not the first arrivals.
    """
    for name in PARTIALS:
        collect_partials(spark, layout, name, options)
    wells = refresh_wells(spark, layout, as_of, options=options) if lowest_wells else datasets.read(spark, layout, "silver_wells")
    _sketched(spark, layout, wells)
    publish_gold(spark, layout, _refreshed(spark, layout, "total_readings_per_well"), _refreshed(spark, layout, "total_orders_per_well"),
                 wells, OPERATION)
