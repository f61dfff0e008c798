"""The nine datasets in order of dependency, as batch jobs, and their row counts.

Aggregates read the stored validated datasets, so each raw table is scanned once per run.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wellops.operators.quality import Rule
from wellops.plans import gold, silver
from wellops.sinks import datasets
from wellops.sinks.layout import Layout

COMMENTS = {
    "bronze_wells": "Raw wells (CSV)",
    "bronze_production": "Raw readings: CSV history and live feed",
    "bronze_orders": "Raw work orders (JSON)",
    "silver_wells": "Validated wells, one row per code",
    "silver_production": "Validated daily production",
    "silver_orders": "Validated work orders",
    "gold_production_by_field": "Production by field",
    "gold_maintenance_cost": "Maintenance cost by type and equipment",
    "gold_efficiency": "Operational efficiency by field",
}
DATASETS = tuple(COMMENTS)


def refresh_bronze(spark: SparkSession, layout: Layout, wells: DataFrame, production: DataFrame,
                   orders: DataFrame) -> None:
    for name, df in (("wells", wells), ("production", production), ("orders", orders)):
        datasets.publish(spark, layout, f"bronze_{name}", df, COMMENTS[f"bronze_{name}"])


def refresh_silver(spark: SparkSession, layout: Layout, as_of: str | None = None, variant: str = "dedup",
                   order_rules: Sequence[Rule] | None = None, gather_years: bool = True) -> None:
    """Validate the stored raw datasets; the rule metrics are taken while the rows are written.

    Readings are partitioned by year, so the rows of a year are gathered first; a large year takes many tasks.
    ``gather_years=False`` saves that shuffle where the input is in order of time already.
    """
    columns = "plain" if variant == "plain" else "all"
    seen = {name: Observation(f"dq_{name}") for name in ("wells", "production", "orders")}
    raw = {name: datasets.read(spark, layout, f"bronze_{name}") for name in seen}
    validated = {
        "wells": silver.wells(raw["wells"], as_of, variant, observe=seen["wells"]),
        "production": silver.production(raw["production"], as_of, columns, observe=seen["production"],
                                        gather_years=gather_years),
        "orders": silver.orders(raw["orders"], columns, order_rules, observe=seen["orders"]),
    }
    for name, df in validated.items():
        datasets.publish(spark, layout, f"silver_{name}", df, COMMENTS[f"silver_{name}"],
                         partition_by="year" if name == "production" else None, metrics=seen[name])


def refresh_gold(spark: SparkSession, layout: Layout) -> None:
    """Recompute the three aggregates from the validated datasets.

    They start from readings and orders summed per well, so those rollups are stored and each input is scanned once.
    """
    wells, production, orders = (datasets.read(spark, layout, f"silver_{name}")
                                 for name in ("wells", "production", "orders"))
    per_well = datasets.stored(gold.readings_per_well(production), layout.scratch("readings_per_well"))
    orders_per_well = datasets.stored(gold.orders_per_well(orders), layout.scratch("orders_per_well"))
    publish_gold(spark, layout, per_well, orders_per_well, wells)


def publish_gold(spark: SparkSession, layout: Layout, readings_per_well: DataFrame, orders_per_well: DataFrame, wells: DataFrame,
                 operation: str = "CREATE OR REFRESH") -> None:
    """The three aggregates from readings and orders summed per well."""
    for name, df in (("gold_production_by_field", gold.production_of_wells(readings_per_well, wells)),
                     ("gold_maintenance_cost", gold.maintenance_cost_of_wells(orders_per_well)),
                     ("gold_efficiency", gold.efficiency_of_wells(readings_per_well, wells, orders_per_well))):
        datasets.publish(spark, layout, name, df, COMMENTS[name], operation=operation)


def layer_counts(spark: SparkSession, layout: Layout, names: Sequence[str] = DATASETS) -> DataFrame:
    """Rows per dataset with its layer; one that is absent gets a marker instead of an error.

    One lazy plan; counting parquet rows reads the file footers only.
    """
    parts, known = [], datasets.current(spark, layout, names)
    for name in names:
        if name not in known:
            parts.append(spark.range(1).select(
                F.lit("?").alias("layer"), F.lit(name).alias("dataset"),
                F.lit(None).cast("bigint").alias("row_count"), F.lit("not found").alias("status")))
        else:
            parts.append(spark.read.parquet(known[name][1]).agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name.split("_")[0].upper()).alias("layer"), F.lit(name).alias("dataset"), "row_count",
                F.lit("ok").alias("status")))
    return reduce(DataFrame.unionByName, parts)


def show_counts(spark: SparkSession, layout: Layout) -> None:
    """Print the counts as a table."""
    layer_counts(spark, layout).show(len(DATASETS), truncate=False)


def rule_metrics(spark: SparkSession, layout: Layout) -> DataFrame:
    """Violations per rule, dataset and version, from the run history."""
    return (datasets.history(spark, layout).filter(F.col("layer") == "SILVER")
            .select("dataset", "version", F.explode("operation_metrics").alias("rule", "violations"))
            .filter(~F.col("rule").isin("rows", "kept"))
            .withColumn("violations", F.col("violations").cast("bigint")))
