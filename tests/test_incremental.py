"""Aggregates refreshed from what is new."""

from __future__ import annotations

import math

import pytest
import rows
from pyspark.sql import functions as F

from wellops.plans import gold, silver
from wellops.sinks import datasets
from wellops.sinks.landing import land_csv, land_feed_batch, land_json
from wellops.streaming import incremental
from wellops.streaming import pipeline as streaming

AS_OF = "2024-01-29"
TOTAL = "total_readings_per_well"


def _close(a, b):
    a, b = ([tuple(r) for r in df.orderBy(df.columns[0]).collect()] for df in (a, b))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all(math.isclose(p, q, rel_tol=1e-9) if isinstance(p, float) else p == q for p, q in zip(x, y))


def _table(spark, layout, name, df, files):
    df.repartition(files).write.mode("append").parquet(layout.stream(name))
    if datasets.newest(spark, layout, name) is None:
        from wellops.sinks import commits
        commits.commit_next(spark, layout.history(name), datasets.entry(name, "x", {}, layout.stream(name), ""))


def test_a_hundred_micro_batches_equal_a_full_recompute(spark, layout):
    n = 4_000
    readings = silver.production(rows.readings(spark, {}), AS_OF).drop("well_id", "reading_id", "oil_bbl", "prod_date").crossJoin(
        spark.range(n).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("well_id"), F.col("id").cast("string").alias("reading_id"),
            F.when(F.col("id") % 11 != 0, F.col("id") * 0.37).alias("oil_bbl"),
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("prod_date")))
    wells = silver.wells(rows.wells(spark, *[{"well_id": k, "sap_code": k, "field": f"f{k % 3}"} for k in range(30)]), AS_OF)
    orders = silver.orders(rows.orders(spark, *[{"well_id": k % 4, "order_id": k} for k in range(20)]))
    _table(spark, layout, "silver_production", readings, 100)
    _table(spark, layout, "silver_wells", wells, 1)
    _table(spark, layout, "silver_orders", orders, 2)
    incremental.refresh(spark, layout, options={"maxFilesPerTrigger": "1"})
    assert datasets.newest(spark, layout, TOTAL)["operation_metrics"]["through"] == "99"
    stored = [datasets.read(spark, layout, f"silver_{t}") for t in ("production", "wells", "orders")]

    def check():
        _close(datasets.read(spark, layout, "gold_production_by_field"), gold.production_by_field(stored[0], stored[1]))
        _close(datasets.read(spark, layout, "gold_efficiency"), gold.efficiency(*stored))
        _close(datasets.read(spark, layout, "gold_maintenance_cost"), gold.maintenance_cost(stored[2]))
        exact = stored[0].join(stored[1], "well_id").groupBy("field", "prod_date").agg(F.countDistinct("well_id").alias("active_wells"))
        found = incremental.active_wells(datasets.read(spark, layout, incremental.SKETCHES), "field", "prod_date")
        assert sorted(map(tuple, exact.collect())) == sorted(map(tuple, found.collect()))

    check()
    # More rows: only they are read.
    more = readings.withColumn("reading_id", F.concat(F.lit("n"), "reading_id")).filter("well_id > 20").withColumn("prod_date", F.lit("2021-05-05").cast("date"))
    _table(spark, layout, "silver_production", more, 3)
    incremental.collect_partials(spark, layout, TOTAL)
    files = incremental.pending(spark, layout, TOTAL).inputFiles()
    old = datasets.newest(spark, layout, TOTAL)["path"]
    assert {f.rsplit("/", 2)[1] for f in files if old not in f} == {"100"}
    assert not [f for f in files if "/streams/" in f]
    incremental.refresh(spark, layout)
    stored[0] = datasets.read(spark, layout, "silver_production")
    check()
    # Nothing new: no new total.
    version = datasets.newest(spark, layout, TOTAL)["version"]
    incremental.refresh(spark, layout)
    assert datasets.newest(spark, layout, TOTAL)["version"] == version
    # A well that becomes known brings its readings with it.
    _table(spark, layout, "silver_wells", silver.wells(rows.wells(spark, {"well_id": 35, "sap_code": "late", "field": "f1"}), AS_OF), 1)
    incremental.refresh(spark, layout)
    stored[1] = datasets.read(spark, layout, "silver_wells")
    check()


def test_a_batch_without_a_commit_is_left_for_the_next_refresh(spark, layout):
    """A driver lost in the middle of a batch leaves a folder; it is not counted, and replaced when the batch runs again."""
    _table(spark, layout, "silver_production", silver.production(rows.readings(spark, {"well_id": 1}), AS_OF), 1)
    incremental.collect_partials(spark, layout, TOTAL)
    gold.readings_per_well(silver.production(rows.readings(spark, {"well_id": 99}), AS_OF)).write.parquet(f"{layout.partials(TOTAL)}/1")
    assert [r["well_id"] for r in incremental.pending(spark, layout, TOTAL).collect()] == [1]
    _table(spark, layout, "silver_production", silver.production(rows.readings(spark, {"well_id": 2}), AS_OF), 1)
    incremental.collect_partials(spark, layout, TOTAL)
    assert sorted(r["well_id"] for r in incremental.pending(spark, layout, TOTAL).collect()) == [1, 2]


def test_sketches_of_many_wells_are_within_two_percent(spark):
    production = spark.range(200_000).select(F.col("id").alias("well_id"), F.lit("f").alias("field"), (F.col("id") % 7).alias("prod_date"))
    parts = production.groupBy("field", "prod_date").agg(F.hll_sketch_agg("well_id", F.lit(incremental.SKETCH_BITS)).alias("sketch"))
    estimate = incremental.active_wells(parts, "field").first()["active_wells"]
    assert estimate == pytest.approx(200_000, rel=0.02)


def test_streams_then_refresh(spark, layout):
    land_csv(rows.wells(spark, {}), layout.landing("wells_csv"))
    land_csv(rows.readings(spark, {}), layout.landing("production_csv"))
    land_json(rows.orders(spark, {}), layout.landing("orders_json"))
    streaming.run_available(spark, layout, as_of=AS_OF)
    incremental.refresh(spark, layout)
    live = silver.production(rows.readings(spark, {"reading_id": "2", "oil_bbl": 50.0}), AS_OF).select(*rows.READING)
    land_feed_batch(live, layout.landing("production_live"))
    streaming.run_available(spark, layout, as_of=AS_OF)
    incremental.refresh(spark, layout)
    row = datasets.read(spark, layout, "gold_production_by_field").first()
    assert (row["readings"], row["total_oil_bbl"]) == (2, 150.0)
