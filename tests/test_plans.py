"""What the physical plans must and must not contain."""

from __future__ import annotations

import importlib
import io
import re
from contextlib import redirect_stdout

import pytest
import rows
from pyspark.sql import functions as F

from wellops.plans import bi, features, gold, silver

entry = importlib.import_module("__spark_entry__")
AS_OF = "2024-01-29"


def _plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def _tree(df) -> str:
    return _plan(df).split("\n\n")[0]


@pytest.fixture
def stored(spark, tmp_path):
    """Validated datasets on disk, as the aggregates read them."""
    def write(df, name):
        path = str(tmp_path / name)
        df.write.parquet(path)
        return spark.read.parquet(path)

    return (write(silver.production(rows.readings(spark, *[{"well_id": i} for i in range(20)]), AS_OF), "p"),
            write(silver.wells(rows.wells(spark, *[{"well_id": i, "sap_code": i} for i in range(20)]), AS_OF), "w"),
            write(silver.orders(rows.orders(spark, {})), "o"))


def test_aggregates_read_only_the_columns_they_use(stored):
    plan = _plan(gold.production_by_field(stored[0], stored[1]))
    assert re.findall(r"ReadSchema: (struct<.*?>)", plan)[0] == (
        "struct<reading_id:string,well_id:bigint,oil_bbl:double,bsw_pct:double,wellhead_psi:double,hours_on:double>")
    assert "struct<well_id:bigint,field:string,basin:string>" in plan


def test_period_filter_reaches_the_scan(stored):
    plan = _plan(bi.production_by_field(stored[0], stored[1], bi.Filters(first_day="2020-01-01")))
    assert "GreaterThanOrEqual(prod_date,2020-01-01)" in plan


def test_readings_are_aggregated_before_the_join(stored, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tree = _tree(gold.production_by_field(stored[0], stored[1]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    below_join = tree.split("SortMergeJoin")[1]
    assert below_join.count("HashAggregate") == 2  # partial and final, per well
    # The join key is part of the distinct aggregate, so the join adds no exchange above it
    # but the final one by field.
    assert tree.split("SortMergeJoin")[0].count("Exchange") == 1


def test_small_wells_are_broadcast_by_size_not_by_force(stored):
    tree = _tree(gold.production_by_field(stored[0], stored[1]))
    assert "BroadcastHashJoin" in tree


def test_weekly_features_use_one_window_and_one_sort(stored):
    tree = _tree(features.weekly_features(stored[0], stored[1]))
    assert len(re.findall(r"Window \(", tree)) == 1
    assert len(re.findall(r"Sort \(", tree)) == 1


def test_rules_are_evaluated_in_one_pass_without_a_shuffle(spark):
    df = silver.production(rows.readings(spark, {}), AS_OF)
    assert "Exchange" not in _tree(df)


def test_top_costs_do_not_sort_the_whole_table(stored):
    assert "TakeOrderedAndProject" in _tree(bi.top_costs(stored[2], stored[1]))


@pytest.mark.parametrize("name", [n for n in entry.queries() if not n.startswith(
    ("op", "pipeline", "table_", "stream", "forecast_hold", "forecast_batch", "forecast_err", "scenario", "layer", "run_h", "alias"))])
def test_no_python_no_cross_join_in_any_query(spark, sf_dir, name):
    tree = _tree(entry.queries()[name](spark, sf_dir))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert operator not in tree


def test_hot_well_gives_the_same_totals(spark):
    """One well with a third of all readings: summed before the shuffle, totals unchanged."""
    readings = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("bigint").alias("well_id"),
        F.col("id").cast("string").alias("reading_id"), F.lit(1.0).alias("oil_bbl"), F.lit(10.0).alias("bsw_pct"),
        F.lit(1.0).alias("wellhead_psi"), F.lit(2.0).alias("hours_on"))
    wells = spark.range(50).select(F.col("id").alias("well_id"), F.lit("F").alias("field"), F.lit("B").alias("basin"))
    row = gold.production_by_field(readings, wells).first()
    assert (row["readings"], row["active_wells"], row["total_oil_bbl"]) == (9_000, 50, 9_000.0)
