"""What keeps tasks small where tables are large: writes by folder without a sort, buckets that follow the rows, and raw rows
that are parsed without building maps for each."""

from __future__ import annotations

import io
import json
from contextlib import redirect_stdout

import rows
from pyspark.sql import functions as F
from test_layouts import _inputs, namespace  # noqa: F401

from wellops.plans import bronze, features, gold, silver
from wellops.sinks import by_well, datasets
from wellops.sinks.landing import land_csv, land_json
from wellops.streaming import pipeline as streaming

AS_OF = "2024-01-29"
SETTING = "spark.sql.maxConcurrentOutputFileWriters"


def _readings(spark):
    return rows.readings(spark, *[{"reading_id": k, "prod_date": f"{2000 + k % 5}-05-17"} for k in range(100)])


def test_writes_by_folder_keep_files_open(spark, layout, monkeypatch):
    before, seen = spark.conf.get(SETTING), []
    df = _readings(spark).withColumn("year", F.year(F.col("prod_date").cast("date"))).repartition(1)
    monkeypatch.setattr(type(df.write), "partitionBy", _spy(type(df.write).partitionBy, spark, seen))
    datasets.publish(spark, layout, "silver_production", df, partition_by="year")
    assert seen == ["64"] and spark.conf.get(SETTING) == before
    found = datasets.read(spark, layout, "silver_production")
    assert {(r["reading_id"], r["year"]) for r in found.collect()} == {(str(k), 2000 + k % 5) for k in range(100)}


def test_streams_by_folder_keep_files_open(spark, layout):
    before = spark.conf.get(SETTING)
    spark.conf.set(SETTING, "0")
    try:
        land_csv(_readings(spark).repartition(1), layout.landing("production_csv"))
        streaming.run_available(spark, layout, ["bronze_production", "silver_production"], as_of=AS_OF)
        assert spark.conf.get(SETTING) == "64"  # the sink reads it at every micro-batch
        found = datasets.read(spark, layout, "silver_production")
        assert {(int(r["reading_id"]), r["year"]) for r in found.collect()} == {(k, 2000 + k % 5) for k in range(100)}
    finally:
        spark.conf.set(SETTING, before)


def _spy(plain, spark, seen):
    def call(self, *columns):
        seen.append(spark.conf.get(SETTING))
        return plain(self, *columns)
    return call


def test_more_rows_than_buckets_hold(spark, namespace, monkeypatch):  # noqa: F811
    monkeypatch.setattr(by_well, "BUCKET_ROWS", 100)
    readings, wells = _inputs(spark, False)
    stored = by_well.store(spark, namespace, readings.unionByName(readings.limit(5).withColumn("well_id", F.lit(None).cast("bigint"))), wells, buckets=16)
    ddl = spark.sql(f"SHOW CREATE TABLE {namespace}.readings_by_well").first()[0]
    assert "INTO 91 BUCKETS" in ddl
    assert stored.readings.count() == 9_005 and stored.hot is None
    assert sorted(map(tuple, by_well.production_by_field(stored).collect())) == sorted(map(tuple, gold.production_by_field(readings, wells).collect()))


def test_maps_are_built_for_rows_to_rescue_only(spark, layout):
    good = dict(rows.ORDER)
    lines = [json.dumps(x) for x in (good, {**good, "order_id": "x2"}, {**good, "vendor": "V", "order_id": "3"}, {**good, "est_cost": " "})] + ["no json", ""]
    land_json(spark.createDataFrame([tuple(good.values())], list(good)), layout.landing("orders_json"))
    streaming.run_available(spark, layout, ["bronze_orders"], as_of=AS_OF)
    spark.createDataFrame([(x,) for x in lines], "value string").write.mode("append").text(layout.landing("orders_json"))
    df = bronze.orders(spark, layout, stream=False)
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    assert out.getvalue().count("from_json(MapType(StringType,StringType,true), value") == 1  # once a line, not at every use
    assert sorted((r["rescued"] for r in df.collect() if r["rescued"]), key=len) == [
        '{"vendor":"V"}', '{"order_id":"x2"}', '{"_line":"no json"}']


PARTS = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_batch_writes_take_tables_in_small_parts(spark, layout, monkeypatch):
    before, seen = [spark.conf.get(name) for name in PARTS], []
    df = _readings(spark)
    plain = type(df.write).parquet
    monkeypatch.setattr(type(df.write), "parquet", lambda self, path: (seen.append([spark.conf.get(name) for name in PARTS]), plain(self, path))[1])
    datasets.publish(spark, layout, "bronze_production", df)
    datasets.stored(df, layout.scratch("stored"))
    assert seen == [[str(16 << 20), str(32 << 20)]] * 2
    assert [spark.conf.get(name) for name in PARTS] == before
    spark.conf.set(PARTS[0], "1m")
    try:
        datasets.stored(df, layout.scratch("stored"))
        assert seen[-1][0] == str(1 << 20) and spark.conf.get(PARTS[0]) == "1m"  # smaller settings stay
    finally:
        spark.conf.set(PARTS[0], before[0])


def test_only_the_year_is_derived_before_rows_are_gathered(spark):
    plain, gathered = (silver.production(_readings(spark), AS_OF, stamp=False, gather_years=g) for g in (False, True))
    assert gathered.schema == plain.schema
    assert sorted(gathered.collect()) == sorted(plain.collect())
    out = io.StringIO()
    with redirect_stdout(out):
        gathered.explain("extended")
    analyzed = out.getvalue().split("== Analyzed")[1].split("== Optimized")[0]
    below = analyzed.split("RebalancePartitions")[1]
    assert "AS year" in below and not any(f"AS {c}#" in below for c in ("is_outlier", "is_high_bsw", "month", "day"))


def test_weeks_hold_no_row_of_sums_per_well(spark):
    """Wells are not told apart by an aggregate of their own, and copies of a well count as they did."""
    readings = silver.production(_readings(spark), AS_OF).unionByName(silver.production(
        rows.readings(spark, *[{"reading_id": k, "well_id": w, "prod_date": "2001-05-17"} for k, w in enumerate((2, 2, 3, 4, 9))]), AS_OF))
    wells = spark.createDataFrame([(1, "A"), (1, "A"), (1, "B"), (2, "A"), (2, "A"), (3, None), (3, None), (4, "B"), (None, "A")],
                                  "well_id long, field string")
    df = features.weekly_production(readings, wells)
    joined = features.weekly_per_well(readings).join(wells, "well_id")
    assert sorted(map(str, df.collect())) == sorted(map(str, features.weekly_of_located(joined).collect()))
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    assert not any("keys=[field" in line and "well_id" in line.split("functions=")[0] for line in out.getvalue().splitlines())
