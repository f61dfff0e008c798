"""Compaction, and readings stored by well."""

from __future__ import annotations

import datetime as dt
import io
import uuid
from contextlib import redirect_stdout

import pytest
import rows
from pyspark.sql import functions as F

from wellops.plans import features, gold, silver
from wellops.sinks import by_well, catalog, commits, compaction, datasets
from wellops.sinks.landing import land_csv
from wellops.streaming import pipeline as streaming

AS_OF = "2024-01-29"
TOMORROW = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=1)
TABLE = "silver_production"


def _readings(spark, first, n):
    return rows.readings(spark, {}).drop("reading_id", "well_id", "prod_date").crossJoin(spark.range(first, first + n).select(
        F.col("id").cast("string").alias("reading_id"), (F.col("id") % 9).cast("string").alias("well_id"),
        F.concat((2010 + F.col("id") % 3).cast("string"), F.lit("-05-17")).alias("prod_date"))).select(*rows.READING)


def _load(spark, layout, first, n, files):
    land_csv(_readings(spark, first, n).repartition(files), layout.landing("production_csv"), mode="append")
    streaming.run_available(spark, layout, ["bronze_production", TABLE], as_of=AS_OF)


def _ids(df):
    return sorted(int(r["reading_id"]) for r in df.select("reading_id").collect())


def test_small_files_become_few_and_streams_go_on(spark, layout):
    land_csv(_readings(spark, 0, 1500).repartition(180), layout.landing("production_csv"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # a task, so a file a year, for each landed file
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        streaming.run_available(spark, layout, ["bronze_production", TABLE], as_of=AS_OF)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    before = datasets.read(spark, layout, TABLE)
    assert len(before.inputFiles()) >= 500
    copy = str(layout.root) + "/copy"

    def downstream():
        query = (datasets.read_stream(spark, layout, TABLE).writeStream.format("parquet").option("checkpointLocation", f"{copy}-log")
                 .trigger(availableNow=True).start(copy))
        query.awaitTermination()
        return _ids(spark.read.parquet(copy))

    assert downstream() == list(range(1500))
    taken, written = streaming.compact(spark, layout, TABLE, before=TOMORROW)
    assert taken >= 500 and written == 3
    after = datasets.read(spark, layout, TABLE)
    assert after.dtypes == before.dtypes and len(after.inputFiles()) == 3
    assert _ids(after) == list(range(1500)) and after.filter("year = 2011").count() == 500
    assert "PartitionFilters" in _plan(after.filter("year = 2011"))
    assert downstream() == list(range(1500))  # nothing twice
    assert streaming.compact(spark, layout, TABLE, before=TOMORROW) is None

    _load(spark, layout, 1500, 300, 2)
    assert _ids(datasets.read(spark, layout, TABLE)) == list(range(1800))
    assert downstream() == list(range(1800))
    streaming.compact(spark, layout, TABLE, before=TOMORROW)  # packed again with the packed ones, which are small
    again = datasets.read(spark, layout, TABLE)
    assert len(again.inputFiles()) == 3 and _ids(again) == list(range(1800))


def test_open_and_large_files_stay(spark, layout):
    _load(spark, layout, 0, 60, 3)
    assert streaming.compact(spark, layout, TABLE) is None  # written today
    assert streaming.compact(spark, layout, TABLE, before=TOMORROW, target=1000) is None
    assert _ids(datasets.read(spark, layout, TABLE)) == list(range(60))


def test_large_folders_become_several_files(spark, layout):
    _load(spark, layout, 0, 3000, 4)
    size = sum(s for _, s, _ in compaction._listed(spark, layout.stream("bronze_production")).values())
    _load(spark, layout, 3000, 3000, 4)
    streaming.compact(spark, layout, "bronze_production", before=TOMORROW, target=size)
    found = datasets.read(spark, layout, "bronze_production")
    assert len(found.inputFiles()) in (2, 3) and _ids(found) == list(range(6000))


def test_of_two_compactions_one_is_committed(spark, layout, monkeypatch):
    _load(spark, layout, 0, 30, 2)
    _load(spark, layout, 30, 30, 2)
    known = compaction.manifest(spark, layout, TABLE)
    assert streaming.compact(spark, layout, TABLE, before=TOMORROW)
    monkeypatch.setattr(compaction, "manifest", lambda *a: known)
    assert streaming.compact(spark, layout, TABLE, before=TOMORROW) is None
    monkeypatch.undo()
    assert commits.versions(spark, layout.compaction(TABLE)) == [0]
    assert _ids(datasets.read(spark, layout, TABLE)) == list(range(60))


def _plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def namespace(spark, tmp_path):
    name, before = f"n_{uuid.uuid4().hex}", spark.catalog.currentDatabase()
    catalog.use_namespace(spark, name, str(tmp_path / "tables"))
    yield name
    spark.catalog.setCurrentDatabase(before)
    catalog.drop_namespace(spark, name)


def _inputs(spark, hot):
    readings = spark.range(9_000).select(
        F.when((F.col("id") % 3 == 0) & F.lit(hot), 0).otherwise(F.col("id") % 450).cast("bigint").alias("well_id"),
        F.col("id").cast("string").alias("reading_id"), F.lit(1.5).alias("oil_bbl"), F.lit(10.0).alias("bsw_pct"), F.lit(1.0).alias("wellhead_psi"),
        F.lit(2.0).alias("hours_on"), F.lit(3.0).alias("temp_c"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("prod_date"))
    wells = spark.range(440).select(F.col("id").alias("well_id"), (F.col("id") % 3).cast("string").alias("field"), F.lit("B").alias("basin"))
    return readings, wells


@pytest.mark.parametrize("hot", [False, True])
def test_rollups_by_bucket_need_no_shuffle_below_the_field(spark, namespace, hot):
    readings, wells = _inputs(spark, hot)
    stored = by_well.store(spark, namespace, readings, wells, buckets=16)
    assert (stored.hot is not None) == hot
    plans = {"field": (by_well.production_by_field(stored), gold.production_by_field(readings, wells)),
             "week": (by_well.weekly_production(stored), features.weekly_production(readings, wells))}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for own, plain in plans.values():
            tree = _plan(own).split("\n\n")[0]
            if not hot:
                assert tree.count("Exchange") == 1  # the one by field
                assert "Exchange" not in tree.split("SortMergeJoin")[1]
            assert sorted(map(tuple, own.collect())) == sorted(map(tuple, plain.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    if hot:
        assert {r["well_id"] for r in stored.hot.select("well_id").distinct().collect()} == {0}
        assert stored.readings.filter("well_id = 0").count() == 0
