"""One row per well code on a stream, by the lowest id, whatever the order of arrival."""

from __future__ import annotations

import itertools

import pytest
import rows
from pyspark.sql import functions as F

from wellops import schemas
from wellops.plans import silver
from wellops.sinks import datasets
from wellops.sinks.landing import land_csv
from wellops.sinks.layout import Layout, create_landing
from wellops.streaming import incremental
from wellops.streaming import pipeline as streaming

AS_OF = "2024-01-29"
LOADS = ([{"well_id": 7, "sap_code": "a"}, {"well_id": 4, "sap_code": "b"}],
         [{"well_id": 2, "sap_code": "a", "field": "frade"}, {"well_id": 2, "sap_code": "a", "field": "abc"}, {"well_id": 9, "sap_code": "c"}],
         [{"well_id": 5, "sap_code": "b"}, {"well_id": 3, "sap_code": "a"}, {"well_id": 6, "sap_code": None}, {"well_id": 8, "sap_code": None}])


def _load(spark, layout, changes, k):
    land_csv(rows.wells(spark, *changes), layout.landing("wells_csv"), mode="append" if k else "overwrite")
    streaming.run_available(spark, layout, ["bronze_wells"])


def _shown(df):
    return sorted(map(str, df.select(*schemas.WELL_COLUMNS).collect()))


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_any_order_of_arrival_gives_the_batch_result(spark, tmp_path, order):
    layout = Layout(str(tmp_path / "root"))
    create_landing(spark, layout)
    for k, load in enumerate(order):
        _load(spark, layout, LOADS[load], k)
        found = incremental.refresh_wells(spark, layout, AS_OF, rules=[])
        so_far = [c for part in order[:k + 1] for c in LOADS[part]]
        assert _shown(found) == _shown(silver.wells(rows.wells(spark, *so_far), AS_OF, rules=[]))
    before = datasets.newest(spark, layout, incremental.LOWEST)["version"]
    assert _shown(incremental.refresh_wells(spark, layout, AS_OF, rules=[])) == _shown(found)  # nothing new
    assert datasets.newest(spark, layout, incremental.LOWEST)["version"] == before


def test_rules_see_the_survivors_and_are_counted(spark, layout):
    _load(spark, layout, [{"well_id": 1, "sap_code": "a", "depth_m": -5}, {"well_id": 2, "sap_code": "a"}, {"well_id": 3, "sap_code": "b"}], 0)
    found = incremental.refresh_wells(spark, layout, AS_OF)
    assert _shown(found) == _shown(silver.wells(
        rows.wells(spark, {"well_id": 1, "sap_code": "a", "depth_m": -5}, {"well_id": 3, "sap_code": "b"}), AS_OF))
    seen = datasets.newest(spark, layout, incremental.WELLS)["operation_metrics"]
    assert seen["rows"] == "2" and int(seen["kept"]) == found.count()


def test_codes_not_seen_for_long_are_forgotten(spark, layout):
    _load(spark, layout, [{"well_id": 1, "sap_code": "a"}, {"well_id": 2, "sap_code": "b"}], 0)
    incremental.refresh_wells(spark, layout, AS_OF, rules=[])
    # As if the first rows were of forty days ago.
    name, last = incremental.LOWEST, datasets.newest(spark, layout, incremental.LOWEST)
    old = spark.read.parquet(last["path"]).withColumn("last_seen", F.col("last_seen") - F.make_dt_interval(F.lit(40)))
    datasets.publish(spark, layout, name, old, operation="x", facts={"through": last["operation_metrics"]["through"]})
    _load(spark, layout, [{"well_id": 5, "sap_code": "b"}], 1)
    found = incremental.refresh_wells(spark, layout, AS_OF, rules=[], forget_after_days=30)
    assert [(r["well_id"], r["sap_code"]) for r in found.collect()] == [(2, "b")]


def test_an_empty_raw_table(spark, layout):
    _load(spark, layout, [{"well_id": 1}], 0)
    raw = datasets.read(spark, layout, "bronze_wells")
    assert incremental.wells_by_code(raw.limit(0)).count() == 0
