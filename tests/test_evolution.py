from __future__ import annotations

import datetime as dt
import json

import pytest
import rows
from pyspark.sql import functions as F

from wellops.sinks import commits, datasets, evolution
from wellops.sinks.landing import land_csv, land_json
from wellops.streaming import pipeline as streaming

TABLES = ("bronze_orders", "silver_orders")


def _run(spark, layout, *tables):
    streaming.run_available(spark, layout, tables or TABLES, options={"newColumns": "add"})


def _land(spark, layout, *more, source="orders_json", default=rows.ORDER):
    lines = [json.dumps({**default, **m}) for m in more]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(layout.landing(source))


def _values(spark, layout, table, *columns):
    return [tuple(r) for r in datasets.read(spark, layout, table).select(*columns).orderBy("order_id").collect()]


def test_a_late_field_is_a_column_after_the_restart_and_old_rows_have_it(spark, layout):
    _land(spark, layout, {"order_id": 1})
    _run(spark, layout)
    _land(spark, layout, {"order_id": 2, "vendor": "ACME"}, {"order_id": 3, "est_cost": "x"})
    _run(spark, layout)
    assert "vendor" not in datasets.read(spark, layout, "bronze_orders").columns
    _land(spark, layout, {"order_id": 4, "vendor": "Best"})
    _run(spark, layout)
    for table in TABLES:
        seen = _values(spark, layout, table, "order_id", "vendor")
        assert [s for s in seen if s[0] != 3] == [(1, None), (2, "ACME"), (4, "Best")]
    # Where it was a column from the start it is stored as one, and what is no new column stays rescued.
    assert _values(spark, layout, "bronze_orders", "order_id", "rescued") == [
        (1, None), (2, None), (3, '{"est_cost":"x"}'), (4, None)]


def test_types_widen_and_misfits_are_never_lost(spark, layout):
    _land(spark, layout, {"order_id": 1, "n": 5, "ok": True, "big": 2**60, "code": "007"})
    _run(spark, layout)  # inferred with the first files, so these are plain columns
    _land(spark, layout, {"order_id": 2, "size": 5, "flag": True, "id18": 2**60, "zip": "007", "deep": {"a": [1]}})
    _run(spark, layout)
    _run(spark, layout)
    kinds = {a.name: a.kind for a in evolution.added(spark, layout, "orders_json")}
    assert kinds == {"size": "bigint", "flag": "boolean", "id18": "bigint", "zip": "string", "deep": "string"}
    assert _values(spark, layout, "bronze_orders", "order_id", "size", "flag", "id18", "zip", "deep")[1] == (
        2, 5, True, 2**60, "007", '{"a":[1]}')
    _land(spark, layout, {"order_id": 3, "size": 2.5, "id18": 0.5, "flag": "perhaps"})
    _run(spark, layout)
    # Read as text already, but the types are those of the last look: shown as rescued until the next one.
    assert json.loads(_values(spark, layout, "bronze_orders", "order_id", "rescued")[2][1]) == {
        "size": "2.5", "id18": "0.5", "flag": "perhaps"}
    _run(spark, layout)
    kinds = {a.name: a.kind for a in evolution.added(spark, layout, "orders_json")}
    assert (kinds["size"], kinds["id18"], kinds["flag"]) == ("double", "string", "string")
    for table in TABLES:
        assert _values(spark, layout, table, "order_id", "size", "id18", "flag", "rescued")[1:] == [
            (2, 5.0, str(2**60), "true", None), (3, 2.5, "0.5", "perhaps", None)]


def test_names_a_table_cannot_hold_stay_rescued(spark, layout):
    _land(spark, layout, {"order_id": 1})
    _run(spark, layout)
    _land(spark, layout, {"order_id": 2, "Status": "a", "processed_at": "b", "custo_real_brl": "7", "a.b": "c", "A.B": "d", "with blank`": "e",
                          "nothing": None})
    _run(spark, layout)
    _run(spark, layout)
    assert [a.name for a in evolution.added(spark, layout, "orders_json")] == ["A.B", "with blank`"]
    found = datasets.read(spark, layout, "bronze_orders").filter("order_id = 2").first().asDict()
    assert (found["A.B"], found["with blank`"]) == ("d", "e")
    left = json.loads(found["rescued"])
    assert {k: v for k, v in left.items() if v is not None} == {"Status": "a", "processed_at": "b", "custo_real_brl": "7", "a.b": "c"}


def test_a_known_column_that_comes_late_has_its_known_type(spark, layout):
    first = {k: v for k, v in rows.ORDER.items() if k != "actual_cost"}
    _land(spark, layout, {"order_id": 1}, default=first)
    _run(spark, layout, "bronze_orders")
    _land(spark, layout, {"order_id": 2, "actual_cost": 12})
    _run(spark, layout, "bronze_orders")
    _land(spark, layout, {"order_id": 3, "actual_cost": 2.5})
    _run(spark, layout, "bronze_orders")
    assert dict(datasets.read(spark, layout, "bronze_orders").dtypes)["actual_cost"] == "double"
    assert _values(spark, layout, "bronze_orders", "order_id", "actual_cost") == [(1, None), (2, 12.0), (3, 2.5)]


def test_the_live_feed_gains_columns_beside_a_history_without_them(spark, layout):
    land_csv(rows.readings(spark, {"well_id": 1}), layout.landing("production_csv"))
    tables = ("bronze_production", "silver_production")
    _run(spark, layout, *tables)
    _land(spark, layout, {"well_id": 2, "choke": 0.5}, source="production_live", default=rows.READING)
    _run(spark, layout, *tables)
    _land(spark, layout, {"well_id": 3, "choke": 1}, source="production_live", default=rows.READING)
    _run(spark, layout, *tables)
    for table in tables:
        seen = datasets.read(spark, layout, table).select("well_id", "choke", "rescued").orderBy("well_id").collect()
        assert [tuple(r) for r in seen] == [(1, None, None), (2, 0.5, None), (3, 1.0, None)]
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=1)
    assert streaming.compact(spark, layout, "silver_production", before=later) is not None
    seen = datasets.read(spark, layout, "silver_production").select("well_id", "choke").orderBy("well_id").collect()
    assert [tuple(r) for r in seen] == [(1, None), (2, 0.5), (3, 1.0)]


def test_only_rows_since_the_last_look_are_read(spark, layout):
    _land(spark, layout, {"order_id": 1})
    _run(spark, layout, "bronze_orders")
    _land(spark, layout, {"order_id": 2, "vendor": "x"})
    _run(spark, layout, "bronze_orders")
    assert [a.name for a in evolution.evolve(spark, layout, "bronze_orders")] == ["vendor"]
    before = commits.newest(spark, layout.schema_versions("orders_json"))
    assert [a.name for a in evolution.evolve(spark, layout, "bronze_orders")] == ["vendor"]
    assert commits.newest(spark, layout.schema_versions("orders_json")) == before  # nothing new to look at


def test_too_many_names_and_other_modes(spark, layout):
    _land(spark, layout, {"order_id": 1})
    streaming.run_available(spark, layout, TABLES)
    _land(spark, layout, {"order_id": 2, "a": 1, "b": 2, "c": 3})
    streaming.run_available(spark, layout, TABLES)
    streaming.run_available(spark, layout, TABLES)
    assert evolution.added(spark, layout, "orders_json") == []  # rescued unless asked for
    with pytest.raises(ValueError, match="more than 2 new columns"):
        evolution.evolve(spark, layout, "bronze_orders", max_new=2)
    assert len(evolution.evolve(spark, layout, "bronze_orders")) == 3
    streaming.run_available(spark, layout, TABLES, options={"newColumns": "fail"})  # known by now


def test_nothing_to_look_at(spark, layout):
    assert evolution.evolve(spark, layout, "bronze_production") == []
    land_json(rows.orders(spark, {}).withColumn("order_id", F.lit(1)), layout.landing("orders_json"))
    _run(spark, layout)
    assert evolution.evolve(spark, layout, "bronze_orders") == []
