from __future__ import annotations

import json
import pytest
import rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from wellops import names, schemas
from wellops.plans import bronze, pipeline, silver
from wellops.plans.rules import production_rules
from wellops.sinks import datasets
from wellops.sinks.landing import land_csv, land_feed_batch, land_json
from wellops.sources.landing import infer_schema, remembered_schema, schema_drift
from wellops.streaming import pipeline as streaming

AS_OF = "2024-01-29"
READINGS = ("bronze_production", "silver_production")


def _run(spark, layout, *tables):
    streaming.run_available(spark, layout, tables, as_of=AS_OF)


def _history(spark, *changes):
    return rows.readings(spark, *(changes or ({},)))


def _live(spark, *changes):
    df = rows.readings(spark, *changes)
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.PRODUCTION])


def test_empty_live_folder_then_late_file_then_nothing(spark, layout):
    land_csv(_history(spark, {"well_id": 1}, {"well_id": 2}), layout.landing("production_csv"))
    _run(spark, layout, "bronze_production")
    assert datasets.read(spark, layout, "bronze_production").count() == 2

    land_feed_batch(_live(spark, {"well_id": 3}), layout.landing("production_live"))
    _run(spark, layout, "bronze_production")
    stored = datasets.read(spark, layout, "bronze_production")
    assert stored.count() == 3
    assert stored.filter("source_file IS NULL OR ingested_at IS NULL").count() == 0

    _run(spark, layout, "bronze_production")
    assert datasets.read(spark, layout, "bronze_production").count() == 3
    versions = datasets.history(spark, layout).orderBy("version").collect()
    assert [(r["version"], r["operation_metrics"]["rows"]) for r in versions] == [(0, "2"), (1, "1")]


def test_stream_equals_batch_and_reports_the_same_violations(spark, layout):
    raw = _history(spark, {"well_id": 1}, {"oil_bbl": -5}, {"oil_bbl": 60000}, {"bsw_pct": 120},
                   {"prod_date": "2030-01-01"}, {"prod_date": "31/12/2020"})
    land_csv(raw, layout.landing("production_csv"))
    _run(spark, layout, *READINGS)
    streamed = datasets.read(spark, layout, "silver_production")
    batch = silver.production(raw, AS_OF, "plain", stamp=False)
    columns = batch.columns
    assert sorted(map(str, streamed.select(columns).collect())) == sorted(map(str, batch.collect()))
    from wellops.operators.quality import violations
    counted = violations(silver.production_before_rules(raw), production_rules(AS_OF))
    expected = {r["rule"]: r["violations"] for r in counted.collect()}
    seen = {r["rule"]: r["violations"] for r in pipeline.rule_metrics(spark, layout).collect()}
    assert seen == expected


def test_failing_batch_stops_the_stream_and_leaves_the_table(spark, layout):
    land_csv(_history(spark, {"well_id": 1}), layout.landing("production_csv"))
    _run(spark, layout, *READINGS)
    land_feed_batch(_live(spark, {"well_id": 2}, {"well_id": None}), layout.landing("production_live"))
    with pytest.raises(StreamingQueryException, match="well_id_present"):
        _run(spark, layout, *READINGS)
    assert [r["well_id"] for r in datasets.read(spark, layout, "silver_production").collect()] == [1]


def test_dedup_state_survives_a_restart(spark, layout):
    land_csv(rows.wells(spark, {"well_id": 7}), layout.landing("wells_csv"))
    _run(spark, layout, "bronze_wells", "silver_wells")
    land_csv(rows.wells(spark, {"well_id": 1}, {"well_id": 2, "sap_code": "other"}), layout.landing("wells_csv"),
             mode="append")
    _run(spark, layout, "bronze_wells", "silver_wells")
    assert sorted(r["well_id"] for r in datasets.read(spark, layout, "silver_wells").collect()) == [2, 7]


def test_stream_dedup_of_a_hot_code(spark, layout):
    """One code with a third of all rows, in many files: still one row per code."""
    raw = rows.wells(spark, {}).drop("well_id", "sap_code").crossJoin(spark.range(3_000).select(
        F.col("id").alias("well_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("sap_code")))
    for part in range(2):
        half = raw.filter(F.col("well_id") % 2 == part).repartition(6)
        land_csv(half.select(schemas.WELLS.names), layout.landing("wells_csv"), mode="append")
        _run(spark, layout, "bronze_wells", "silver_wells")
    stored = datasets.read(spark, layout, "silver_wells")
    assert stored.count() == stored.select("sap_code").distinct().count() == 2_001


def test_orders_from_json_with_inferred_schema(spark, layout):
    land_json(rows.orders(spark, {"status": "aberta"}, {"est_cost": -1}), layout.landing("orders_json"))
    _run(spark, layout, "bronze_orders", "silver_orders")
    stored = datasets.read(spark, layout, "silver_orders").collect()
    assert [(r["status"], r["est_cost"]) for r in stored] == [("Aberta", 1000.0)]


def test_schema_is_remembered_and_drift_is_listed(spark, layout):
    path = layout.landing("wells_csv")
    land_csv(rows.wells(spark, {}), path)
    schema = remembered_schema(spark, layout, "wells_csv", "csv")
    assert schema["depth_m"].dataType.simpleString() == "double"
    assert schema_drift(spark, layout, "wells_csv", "csv") == []
    land_csv(rows.wells(spark, {"depth_m": "deep", "well_id": "7"}).withColumn("extra", F.lit(1)), path)
    assert remembered_schema(spark, layout, "wells_csv", "csv") == schema
    assert schema_drift(spark, layout, "wells_csv", "csv") == ["new column extra",
                                                              "column depth_m: double became string"]


def test_known_columns_are_text_and_others_are_inferred(spark, layout):
    path = layout.landing("wells_csv")
    for depth in (1, 2, 3):
        land_csv(rows.wells(spark, {"depth_m": depth}).withColumn("extra", F.lit(5)).coalesce(1), path, mode="append")
    known = names.known_columns(schemas.WELLS, "wells")
    schema = infer_schema(spark, path, "csv", known)
    assert schema["depth_m"].dataType.simpleString() == "string"
    assert schema["extra"].dataType.simpleString() == "int"
    batch = bronze.wells(spark, layout, stream=False)
    assert batch.schema["depth_m"].dataType.simpleString() == "double"
    assert sorted(r["depth_m"] for r in batch.collect()) == [1.0, 2.0, 3.0]


def test_column_of_the_last_file_is_seen(spark, layout):
    path = layout.landing("orders_json")
    for _ in range(4):
        land_json(rows.orders(spark, {}).coalesce(1), path, mode="append")
    land_json(rows.orders(spark, {}).withColumn("late", F.lit(1)).coalesce(1), path, mode="append")
    assert "late" in infer_schema(spark, path, "json").names
    _run(spark, layout, "bronze_orders")
    assert "late" in datasets.read(spark, layout, "bronze_orders").columns


def test_what_does_not_fit_is_rescued(spark, layout):
    path = layout.landing("orders_json")
    land_json(rows.orders(spark, {}), path)
    _run(spark, layout, "bronze_orders")
    good = json.loads(rows.orders(spark, {}).toJSON().first())
    odd = [json.dumps({**good, "order_id": "x7", "vendor": "ACME"}), "not json", "", json.dumps(good)]
    spark.createDataFrame([(line,) for line in odd], "value string").coalesce(1).write.mode("append").text(path)
    _run(spark, layout, "bronze_orders", "silver_orders")
    kept = [json.loads(r["rescued"]) for r in datasets.read(spark, layout, "bronze_orders").filter("rescued is not null").collect()]
    assert sorted(kept, key=len) == [{"_line": "not json"}, {"vendor": "ACME", "order_id": "x7"}]
    with pytest.raises(ValueError, match="new columns: vendor"):
        streaming.run_available(spark, layout, ["bronze_orders"], options={"newColumns": "fail"})


def test_broken_csv_lines_are_rescued(spark, layout):
    path = layout.landing("wells_csv")
    land_csv(rows.wells(spark, {"depth_m": "deep"}), path)
    line = ",".join(["1"] * (len(schemas.WELLS) + 2))
    header = ",".join(schemas.WELLS.names)
    spark.createDataFrame([(header,), (line,)], "value string").coalesce(1).write.mode("append").text(path)
    kept = sorted(r["rescued"] for r in bronze.wells(spark, layout, stream=False).collect())
    assert json.loads(kept[0]) == {"_line": line} or json.loads(kept[1])["_line"] == line
    assert {"depth_m": "deep"} in [json.loads(k) for k in kept]


def test_header_that_differs_from_the_schema_stops_the_stream(spark, layout):
    path = layout.landing("wells_csv")
    land_csv(rows.wells(spark, {}), path)
    _run(spark, layout, "bronze_wells")
    land_csv(rows.wells(spark, {}).withColumnRenamed("basin", "other"), path, mode="append")
    with pytest.raises(StreamingQueryException):
        _run(spark, layout, "bronze_wells")


def test_changed_table_schema_is_refused_with_the_difference(spark, layout):
    land_csv(rows.wells(spark, {}), layout.landing("wells_csv"))
    _run(spark, layout, "bronze_wells", "silver_wells")
    with pytest.raises(ValueError, match="registered_at"):
        streaming.start(spark, layout, "silver_wells", as_of=AS_OF, variant="plain")


def test_service_keeps_running_and_takes_new_files(spark, layout):
    land_csv(_history(spark, {}), layout.landing("production_csv"))
    _run(spark, layout, "bronze_production")
    query = streaming.start(spark, layout, "bronze_production", "200 milliseconds", as_of=AS_OF)
    try:
        land_feed_batch(_live(spark, {"well_id": 5}), layout.landing("production_live"))
        query.processAllAvailable()
        assert query.isActive
        streaming.record(spark, layout, "bronze_production")
        streaming.record(spark, layout, "bronze_production")
    finally:
        query.stop()
    assert datasets.read(spark, layout, "bronze_production").count() == 2
    assert datasets.history(spark, layout).count() == 2


def test_all_tables_as_a_service_then_aggregates(spark, layout, capsys):
    land_csv(rows.wells(spark, {}), layout.landing("wells_csv"))
    land_csv(_history(spark, {}), layout.landing("production_csv"))
    land_json(rows.orders(spark, {}), layout.landing("orders_json"))
    running = streaming.start_all(spark, layout, "200 milliseconds", as_of=AS_OF)
    try:
        assert [q.name.split("@")[0] for q in running] == [*streaming.BRONZE, *streaming.SILVER]
        land_feed_batch(_live(spark, {"well_id": 1}), layout.landing("production_live"))
        running[1].processAllAvailable()
        running[4].processAllAvailable()
        streaming.record(spark, layout, "silver_production", as_of=AS_OF)
    finally:
        for query in running:
            query.stop()
    pipeline.refresh_gold(spark, layout)
    assert datasets.read(spark, layout, "gold_production_by_field").first()["readings"] == 2
    pipeline.show_counts(spark, layout)
    assert "gold_efficiency" in capsys.readouterr().out


def test_union_by_name_and_by_position_agree(spark):
    audit = {"ingested_at": F.lit("2020-01-01 00:00:00").cast("timestamp"), "source_file": F.lit("f")}
    history = _history(spark, {"well_id": 1}).withColumns(audit)
    live = _live(spark, {"well_id": 2}).withColumns(audit)
    a, b = bronze.union_production(history, live), bronze.union_production_sql(history, live)
    assert a.schema.simpleString() == b.schema.simpleString()
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    lacking = bronze.union_production(history, live.drop("source"))
    assert sorted(str(r["source"]) for r in lacking.collect()) == ["None", "SAP_PP"]


def test_portuguese_landing_files(spark, layout):
    land_csv(names.to_portuguese(rows.wells(spark, {}), "wells"), layout.landing("wells_csv"))
    land_csv(names.to_portuguese(_history(spark, {}), "production"), layout.landing("production_csv"))
    land_json(names.to_portuguese(_live(spark, {"well_id": 2}), "production"), layout.landing("production_live"))
    streaming.run_available(spark, layout, ["bronze_wells", "bronze_production", "silver_wells",
                                            "silver_production"], as_of=AS_OF, portuguese=True)
    assert datasets.read(spark, layout, "silver_wells").first()["field"] == "Frade"
    produced = datasets.read(spark, layout, "silver_production")
    assert sorted(r["well_id"] for r in produced.collect()) == [1, 2]
    assert {"vol_oleo_bbl", "ano", "flag_outlier", "_processado_em"} <= set(
        names.to_portuguese(produced, "production").columns)


def test_bounded_micro_batches_become_one_version_each(spark, layout):
    for well in (1, 2, 3):
        land_csv(rows.wells(spark, {"well_id": well}).coalesce(1), layout.landing("wells_csv"), mode="append")
    streaming.run_available(spark, layout, ["bronze_wells"], options={"maxFilesPerTrigger": "1"})
    versions = datasets.history(spark, layout).orderBy("version").collect()
    assert [(r["version"], r["operation_metrics"]["rows"]) for r in versions] == [(0, "1"), (1, "1"), (2, "1")]


def test_feed_batches_add_files_and_compose_ids(spark, layout):
    path = layout.landing("production_live")
    for day in ("2020-01-01", "2020-01-02"):
        batch = _live(spark, {"well_id": 4, "prod_date": day}).withColumn("prod_date", F.col("prod_date").cast("date"))
        land_feed_batch(batch, path, suffix=F.lit("abc123"))
    ids = sorted(r["reading_id"] for r in spark.read.json(path).collect())
    assert ids == ["4_20200101_abc123", "4_20200102_abc123"]


def test_serve_records_and_refreshes(spark, layout):
    land_csv(rows.wells(spark, {}), layout.landing("wells_csv"))
    land_csv(_history(spark, {}), layout.landing("production_csv"))
    land_json(rows.orders(spark, {}), layout.landing("orders_json"))
    turns = iter([False, True])
    streaming.serve(spark, layout, "200 milliseconds", record_every=0.5, stop=lambda: next(turns), as_of=AS_OF)
    done = {(r["dataset"], r["operation"]) for r in datasets.history(spark, layout).collect()}
    assert ("silver_production", "STREAMING UPDATE") in done and ("gold_efficiency", "INCREMENTAL REFRESH") in done
    assert not [q for q in spark.streams.active if layout.root in (q.name or "")]
