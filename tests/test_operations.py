"""Batch pipeline, run history, namespaces, registry and model plans."""

from __future__ import annotations

import math

import pytest
import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wellops import names
from wellops.functions.columns import band, direction, namespace_name, percent_change
from wellops.operators import split
from wellops.operators.metrics import compare_predictors, regression_metrics
from wellops.plans import forecast, pipeline
from wellops.plans.features import FEATURE_COLUMNS, TARGET
from wellops.plans.registry import CHALLENGER, CHAMPION, Registry
from wellops.session import work_dir
from wellops.sinks import catalog, datasets

AS_OF = "2024-01-29"


def _bronze(spark, layout, *readings):
    pipeline.refresh_bronze(spark, layout, rows.wells(spark, {}), rows.readings(spark, *(readings or ({},))),
                            rows.orders(spark, {}, {"est_cost": -1}))


def test_missing_datasets_get_a_marker(spark, layout):
    _bronze(spark, layout)
    counts = {r["dataset"]: (r["layer"], r["row_count"], r["status"])
              for r in pipeline.layer_counts(spark, layout).collect()}
    assert counts["bronze_orders"] == ("BRONZE", 2, "ok")
    assert counts["gold_efficiency"] == ("?", None, "not found")
    assert len(counts) == 9


def test_pipeline_versions_and_rule_metrics(spark, layout):
    _bronze(spark, layout)
    for _ in range(2):
        pipeline.refresh_silver(spark, layout, AS_OF)
        pipeline.refresh_gold(spark, layout)
    history = datasets.history(spark, layout)
    assert {(r["dataset"], r["version"]) for r in history.collect()} >= {("gold_efficiency", 1), ("silver_orders", 1),
                                                                        ("bronze_wells", 0)}
    found = pipeline.rule_metrics(spark, layout).filter("dataset = 'silver_orders' AND rule = 'cost_positive'")
    assert sorted((r["version"], r["violations"]) for r in found.collect()) == [(0, 1), (1, 1)]
    assert datasets.read(spark, layout, "gold_production_by_field").first()["readings"] == 1


def test_failing_refresh_leaves_the_last_version(spark, layout):
    _bronze(spark, layout, {"well_id": 1})
    pipeline.refresh_silver(spark, layout, AS_OF)
    _bronze(spark, layout, {"well_id": 2}, {"well_id": None})
    with pytest.raises(PySparkException, match="well_id_present"):
        pipeline.refresh_silver(spark, layout, AS_OF)
    assert [r["well_id"] for r in datasets.read(spark, layout, "silver_production").collect()] == [1]
    assert datasets.latest(spark, layout, "silver_production")[0] == 0


def test_years_are_gathered_on_request(spark, layout):
    _bronze(spark, layout, *[{"well_id": i, "prod_date": f"20{10 + i % 3}-01-01"} for i in range(30)])
    pipeline.refresh_silver(spark, layout, AS_OF, gather_years=True)
    stored = datasets.read(spark, layout, "silver_production")
    files = stored.select("year", F.col("_metadata.file_name").alias("file")).distinct()
    assert files.count() == 3  # one per year
    assert stored.count() == 30


def test_reading_an_absent_dataset(spark, layout):
    with pytest.raises(ValueError, match="not found"):
        datasets.read(spark, layout, "silver_wells")


def test_namespace_and_named_tables(spark, layout):
    before = spark.catalog.currentDatabase()
    try:
        catalog.use_namespace(spark, "ana_silva", f"{layout.root}/warehouse")
        catalog.save_table(spark.range(3).toDF("id"), "t", "it's a table")
        assert spark.table("ana_silva.t").count() == 3
        comments = spark.sql("DESCRIBE TABLE EXTENDED ana_silva.t").filter("col_name = 'Comment'").first()
        assert comments["data_type"] == "it's a table"
        _bronze(spark, layout)
        pipeline.refresh_silver(spark, layout, AS_OF)
        pipeline.refresh_gold(spark, layout)
        for _ in range(2):
            catalog.expose(spark, layout, "ana_silva", portuguese=True)
        assert spark.table("ana_silva.bronze_orders").count() == 2
        assert spark.catalog.getTable("ana_silva.bronze_orders").description == pipeline.COMMENTS["bronze_orders"]
        own = spark.sql("""SELECT p.campo, count(pr.id_producao) AS medicoes, sum(pr.vol_oleo_bbl) AS total
                           FROM silver_producao pr JOIN silver_pocos p ON pr.id_poco = p.id_poco
                           WHERE pr.ano = 2020 GROUP BY p.campo""").first()
        assert tuple(own) == ("Frade", 1, 100.0)
        assert spark.table("gold_eficiencia_operacional").first()["producao_media_por_poco"] == 100.0
        assert spark.table("gold_custos_manutencao").first()["pocos_afetados"] == 1
    finally:
        spark.catalog.setCurrentDatabase(before)
        catalog.drop_namespace(spark, "ana_silva")
    assert not spark.catalog.databaseExists("ana_silva")
    assert datasets.read(spark, layout, "bronze_orders").count() == 2  # exposed files stay


def test_namespace_names(spark):
    df = spark.createDataFrame([("Ana.Maria-Silva@example.com",), ("root",)], "u string")
    assert [r[0] for r in df.select(namespace_name(F.col("u"))).collect()] == ["ana_maria_silva", "root"]
    assert "@" not in catalog.user_namespace(spark)


def test_work_dir_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a.startswith(f"{base}/wellops/x-") and a != b


def test_glossaries_round_trip(spark):
    df = rows.wells(spark, {})
    own = names.to_portuguese(df, "wells")
    assert {"id_poco", "campo", "latitude"} <= set(own.columns)
    assert names.to_english(own, "wells").columns == df.columns
    for glossary in names.GLOSSARIES.values():
        assert len(set(glossary.values())) == len(glossary)


def test_metrics_on_fixed_predictions(spark):
    df = spark.createDataFrame([(10.0, 12.0, 10.0), (20.0, 18.0, 20.0), (30.0, 34.0, 36.0), (None, 1.0, 1.0)],
                               "y double, a double, b double")
    row = regression_metrics(df, "y", "a").first()
    assert row["mae"] == pytest.approx(8 / 3) and row["rmse"] == pytest.approx(math.sqrt(8))
    assert row["r2"] == pytest.approx(1 - 24 / 200)
    better = {r["metric"]: r["better"] for r in compare_predictors(df, "y", "a", "b").collect()}
    assert better == {"mae": "challenger", "rmse": "champion", "r2": "champion"}
    tie = compare_predictors(df.withColumn("same", F.col("a")), "y", "a", "same")
    assert {r["better"] for r in tie.collect()} == {"champion"}


def test_change_direction_and_band(spark):
    df = spark.createDataFrame([(120.0, 100.0), (50.0, 0.0), (80.0, 100.0), (59_999.0, 1.0), (60_000.0, 1.0),
                                (500_000.0, 1.0)], "p double, b double")
    got = df.select(percent_change(F.col("p"), F.col("b")), direction(F.col("p"), F.col("b")), band(F.col("p"))).collect()
    assert [tuple(r) for r in got[:3]] == [(20.0, "up", "low"), (0.0, "up", "low"), (-20.0, "down", "low")]
    assert [r[2] for r in got[3:]] == ["low", "medium", "medium"]


def _features(spark, n=60):
    return spark.range(n).select(
        F.lit("F").alias("field"), (F.lit(2018) + F.floor(F.col("id") / 50)).cast("int").alias("year"),
        (F.col("id") % 50 + 1).cast("int").alias("week"), (F.col("id") * 100.0).alias(TARGET),
        F.lit(20.0).alias("mean_bsw_pct"), F.lit(500.0).alias("mean_wellhead_psi"), F.lit(60.0).alias("mean_temp_c"),
        F.lit(20.0).alias("mean_hours_on"), F.lit(3).cast("bigint").alias("active_wells"),
        (F.col("id") * 100.0 - 100 + 100).alias("prev_week_oil_bbl"), (F.col("id") * 100.0).alias("mean4_oil_bbl"))


def test_splits_cover_all_rows_once(spark):
    df = _features(spark)
    for train, test in (split.split_by_key(df), split.split_by_time(df, 2018, 40), split.split_random(df)):
        assert train.count() + test.count() == 60
        assert train.intersect(test).count() == 0
    assert split.split_by_time(df, 2018, 40)[0].filter("week >= 40").count() == 0
    assert {r["week"] for r in split.split_by_key(df)[1].filter("year = 2018").collect()} == {
        w for w in range(1, 51) if (2018 * 53 + w) % 5 == 0}


def test_train_register_promote_and_score(spark, layout):
    registry = Registry(spark, layout)
    rows_ = datasets.stored(_features(spark), f"{layout.root}/features")
    small = {"num_trees": 3, "max_depth": 4}
    forecast.train_and_register(registry, rows_, champion=small, challenger={"num_trees": 2, "max_depth": 2})
    name = forecast.MODEL_NAME
    resolved = {r["alias"]: r for r in registry.resolved(name).collect()}
    assert (resolved[CHAMPION]["version"], resolved[CHALLENGER]["version"]) == (1, 2)
    runs = registry.table("model_runs").collect()
    assert len(runs) == 2 and all(set(r["metrics"]) == {"mae", "rmse", "r2"} for r in runs)
    assert {r["metric"] for r in forecast.compare_registered(registry, rows_).collect()} == {"mae", "rmse", "r2"}

    model = registry.load(name)
    scored = forecast.batch_scores(model, rows_)
    assert scored.count() == 60
    assert scored.filter(F.abs(F.col("error_bbl") - (F.col(TARGET) - F.col(forecast.PREDICTION))) > 1e-9).count() == 0
    errors = [r["abs_error_bbl"] for r in forecast.holdout_errors(model, rows_).collect()]
    assert errors == sorted(errors, reverse=True)

    what_if = forecast.scenarios_from_features(rows_)
    assert what_if.columns[2:] == ["scenario", *FEATURE_COLUMNS]
    assert what_if.count() == 180
    out_of_range = what_if.withColumn("mean_hours_on", F.lit(25.0))
    assert forecast.scenario_scores(model, what_if).count() == 180
    named = forecast.scenario_scores(model, out_of_range)
    assert named.count() == 180 and {tuple(r["out_of_range"]) for r in named.collect()} >= {("hours_in_range",)}
    assert all("hours_in_range" in r["out_of_range"] for r in named.collect())

    registry.promote(name, 2)
    assert {r["alias"]: r["version"] for r in registry.aliases().collect()} == {CHAMPION: 2, CHALLENGER: 2}
    with pytest.raises(ValueError, match="no version 9"):
        registry.promote(name, 9)
    with pytest.raises(ValueError, match="no saved model"):
        registry.load(name, "unknown")
