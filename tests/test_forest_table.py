"""Predictions of a registered forest by value: from its saved tree nodes by joins, and by going down the trees by hand."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from wellops.plans import forecast, forest_table
from wellops.plans.features import FEATURE_COLUMNS, TARGET
from wellops.plans.registry import CHALLENGER, CHAMPION, Registry

KEY = ("field", "year", "week")


@pytest.fixture(scope="module")
def registered(spark, tmp_path_factory):
    from wellops.sinks.layout import Layout
    ids = spark.range(240)
    values = [((F.xxhash64("id", F.lit(k)) % 1000) / 10 + 100).alias(c) for k, c in enumerate(FEATURE_COLUMNS) if c not in KEY]
    table = ids.select(F.concat(F.lit("f"), F.col("id") % 5).alias("field"), (F.lit(2000) + (F.col("id") / 50).cast("int")).alias("year"),
                       (F.col("id") % 50 + 1).cast("int").alias("week"), *values)
    table = table.withColumn(TARGET, F.col("prev_week_oil_bbl") * 2 + F.col("mean_bsw_pct") - F.col("week"))
    root = tmp_path_factory.mktemp("forest")
    table.write.parquet(f"{root}/features")
    rows = spark.read.parquet(f"{root}/features")
    registry = Registry(spark, Layout(f"{root}/work"))
    forecast.train_and_register(registry, rows, champion={"num_trees": 4, "max_depth": 6}, challenger={"num_trees": 3, "max_depth": 2})
    return registry, rows


def _path(registry, alias):
    return registry.resolved(forecast.MODEL_NAME).filter(F.col("alias") == alias).first()["path"]


def _by_hand(nodes, x):
    """Mean over the trees of the leaf that ``x`` falls into."""
    trees = {}
    for n in nodes:
        trees.setdefault(n["tree"], {})[n["node"]] = n
    values = []
    for tree in trees.values():
        at = tree[0]
        while at["left"] >= 0:
            at = tree[at["left"] if x[at["feature"]] <= at["threshold"] else at["right"]]
        values.append(at["value"])
    return sum(values) / len(values)


def _predictions(registry, rows, alias):
    nodes = forest_table.nodes(registry.spark, _path(registry, alias)).collect()
    return {tuple(r[k] for k in KEY): _by_hand(nodes, [float(r[c]) for c in FEATURE_COLUMNS]) for r in rows.collect()}


@pytest.mark.parametrize("alias", [CHAMPION, CHALLENGER])
def test_model_table_and_hand_agree(spark, registered, alias):
    registry, rows = registered
    want = _predictions(registry, rows, alias)
    assert len(want) == 240 and len(set(want.values())) > 3
    nodes = forest_table.nodes(spark, _path(registry, alias))
    table = forest_table.score(rows, nodes, FEATURE_COLUMNS, KEY).collect()
    assert {tuple(r[k] for k in KEY): r[forest_table.PREDICTED] for r in table} == pytest.approx(want, rel=1e-12)
    scored = forecast.batch_scores(registry.load(forecast.MODEL_NAME, alias), rows).collect()
    assert {tuple(r[k] for k in KEY): r[forecast.PREDICTION] for r in scored} == pytest.approx(want, rel=1e-12)
    assert all(math.isclose(r["error_bbl"], r[TARGET] - want[tuple(r[k] for k in KEY)], rel_tol=1e-9, abs_tol=1e-9) for r in scored)


def test_errors_come_largest_first_with_their_values(registered):
    registry, rows = registered
    want = _predictions(registry, rows, CHAMPION)
    errors = forecast.holdout_errors(registry.load(forecast.MODEL_NAME), rows).collect()
    expected = sorted(((-abs(r[TARGET] - want[tuple(r[k] for k in KEY)]), *[r[k] for k in KEY]) for r in rows.collect()))
    assert [r["abs_error_bbl"] for r in errors] == pytest.approx([-e[0] for e in expected], rel=1e-9, abs=1e-9)
    assert all(a["abs_error_bbl"] >= b["abs_error_bbl"] for a, b in zip(errors, errors[1:]))


def test_scenarios_have_change_and_band_by_value(registered):
    registry, rows = registered
    what_if = forecast.scenarios_from_features(rows)
    nodes = forest_table.nodes(registry.spark, _path(registry, CHAMPION)).collect()
    scored = forecast.scenario_scores(registry.load(forecast.MODEL_NAME), what_if).collect()
    assert len(scored) == 720 and {r["scenario"] for r in scored} == {"as_is", "full_hours", "more_water"}
    for r in scored:
        value = _by_hand(nodes, [float(r[c]) for c in FEATURE_COLUMNS])
        change = 100 * (value - r["prev_week_oil_bbl"]) / r["prev_week_oil_bbl"]
        assert math.isclose(r[forecast.PREDICTION], value, rel_tol=1e-9)
        assert math.isclose(r["change_pct"], change, rel_tol=1e-9, abs_tol=1e-9)
        assert r["direction"] == ("up" if value >= r["prev_week_oil_bbl"] else "down")
        share = value / max(2 * value, 200_000)
        assert r["band"] == ("low" if share < 0.3 else "medium" if share < 0.7 else "high")


def test_null_features_and_no_rows(spark, registered):
    registry, rows = registered
    nodes = forest_table.nodes(spark, _path(registry, CHALLENGER))
    holes = rows.limit(3).withColumn("mean_bsw_pct", F.lit(None).cast("double"))
    got = forest_table.score(holes, nodes, FEATURE_COLUMNS, KEY).collect()
    assert len(got) == 3 and all(r[forest_table.PREDICTED] is None for r in got)
    assert forest_table.score(rows.limit(0), nodes, FEATURE_COLUMNS, KEY).count() == 0
