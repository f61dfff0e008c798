"""Production forecast: training, comparison, scoring of tables and of scenarios.

Training and scoring are Spark jobs over the weekly feature table. Training reads its input several
times, so the features are written once and read from there.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellops.functions.columns import band, direction, percent_change
from wellops.operators.metrics import METRICS, compare_predictors, regression_metrics
from wellops.operators.quality import Rule, expect
from wellops.operators.split import split_by_key
from wellops.plans.features import FEATURE_COLUMNS, TARGET
from wellops.plans.registry import CHALLENGER, CHAMPION, Registry

MODEL_NAME = "production_decline"
PREDICTION = "predicted_oil_bbl"

# Settings of the two models. The champion's trees are limited by nothing but the depth of 30 that Spark
# allows. Growing them costs per node, so a caller who wants a cheaper forest passes a larger
# min_rows_per_leaf.
CHAMPION_PARAMS = {"num_trees": 100, "max_depth": 30, "min_rows_per_leaf": 1, "seed": 42}
CHALLENGER_PARAMS = {"num_trees": 200, "max_depth": 10, "min_rows_per_leaf": 1, "seed": 42}
# Rows are drawn for the trees partition by partition, so their number is part of the model.
TRAIN_PARTITIONS = 8

# What a scenario should look like. A row outside these ranges is scored and named, never left out.
SCENARIO_RULES = (
    expect("week_in_range", "week BETWEEN 1 AND 53"),
    expect("bsw_in_range", "mean_bsw_pct BETWEEN 0 AND 100"),
    expect("pressure_in_range", "mean_wellhead_psi BETWEEN 50 AND 5000"),
    expect("temperature_in_range", "mean_temp_c BETWEEN 30 AND 150"),
    expect("hours_in_range", "mean_hours_on BETWEEN 0 AND 24"),
    expect("wells_in_range", "active_wells >= 1"),
    expect("volumes_not_negative", "prev_week_oil_bbl >= 0 AND mean4_oil_bbl >= 0"),
)


def train(rows: DataFrame, num_trees: int, max_depth: int, min_rows_per_leaf: int = 1, seed: int = 42,
          partitions: int = TRAIN_PARTITIONS) -> PipelineModel:
    """Random forest on the eight features; every tree may use all of them at each split.

    ``rows`` should be a stored table. It is dealt by key over a fixed number of partitions and sorted in
    each, so that the same rows and seed give the same forest on any number of cores.
    """
    forest = RandomForestRegressor(labelCol=TARGET, featuresCol="features", predictionCol=PREDICTION,
                                   numTrees=num_trees, maxDepth=max_depth, minInstancesPerNode=min_rows_per_leaf,
                                   seed=seed, featureSubsetStrategy="all", maxMemoryInMB=1024, cacheNodeIds=True)
    stages = [VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features"), forest]
    key = ("field", "year", "week")
    return Pipeline(stages=stages).fit(rows.repartition(partitions, *key).sortWithinPartitions(*key))


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Adds the prediction; runs on the executors, nothing is collected."""
    return model.transform(rows).drop("features")


def holdout_errors(model: PipelineModel, test: DataFrame) -> DataFrame:
    """Held-out rows with the absolute error, largest first."""
    return (score(model, test)
            .select("field", "year", "week", TARGET, PREDICTION,
                    F.abs(F.col(TARGET) - F.col(PREDICTION)).alias("abs_error_bbl"))
            .orderBy(F.desc("abs_error_bbl"), "field", "year", "week"))


def batch_scores(model: PipelineModel, features: DataFrame) -> DataFrame:
    """The whole feature table with prediction and signed error."""
    return (score(model, features).select("field", "year", "week", TARGET, PREDICTION)
            .withColumn("error_bbl", F.col(TARGET) - F.col(PREDICTION)))


def train_and_register(registry: Registry, features: DataFrame, name: str = MODEL_NAME,
                       champion: dict[str, int] | None = None,
                       challenger: dict[str, int] | None = None) -> None:
    """Train both models on the same split; log, register and alias them.

    ``features`` should be a stored table, see ``datasets.stored``.
    """
    train_rows, test_rows = split_by_key(features)
    for alias, params in ((CHAMPION, champion or CHAMPION_PARAMS), (CHALLENGER, challenger or CHALLENGER_PARAMS)):
        model = train(train_rows, **params)
        metrics = regression_metrics(score(model, test_rows), TARGET, PREDICTION).first().asDict()
        run_id = registry.log_run(f"{name}_{alias}", params, {m: float(metrics[m]) for m in METRICS}, model)
        registry.set_alias(name, alias, registry.register(name, run_id))


def compare_registered(registry: Registry, test: DataFrame, name: str = MODEL_NAME) -> DataFrame:
    """Champion and challenger over the same rows, in one pass."""
    scored = test
    for alias in (CHAMPION, CHALLENGER):
        scored = score(registry.load(name, alias), scored).withColumnRenamed(PREDICTION, alias)
    return compare_predictors(scored, TARGET, CHAMPION, CHALLENGER)


def with_change_and_band(scored: DataFrame, prediction: str = PREDICTION,
                         base: str = "prev_week_oil_bbl") -> DataFrame:
    """Change against last week in percent, its direction, and the band of the prediction."""
    value, last = F.col(prediction), F.col(base)
    return scored.withColumns({"change_pct": percent_change(value, last), "direction": direction(value, last),
                               "band": band(value)})


def scenario_scores(model: PipelineModel, scenarios: DataFrame,
                    rules: tuple[Rule, ...] = SCENARIO_RULES) -> DataFrame:
    """Score every what-if row, with change and band; ``out_of_range`` lists the rules a row breaks."""
    broken = F.array_compact(F.array(*[F.when(~rule.holds(), F.lit(rule.name)) for rule in rules]))
    return with_change_and_band(score(model, scenarios)).withColumn("out_of_range", broken)


def scenarios_from_features(features: DataFrame) -> DataFrame:
    """Three what-if rows per feature row: as it is, with full operating hours, with more water."""
    def variant(name: str, **changes):
        values = [changes.get(c, F.col(c)).cast(features.schema[c].dataType).alias(c) for c in FEATURE_COLUMNS]
        return F.struct(F.lit(name).alias("scenario"), *values)

    rows = F.array(variant("as_is"), variant("full_hours", mean_hours_on=F.lit(24.0)),
                   variant("more_water", mean_bsw_pct=F.col("mean_bsw_pct") + 10))
    return features.select("field", "year", F.inline(rows))
