"""Regression metrics and the comparison of two predictors, each in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("mae", "rmse", "r2")


def metric_columns(label: str, prediction: str, suffix: str = "") -> list[Column]:
    error = F.col(label) - F.col(prediction)
    squares = F.sum(error * error)
    spread = F.var_pop(label) * F.count(label)
    return [
        F.avg(F.abs(error)).alias(f"mae{suffix}"),
        F.sqrt(F.avg(error * error)).alias(f"rmse{suffix}"),
        (1 - F.try_divide(squares, spread)).alias(f"r2{suffix}"),
    ]


def regression_metrics(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: mae, rmse, r2 over the rows where both values are present."""
    present = scored.select(label, prediction).na.drop()
    return present.agg(*metric_columns(label, prediction))


def compare_predictors(scored: DataFrame, label: str, champion: str, challenger: str) -> DataFrame:
    """Per metric: both values and the better one (lower error, higher r2; a tie stays with champion)."""
    both = scored.select(label, champion, challenger).na.drop().agg(
        *metric_columns(label, champion, "_champion"), *metric_columns(label, challenger, "_challenger"))
    rows = [F.struct(F.lit(m).alias("metric"), F.col(f"{m}_champion").alias("champion"),
                     F.col(f"{m}_challenger").alias("challenger")) for m in METRICS]
    table = both.select(F.inline(F.array(*rows)))
    wins = F.when(F.col("metric") == "r2", F.col("challenger") > F.col("champion")) \
        .otherwise(F.col("challenger") < F.col("champion"))
    return table.withColumn("better", F.when(wins, F.lit("challenger")).otherwise(F.lit("champion")))
