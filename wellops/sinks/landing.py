"""Landing writers: CSV and JSON loads, and single batches of the live feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from wellops.functions.columns import reading_id


def land_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def land_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def land_feed_batch(readings: DataFrame, path: str, suffix: Column | None = None) -> None:
    """Add one batch of live readings under new file names; files already there stay.

    With ``suffix`` the reading id is composed as ``{well}_{yyyymmdd}_{suffix}``.
    """
    if suffix is not None:
        readings = readings.withColumn("reading_id", reading_id("well_id", "prod_date", suffix))
    land_json(readings, path, mode="append")
