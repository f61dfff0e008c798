"""Features from earlier rows of the same series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def lag_and_mean(df: DataFrame, series: str, order: Sequence[str], value: str, lag_name: str, mean_name: str,
                 frame: tuple[int, int] = (-3, 0), places: int = 2) -> DataFrame:
    """Previous row's value and the mean over a row frame, by row and not by calendar.

    Both share one window, so the plan has one exchange, one sort and one Window node. A series
    must be an aggregate (one row per period), which bounds the rows of a partition.
    """
    window = Window.partitionBy(series).orderBy(*order)
    return df.withColumns({
        lag_name: F.lag(value, 1).over(window),
        mean_name: F.round(F.avg(value).over(window.rowsBetween(*frame)), places),
    })
