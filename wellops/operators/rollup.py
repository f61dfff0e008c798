"""Rollups that shrink to one row per well before they join.

A reading carries only the key of its well, and all measures are sums and counts, so the readings
are aggregated per well first and joined afterwards. The join then moves one row per well and
period instead of every reading, a well that holds a third of all readings collapses on the map
side, and the wells need not fit in memory of one executor. Totals are the same: if a well id
occurs several times among the wells, its aggregated row joins each copy just as its readings would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partials_per_well(df: DataFrame, by: Sequence[str], rows: str, measures: Sequence[str]) -> DataFrame:
    """Per ``by`` key: ``n_rows`` (non-null ``rows``), and ``sum_`` and ``n_`` of each measure."""
    aggregates = [F.count(rows).alias("n_rows")]
    for m in measures:
        aggregates += [F.sum(m).alias(f"sum_{m}"), F.count(m).alias(f"n_{m}")]
    return df.groupBy(*by).agg(*aggregates)


def merged(partials: DataFrame, by: Sequence[str]) -> DataFrame:
    """Partial results of several loads as one: counts and sums add up."""
    return partials.groupBy(*by).agg(*[F.sum(c).alias(c) for c in partials.columns if c not in by])


def total(measure: str, places: int = 2) -> Column:
    return F.round(F.sum(f"sum_{measure}"), places)


def mean(measure: str, places: int = 2) -> Column:
    """Mean over rows (not over wells): null where no row has a value."""
    return F.round(F.try_divide(F.sum(f"sum_{measure}"), F.sum(f"n_{measure}")), places)


def row_count() -> Column:
    return F.sum("n_rows")
