"""Train / test splits of the weekly feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_train_by_key(folds: int = 5) -> Column:
    """A rule on the row key: about 1/folds of the weeks are held out, whatever the partitioning."""
    return (F.col("year") * 53 + F.col("week")) % folds != 0


def split_by_key(df: DataFrame, folds: int = 5) -> tuple[DataFrame, DataFrame]:
    return df.filter(is_train_by_key(folds)), df.filter(~is_train_by_key(folds))


def split_by_time(df: DataFrame, year: int, week: int) -> tuple[DataFrame, DataFrame]:
    """Rows before the given week train, that week and later ones test."""
    before = (F.col("year") < year) | ((F.col("year") == year) & (F.col("week") < week))
    return df.filter(before), df.filter(~before)


def split_random(df: DataFrame, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Seeded random split; write the input first, as the draw depends on its row order."""
    train, test = df.randomSplit([1 - test_share, test_share], seed)
    return train, test
