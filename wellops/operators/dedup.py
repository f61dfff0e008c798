"""One row per business key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row of each key that comes first by ``order``; the other columns break ties.

    A minimum over whole rows instead of a ranking window: it combines before the shuffle, so each
    task sends at most one row per key and a key with very many copies moves little. Spark plans it as two
    sorts of whole rows, before and after the shuffle. Rows with a
    null key form one group. Nulls in ``order`` come first.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    row = F.min(F.struct(*order, *rest)).alias("row")
    return df.groupBy(key).agg(row).select(*[F.col(c) if c == key else F.col(f"row.{c}") for c in df.columns])


def first_arrival(df: DataFrame, key: str, spread: int | None = None) -> DataFrame:
    """On a stream: the first row to arrive per key, with the keys seen kept as state.

    A streaming dedup sends every row to the task of its key and cannot combine before that. So it
    runs twice: first per key and input partition group, which spreads the copies of a frequent key
    over ``spread`` tasks (by default one group per shuffle partition), then per key over the few rows left.
    """
    spread = spread or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = F.pmod(F.spark_partition_id(), F.lit(spread))
    return (df.withColumn("_group", group).dropDuplicates([key, "_group"]).drop("_group")
            .dropDuplicates([key]))


def one_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    return first_arrival(df, key) if df.isStreaming else first_per_key(df, key, order)
