"""Readings and wells stored by well, so that rolling up and joining need no shuffle.

Both are tables of the same number of buckets by ``well_id``. Readings of a well are in one file, and the well itself in the
file of the same bucket. A well that would fill its bucket far beyond the others (more than ``HOT`` times an even
share) is kept in a table of its own without buckets, which tasks read in splits; its rollup is combined before the
shuffle, as everywhere else. There are at most ``buckets / HOT`` such wells.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellops.plans import features, gold

BUCKETS = 256
#: Rows a bucket holds on average at most. A bucket is sorted, and rolled up, by one task.
BUCKET_ROWS = 250_000
HOT = 4


@dataclass(frozen=True)
class ByWell:
    """The stored tables; ``hot`` is None where no well is frequent."""
    readings: DataFrame
    wells: DataFrame
    hot: DataFrame | None = None

    def located(self, rollup, columns: tuple[str, ...]) -> DataFrame:
        """Rollups of all wells with columns of the wells. The buckets meet without a shuffle."""
        wells = self.wells.select("well_id", *columns)
        out = rollup(self.readings).join(wells, "well_id")
        return out if self.hot is None else out.unionByName(rollup(self.hot).join(wells, "well_id"))


def store(spark: SparkSession, namespace: str, production: DataFrame, wells: DataFrame, buckets: int = BUCKETS) -> ByWell:
    """Write the tables below a namespace, replacing what they held. More than ``buckets`` are used where one would hold more than
    ``BUCKET_ROWS`` on average."""
    spark.sql(f"DROP TABLE IF EXISTS {namespace}.rows_of_wells")
    production.groupBy("well_id").count().write.format("parquet").saveAsTable(f"{namespace}.rows_of_wells")
    counts = spark.table(f"{namespace}.rows_of_wells")
    total = counts.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    buckets = max(buckets, -(-total // BUCKET_ROWS))
    frequent = [r["well_id"] for r in counts.filter(F.col("well_id").isNotNull() & (F.col("count") * buckets > F.lit(HOT) * total)).collect()]
    of_frequent = F.coalesce(F.col("well_id").isin(frequent), F.lit(False)) if frequent else F.lit(False)
    hot, rest = production.filter(of_frequent), production.filter(~of_frequent)
    for df, name in ((rest, "readings_by_well"), (wells, "wells_by_well")):
        # One task a bucket, so that each bucket is one sorted file.
        (df.repartition(buckets, "well_id").write.mode("overwrite").bucketBy(buckets, "well_id").sortBy("well_id")
         .format("parquet").saveAsTable(f"{namespace}.{name}"))
    hot.write.mode("overwrite").format("parquet").saveAsTable(f"{namespace}.readings_of_hot_wells")
    return load(spark, namespace)


def load(spark: SparkSession, namespace: str) -> ByWell:
    hot = spark.table(f"{namespace}.readings_of_hot_wells")
    return ByWell(spark.table(f"{namespace}.readings_by_well"), spark.table(f"{namespace}.wells_by_well"), None if hot.isEmpty() else hot)


def production_by_field(stored: ByWell) -> DataFrame:
    return gold.production_of_located(stored.located(gold.readings_per_well, ("field", "basin")))


def weekly_production(stored: ByWell, iso_year: bool = False) -> DataFrame:
    return features.weekly_of_located(stored.located(lambda readings: features.weekly_per_well(readings, iso_year), ("field",)))
