"""A saved forest as a table of its tree nodes, and scores from that table by joins.

A second way to a prediction that shares nothing with the model's own code: what a registered model predicts can be checked by
value, and a forest can be scored or read by whoever has SQL only. Rows go down all trees at once, one level a join;
the nodes are far fewer than the rows, so Spark broadcasts them by their size or shuffles by tree and node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PREDICTED = "table_prediction"


def nodes(spark: SparkSession, pipeline_path: str, stage: int = 1) -> DataFrame:
    """tree, node, feature, threshold, left, right, value of the forest that is a stage of a saved pipeline; the children of a
    leaf are negative."""
    saved = spark.read.parquet(f"{pipeline_path}/stages/{stage}_*/data")
    node = F.col("nodeData")
    return saved.select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"), node["leftChild"].alias("left"),
        node["rightChild"].alias("right"), node["prediction"].alias("value"))


def score(rows: DataFrame, forest: DataFrame, feature_columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    """``key`` and the mean of the values that the trees have for a row (null where it has a null feature).

    ``key`` must tell the rows apart. Empty rows give none.
    """
    vector = F.array(*[F.col(c).cast("double") for c in feature_columns])
    trees = forest.agg(F.max("tree")).first()[0]
    state = rows.select(*key, vector.alias("_x"), F.explode(F.sequence(F.lit(0), F.lit(trees))).alias("tree")).withColumn("node", F.lit(0))
    deepest = _depth(forest)
    here = forest.select("tree", "node", "feature", "threshold", "left", "right", "value")
    for level in range(deepest + 1):
        met = state.drop("value").join(here, ["tree", "node"])
        x = F.get("_x", F.col("feature"))
        below = F.when(F.col("left") < 0, F.col("node")).when(x <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        state = met.select(*key, "_x", "tree", below.alias("node"), "value")
    known = ~F.exists("_x", lambda v: v.isNull())
    return state.groupBy(*key).agg(F.avg(F.when(known, F.col("value"))).alias(PREDICTED))


def _depth(forest: DataFrame) -> int:
    """Levels below the root, found by going down the nodes themselves, which numbers them in any way they are stored."""
    level, depth = forest.filter("node = 0").select("tree", "node", "left", "right"), 0
    children = forest.select("tree", "node", "left", "right")
    while True:
        inner = level.filter("left >= 0")
        pairs = inner.select("tree", F.explode(F.array("left", "right")).alias("node"))
        if pairs.isEmpty():
            return depth
        level, depth = pairs.join(children, ["tree", "node"]), depth + 1
