"""Texts that a list does not name stay where they are, also when the list is too long to be broadcast."""

from pyspark.sql import functions as F

from wellops.llm import minhash_dedup
from wellops.llm.common import early_filter, stored

BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


def test_texts_are_filtered_before_the_shuffle(spark, tmp_path):
    texts = [(k, f"text {k}") for k in range(200)] + [(3, "text 3"), (3, "other text"), (None, "text 3"), (500, "text 3"), (7, None)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(path)
    docs, names = spark.read.parquet(path), "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    rows = minhash_dedup._named(docs.filter("doc_id in (3, 150) or doc_id is null").select("doc_id", F.xxhash64("text").alias("text_hash")))
    wanted = rows.distinct().select(F.encode(F.concat_ws("-", *minhash_dedup._ROW), "utf-8").alias("cls"),
                                    F.struct(*minhash_dedup._ROW).alias("first"), F.lit(1).alias("n"))
    wanted, before = stored(wanted, str(tmp_path), "wanted"), (spark.conf.get(BROADCAST), spark.conf.get(names))
    spark.conf.set(BROADCAST, "-1")
    try:
        with early_filter(spark):
            found = minhash_dedup._texts(docs, wanted)
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            result = sorted(r["text"] for r in found.collect())
        assert "might_contain" in plan and "xxhash64(text" in plan.split("might_contain")[-1] + plan
    finally:
        spark.conf.set(BROADCAST, before[0])
    assert result == ["other text", "text 150", "text 3", "text 3"]
    assert spark.conf.get(names) == before[1]
