from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from wellops.llm.language_id import accepted, fit


def test_without_a_model_texts_with_a_letter_stay(spark, sf_dir, odd_documents):
    unlabelled = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    assert fit(unlabelled) is None
    wanted = sorted(str(r["doc_id"]) for r in odd_documents.collect() if r["text"] and any(c.isalpha() for c in r["text"]))
    kept = accepted(unlabelled, None)
    assert kept.schema == unlabelled.schema
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == wanted and wanted
    stage = corpus_pipeline.keep_known_languages(spark, unlabelled, sf_dir)
    assert sorted(str(r["doc_id"]) for r in stage.collect()) == wanted
