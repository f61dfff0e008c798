from __future__ import annotations

from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_decontamination import brute as hits
from test_minhash_dedup import brute as groups

from wellops.llm.common import scratch, stored


def test_stages_one_after_the_other(spark, sf_dir, documents):
    """Every stage but the network's is held against brute force on what the stage before it kept."""
    benchmark = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "minhash_dedup", "decontamination", "mixing", "token_files"]
    docs, folder, kept = documents, scratch(spark, "stages"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = stored(stage(spark, docs, sf_dir), folder, name)
        if name != "token_files":
            assert docs.schema == documents.schema
        kept[name] = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
        ids = Counter(d for d, _ in before)
        if name == "language_id":
            assert set(kept[name]) == {d for d, t in before if t and any(c.isalpha() for c in t)}
        elif name == "minhash_dedup":
            assert set(kept[name]) == {d for d, _, _, keep in groups(before) if keep} and max(kept[name].values()) == 1
        elif name == "decontamination":
            assert set(kept[name]) == {d for d, _, hit, _ in hits(before, benchmark) if not hit} and len(kept[name]) < len(ids)
        elif name == "mixing":
            assert set(kept[name]) <= set(ids) and max(kept[name].values()) <= 3 and len(kept[name]) > 0.3 * len(ids)
        else:
            assert kept[name] == ids
            assert all(r["n_tokens"] >= 1 for r in docs.collect())
    run = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(tuple, run)) == sorted(map(tuple, docs.collect()))
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_and_empty_documents(spark, sf_dir, odd_documents, name, stage):
    out = stage(spark, odd_documents, sf_dir)
    if name != "token_files":
        assert out.columns == odd_documents.columns
    assert out.count() > 0
    assert stage(spark, odd_documents.filter(F.lit(False)), sf_dir).count() == 0
