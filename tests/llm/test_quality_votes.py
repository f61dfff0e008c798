from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from wellops.llm.quality import Settings, _lengths, _weighted, fit, op6_quality, score, term_counts, vote
from wellops.llm.words import BLANKS, Hasher


def test_held_out_agreement(spark, sf_dir, documents):
    got = op6_quality(spark, sf_dir)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == documents.count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.9 * len(rows)
    assert all(0.0 <= r["score"] <= 1.0 and r["predicted"] == (r["score"] >= 0.3) for r in got.collect())


def test_vote_is_that_of_all_neighbours_by_hand(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = fit(documents, labels, Settings(per_label=20, dimensions=6, neighbours=5))
    counts = term_counts(Hasher(BLANKS), [r["text"].encode() for r in documents.limit(12).collect()])
    latent = _weighted(counts, model.weights) @ model.directions
    latent = latent / _lengths(latent)
    for row, got in zip(latent, vote(model, counts)):
        cosine = sorted(((float(row @ v), k) for k, v in enumerate(model.vectors)), reverse=True)[:5]
        weight = {k: max(0.0, c) ** 8 * model.balance[k] for c, k in cosine}
        assert abs(got - sum(w * model.labels[k] for k, w in weight.items()) / sum(weight.values())) < 1e-3
    assert len(model.labels) <= 40


def test_terms():
    counts = term_counts(Hasher(BLANKS), [b"", b"a", b"to To to  of", b"ab"])
    assert counts.sum(axis=1).tolist() == [0, 0, 11 + 3, 1]
    assert counts[2, -2:].tolist() == [2, 1] and np.count_nonzero(counts[3]) == 1


def test_odd_documents(spark, odd_documents, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    odd_labels = labels.union(spark.createDataFrame([(None, 1), (1, None), (1, 1), (1, 0)], labels.schema))
    model = fit(documents, odd_labels)
    rows = score(odd_documents, model).collect()
    assert len(rows) == odd_documents.count() and all(0.0 <= r["score"] <= 1.0 for r in rows)
    assert {r["score"] for r in rows if not r["text"]} == {model.prior}
    same = [r["score"] for r in rows if r["text"] and r["text"].startswith("the cat")]
    assert len(set(same)) == 1
    assert score(odd_documents.limit(0), model).count() == 0
    assert fit(documents, labels.limit(0)) is None and fit(documents.limit(0), labels) is None
    assert {r["score"] for r in score(odd_documents, None).collect()} == {0.5}
