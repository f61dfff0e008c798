from __future__ import annotations

import corpus_pipeline
import pyarrow as pa
import pytest

NAME = "spark.sql.execution.arrow.maxRecordsPerBatch"
OPERATORS = {"language_id": "language_id.accepted", "minhash_dedup": "minhash_dedup.deduplicated",
             "decontamination": "decontamination.decontaminated", "mixing": "mixing.mixed",
             "token_files": "token_files.encode_documents"}


@pytest.fixture
def limit(spark):
    before = spark.conf.get(NAME)
    yield lambda rows: spark.conf.set(NAME, str(rows))
    spark.conf.set(NAME, before)


@pytest.fixture
def sizes(spark, monkeypatch):
    """Every stage returns the size of the batches in which its rows come to Python."""

    def operator(docs, *_, **__):
        def size(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"rows": pa.array([batch.num_rows], pa.int64())})

        return docs.mapInArrow(size, "rows long")

    monkeypatch.setattr(corpus_pipeline.language_id, "fit", lambda docs: None)
    for path in OPERATORS.values():
        module, function = path.split(".")
        monkeypatch.setattr(getattr(corpus_pipeline, module), function, operator)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_results_that_the_caller_computes_take_small_batches(spark, sf_dir, limit, sizes, name, stage):
    docs = spark.range(0, 5000, 1, 1).selectExpr("id AS doc_id", "'a' AS text")
    for rows, most in ((10_000, 1024), (0, 1024), (100, 100)):
        limit(rows)
        assert {r["rows"] for r in stage(spark, docs, sf_dir).collect()[:4]} == {most}


def test_a_whole_run_leaves_the_session_as_it_was(spark, sf_dir, limit, sizes, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[:1])
    limit(10_000)
    out = corpus_pipeline.run(spark, sf_dir)
    assert max(r["rows"] for r in out.collect()) <= 1024 and spark.conf.get(NAME) == "10000"
