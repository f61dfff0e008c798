"""A corpus from raw documents to token files: each stage works on what the one before it kept.

Every stage takes the session, the documents and the folder of the other tables. All but the last return rows
with the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from wellops.llm import decontamination, language_id, minhash_dedup, mixing, token_files
from wellops.llm.common import limit_batches, scratch, small_batches, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows of whole texts in one batch for Python; a batch is held several times over, by the JVM and by the worker.
BATCH_ROWS = 1024


def _in_small_batches(stage: Stage) -> Stage:
    """The session keeps the limit after the call: Spark reads it when the caller computes the result."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        limit_batches(spark, BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run


#: The least share of a text that its language must have. Below one half, so that texts of two languages stay.
MIN_LANGUAGE_SCORE = 0.4


@_in_small_batches
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no language go: null, without a letter, or of no language by ``MIN_LANGUAGE_SCORE`` as the network
    scores them. It learns from ``docs``."""
    return language_id.accepted(docs, language_id.fit(docs), MIN_LANGUAGE_SCORE)


#: Near copies by either measure: similarity 0.8 on shingles of five words, and the 0.85 on three words of op7, which
#: also finds copies with scattered edits. 20 half-keys miss about 0.07 % of pairs at 0.8.
NEAR_COPIES = (minhash_dedup.Settings(percent=80, shingle=5, keys=20), minhash_dedup.Settings())


@_in_small_batches
def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (see ``NEAR_COPIES``) the document with the smallest id stays, or one without an
    id if none has one."""
    return minhash_dedup.deduplicated(docs, *NEAR_COPIES, unnamed=True)


@_in_small_batches
def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any window of a benchmark item go."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


@_in_small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the sources come to their target weights."""
    return mixing.mixed(docs)


@_in_small_batches
def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the mix in files; one row per document, read back from them."""
    return token_files.encode_documents(docs, token_files.default_tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("minhash_dedup", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]

# A trained network, sketches and a tokenizer are beyond SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table ``documents``; each result is written and read again."""
    folder = scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    with small_batches(spark, BATCH_ROWS):
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), folder, name)
    return docs
