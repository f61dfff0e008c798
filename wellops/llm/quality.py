"""Quality of whole texts by the votes of their nearest labelled neighbours in a latent-semantic space.

Terms are pairs of neighbouring bytes, hashed to slots, and two more: words that repeat the word before them
and words that do not. Counts are damped by a square root and weighted by inverse document frequency over
all documents; the leading singular directions of the labelled texts span the latent space. The labelled
vectors are a sample of bounded size (``per_label``), so they are broadcast; every document is compared with
all of them, in blocks of exact cosine products within the scan, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellops.llm.common import ship, table, utf8
from wellops.llm.words import BLANKS, Hasher

SLOTS = 1024
TERMS = SLOTS + 2
REPEAT_WEIGHT = 8.0
_SLOT = np.random.default_rng(5).integers(0, SLOTS, 65536).astype(np.int32)
_BATCH_BYTES = 2 << 20
_DOCS_AT_ONCE = 512


@dataclass(frozen=True)
class Settings:
    """``per_label`` bounds the labelled rows of either label; ``power`` sharpens the weight of a similarity."""
    per_label: int = 2048
    dimensions: int = 24
    neighbours: int = 9
    power: int = 8
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    weights: np.ndarray      # of the terms
    directions: np.ndarray   # (terms, dimensions)
    vectors: np.ndarray      # (labelled, dimensions), of length one
    labels: np.ndarray       # 0 or 1
    balance: np.ndarray      # weight of a neighbour's vote: either label weighs as much in total
    prior: float             # share of label 1, the answer where no neighbour has a similarity
    how: Settings


def term_counts(hasher: Hasher, texts: list[bytes]) -> np.ndarray:
    """(texts, TERMS) counts; a text of one byte or none has no pairs."""
    out = np.zeros((len(texts), TERMS), np.float32)
    words, counts = hasher(texts)
    ends = np.cumsum(counts)
    for k, text in enumerate(texts):
        raw = np.frombuffer(text, np.uint8)
        if len(raw) > 1:
            pairs = (raw[:-1].astype(np.int32) << 8) | raw[1:]
            out[k, :SLOTS] = np.bincount(_SLOT[pairs], minlength=SLOTS)
        own = words[ends[k] - counts[k]:ends[k]]
        out[k, SLOTS] = np.count_nonzero(own[1:] == own[:-1])
        out[k, SLOTS + 1] = max(0, len(own) - 1) - out[k, SLOTS]
    return out


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    x = np.sqrt(counts) * weights
    return x / _lengths(x)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = max(1, min(_DOCS_AT_ONCE, batch.num_rows * _BATCH_BYTES // max(_BATCH_BYTES, batch.nbytes)))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each term occurs, and the number of texts; sums per task are added up by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = Hasher(BLANKS), np.zeros(TERMS + 1, np.int64)
        for part in _parts(batches):
            counts = term_counts(hasher, utf8(part.column("text")))
            total[:TERMS] += (counts > 0).sum(axis=0)
            total[TERMS] += len(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array(total)], names=["term", "n"])

    rows = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(TERMS + 1, np.int64)
    for r in rows:
        total[r["term"]] = r["n"]
    return total[:TERMS], int(total[TERMS])


def fit(docs: DataFrame, labels: DataFrame, how: Settings | None = None) -> Model | None:
    """The model from the labelled texts: ``labels`` (doc_id, label) of 0 and 1, rows of null are left out.

    Of repeated labels of a document the mean decides. Document frequencies are those of all ``docs``; the
    labelled rows are at most about ``per_label`` of either label, chosen by a hash of the id. No labelled
    document: no model (None).
    """
    how = how or Settings()
    ship(docs.sparkSession)
    known = labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(
        (F.avg("label") >= 0.5).cast("int").alias("label"))
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n:
        return None
    share = F.when(F.col("label") == 1, min(1.0, how.per_label / n.get(1, 1))).otherwise(min(1.0, how.per_label / n.get(0, 1)))
    picked = known.filter(F.xxhash64("doc_id", F.lit("labelled")) < (share * 2.0**64 - 2.0**63))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(BLANKS)
        for part in _parts(batches):
            counts = term_counts(hasher, utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array([c.tobytes() for c in counts], pa.binary())],
                names=["doc_id", "label", "counts"])

    # Bounded by per_label, so a broadcast is safe at any size of the corpus.
    # Of the rows that repeat an id the one with the smallest term counts is learned from.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text").mapInArrow(
        vectors, "doc_id long, label int, counts binary").groupBy("doc_id", "label").agg(F.min("counts").alias("counts")).collect()
    if not rows:
        return None
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["label"], r["counts"]))
    counts = np.stack([np.frombuffer(r["counts"], np.float32) for r in rows])
    frequency, n_docs = _document_frequencies(docs)
    weights = (np.log((1.0 + n_docs) / (1.0 + frequency)) + 1.0).astype(np.float32)
    weights[SLOTS:] *= REPEAT_WEIGHT
    x = _weighted(counts, weights).astype(np.float64)
    _, directions = np.linalg.eigh(x.T @ x)
    directions = directions[:, ::-1][:, :how.dimensions].astype(np.float32)
    latent = (x @ directions).astype(np.float32)
    target = np.array([r["label"] for r in rows])
    balance = len(target) / (2.0 * np.maximum(1, np.bincount(target, minlength=2)))
    return Model(weights, directions, latent / _lengths(latent), target.astype(np.float32), balance[target],
                 n.get(1, 0) / sum(n.values()), how)


def vote(model: Model, counts: np.ndarray) -> np.ndarray:
    """Scores of 0 to 1: the labels of the nearest labelled texts, weighted by similarity."""
    latent = _weighted(counts, model.weights) @ model.directions
    cosine = (latent / _lengths(latent)) @ model.vectors.T
    k = min(model.how.neighbours, cosine.shape[1])
    near = np.argpartition(cosine, cosine.shape[1] - k, axis=1)[:, -k:]
    weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0.0).astype(np.float64) ** model.how.power
    weight *= model.balance[near]
    total = weight.sum(axis=1)
    score = (weight * model.labels[near]).sum(axis=1) / np.where(total > 0, total, 1.0)
    return np.clip(np.where(total > 0, score, model.prior), 0.0, 1.0)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (replacing columns of those names); other columns pass through.

    A null text is an empty one and gets the share of label 1, as does any text without a similar
    neighbour; without a model the score is 0.5. Repeated rows get equal scores, an empty table stays empty.
    """
    spark = docs.sparkSession
    ship(spark)
    kept = docs.drop("score", "predicted")
    columns, threshold = kept.columns, (model.how if model else Settings()).threshold
    shared = spark.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, own = Hasher(BLANKS), shared.value
        for part in _parts(batches):
            texts = utf8(part.column("text"))
            scores = vote(own, term_counts(hasher, texts)) if own and texts else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in columns] + [pa.array(scores, pa.float64()),
                                                     pa.array((scores >= threshold).astype(np.int32))],
                names=[*columns, "score", "predicted"])

    schema = kept.withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema
    return kept.mapInArrow(judge, schema)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", held_out.alias("held_out"))
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", F.col("quality").alias("label"))
    return score(docs, fit(docs, labels)).drop("text")
