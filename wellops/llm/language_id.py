"""Language of whole texts by a bidirectional gated recurrent network over bytes (see ``gru``).

The network is trained on the driver from a bounded sample of labelled rows and then read over every byte
of every text inside the scan: nothing is shuffled. A text is read in consecutive segments of
``Training.width`` bytes, each from a fresh state, so the work is the same per byte for any length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellops.llm import gru
from wellops.llm.common import in_worker, ship, table, unused, utf8

UNDETERMINED = "und"
HAS_LETTER = r"\p{L}"
ROWS_AT_ONCE = 1024
_BATCH_BYTES = 4 << 20
_LIMIT = 2**63


@dataclass(frozen=True)
class Model:
    """Labels in the order of the network's outputs, its parameters and the length of a segment."""
    labels: tuple[str, ...]
    params: gru.Params
    width: int


def crc_bucket(parts: int, key: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts


def _excerpts(labelled: DataFrame, per_label: int, excerpts: int, width: int) -> list[tuple[str, bytes]]:
    """About ``per_label`` distinct texts a label, chosen by a hash of the text, ``excerpts`` windows of each.

    Distinct texts are counted (by sketch) and sampled, so a text that repeats any number of times is one text, and a rerun
    takes the same. One row a label reaches the driver, as the network has an output for each.
    """
    rows = labelled.filter(F.col("text").rlike(HAS_LETTER) & F.col("lang").isNotNull()).select(
        "lang", "text", F.xxhash64("text").alias("place"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("place").alias("n")).collect()}
    if not counts:
        return []
    # The share of the 64-bit hash range that holds per_label texts of a label on average.
    bound = F.create_map(*[F.lit(x) for k, n in sorted(counts.items())
                           for x in (k, int(min(1.0, per_label / n) * 2 * (_LIMIT - 1024)) - _LIMIT)])
    cuts = [F.expr(f"substring(text, greatest(1, cast(pmod(shiftright(xxhash64(text, 'excerpt'), {8 * k}), length(text)) "
                   f"as int) - {width // 2}), {width})") for k in range(excerpts)]
    picked = rows.filter(F.col("place") < bound[F.col("lang")])
    # Cut first, so that only the windows are moved to where repeated texts become one.
    once = picked.select("lang", "place", F.array(*cuts).alias("cuts")).groupBy("lang", "place").agg(F.min("cuts").alias("cuts"))
    return sorted((r["lang"], cut.encode()) for r in once.collect() for cut in r["cuts"] if cut)


def fit(labelled: DataFrame, per_label: int = 400, excerpts: int = 4, how: gru.Training | None = None) -> Model | None:
    """Train on ``labelled`` (text, lang). Rows without a label or a letter are left out.

    ``per_label`` texts of each language and ``excerpts`` windows of each bound the sample that reaches the
    driver, whatever the size of the table. Without any usable row there is no model (None).
    """
    how = how or gru.Training()
    sample = _excerpts(labelled, per_label, excerpts, how.width)
    if not sample:
        return None
    labels = tuple(sorted({lang for lang, _ in sample}))
    raw = np.frombuffer(b"".join(cut for _, cut in sample), np.uint8)
    rows, size, owner = gru.segments(raw, np.array([len(cut) for _, cut in sample]), how.width)
    target = np.array([labels.index(lang) for lang, _ in sample])[owner]
    return Model(labels, gru.train(rows, size, target, len(labels), how), how.width)


def pooled(model: Model, texts: list[bytes]) -> np.ndarray:
    """Mean over all positions of the label probabilities, (texts, labels); zero for texts without bytes."""
    lengths = np.array([len(t) for t in texts], np.int64)
    total = np.zeros((len(texts), len(model.labels)))
    raw = np.frombuffer(b"".join(texts), np.uint8)
    rows, size, owner = gru.segments(raw, lengths, model.width)
    for start in range(0, len(rows), ROWS_AT_ONCE):
        part = slice(start, start + ROWS_AT_ONCE)
        p = gru.position_probabilities(model.params, rows[part], size[part])
        np.add.at(total, owner[part], p.sum(axis=1, dtype=np.float64).T)
    return total / np.maximum(1, lengths)[:, None]


def predict(docs: DataFrame, model: Model | None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its score (replacing columns of those names).

    ``und`` with score 0 where the text is null, empty or has no letter, or where there is no model. All
    other columns pass through unchanged; repeated rows get equal answers; an empty table stays empty.
    """
    spark = docs.sparkSession
    ship(spark)
    kept = docs.drop(*names)
    columns = kept.columns
    flag = unused(columns, "_has_letter")
    rows = kept.withColumn(flag, F.coalesce(F.col("text").rlike(HAS_LETTER), F.lit(False)))

    @in_worker("language_id")
    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, batch.num_rows * _BATCH_BYTES // max(_BATCH_BYTES, batch.nbytes))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                letters = part.column(flag).to_pylist()
                texts = [t if known else b"" for t, known in zip(utf8(part.column("text")), letters)]
                if model is None:
                    best, score = np.zeros(len(texts), int), np.zeros(len(texts))
                else:
                    p = pooled(model, texts)
                    best, score = p.argmax(axis=1), np.minimum(p.max(axis=1), 1.0)
                found = [model.labels[b] if model and t else UNDETERMINED for b, t in zip(best.tolist(), texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in columns] + [pa.array(found, pa.string()), pa.array(score, pa.float64())],
                    names=[*columns, *names])

    schema = kept.withColumns({names[0]: F.lit(""), names[1]: F.lit(0.0)}).schema
    return rows.mapInArrow(label, schema)


def accepted(docs: DataFrame, model: Model | None, min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` whose language is not ``und`` and has at least ``min_score``, with the same columns.

    A caller that wants texts of one language only sets ``min_score``; by default mixed ones stay. Without a
    model there are no scores, and every text that has a letter stays.
    """
    if model is None:
        return docs.filter(F.col("text").rlike(HAS_LETTER))
    lang, score = unused(docs.columns, "_lang_pred"), unused(docs.columns, "_lang_score")
    scored = predict(docs, model, (lang, score))
    return scored.filter((F.col(lang) != UNDETERMINED) & (F.col(score) >= min_score)).drop(lang, score)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_bucket(4) == 2
    model = fit(docs.filter(~held_out))
    return predict(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")
