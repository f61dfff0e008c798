from __future__ import annotations

import corpus_pipeline

from wellops.llm.minhash_dedup import deduplicated


def test_one_survivor_a_group_and_clean_texts_without_an_id(spark, sf_dir):
    words = [f"w{k}" for k in range(300)]
    text, near, other = " ".join(words), " ".join([*words, "end"]), " ".join(words[::-1])
    rows = [(5, text), (5, near), (9, near), (None, near), (None, "clean text of its own"), (None, other), (None, other + " end"),
            (6, "another text with an id"), (None, None), (8, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in corpus_pipeline.keep_one_of_near_copies(spark, docs, sf_dir).collect()]
    assert sum(t in (text, near) for _, t in kept) == 1 and {d for d, t in kept if t in (text, near)} == {5}
    assert sum((t or "").startswith(other) for _, t in kept) == 1
    rest = [r for r in kept if r[1] not in (text, near) and not (r[1] or "").startswith(other)]
    assert sorted(rest, key=str) == sorted(
        [(None, "clean text of its own"), (6, "another text with an id"), (None, None), (8, None)], key=str)
    named = deduplicated(docs).collect()
    assert sorted(r["doc_id"] for r in named) == [5, 6, 8]
