from __future__ import annotations

import random

import corpus_pipeline
from pyspark.sql import functions as F


def shingles(text, width):
    words = (text or "").encode().lower().split()
    size = max(1, min(width, len(words)))
    return {b" ".join(words[k:k + size]) for k in range(len(words) - size + 1)} if words else set()


def survivors(rows, measures=((80, 5), (85, 3))):
    """Smallest ids of the groups that similarity by any of ``measures`` (percent, words) links."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for percent, width in measures:
        sets = [shingles(text, width) for _, text in rows]
        for i, a in enumerate(sets):
            for j in range(i):
                b = sets[j]
                if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                    shared = len(a & b)
                    if 100 * shared >= percent * (len(a) + len(b) - shared):
                        root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(least.values())


def edited():
    """Appended copies (0.817 on five words, 0.818 on three), copies with scattered edits (below 0.8 on five
    words, over 0.85 on three), and a chain that needs a link of either kind."""
    draw = random.Random(3)
    word = lambda: f"w{draw.randrange(10**9)}"
    rows = []
    for k in range(0, 200, 10):
        base = [word() for _ in range(200)]
        longer = base + [word() for _ in range(44)]
        scattered = list(longer)
        for at in range(20, 240, 37):
            scattered[at] = word()
        own = [word() for _ in range(200)]
        apart = list(own)
        for at in range(15, 195, 35):
            apart[at] = word()
        rows += [(k + n, " ".join(words)) for n, words in enumerate((base, scattered, longer, own, apart))]
    return rows


def test_near_copies_by_five_words_and_by_three(spark, sf_dir, documents):
    rows = edited()
    wanted = survivors(rows)
    assert wanted != survivors(rows, ((85, 3),)) and wanted != survivors(rows, ((80, 5),))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, sf_dir)
    assert sorted(r["doc_id"] for r in kept.collect()) == wanted


def test_near_copies_of_the_documents(spark, sf_dir, documents):
    docs = documents.filter(F.col("text").isNotNull())
    kept = corpus_pipeline.keep_one_of_near_copies(spark, docs, sf_dir)
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == survivors(
        [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
