from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from wellops.llm.decontamination import build_index, decontaminated, op2_decontamination, search, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    windows = {}
    for name, text in items:
        own = words(text)
        size = min(window, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[k:k + size]), set()).add("" if name is None else str(name))
    out = []
    for doc_id, text in docs:
        own, found = words(text), set()
        hit = [False] * len(own)
        for size in {len(w) for w in windows}:
            for k in range(len(own) - size + 1):
                if (names := windows.get(tuple(own[k:k + size]))):
                    found |= names
                    hit[k:k + size] = [True] * size
        out.append((doc_id, len(own), sum(hit), sorted(found)))
    return out


def got(result):
    return [(r["doc_id"], r["hits"]["n_words"], r["hits"]["n_hit"], r["hits"]["items"]) for r in result.collect()]


def ordered(rows):
    return sorted(rows, key=str)


def pairs(df, a, b):
    return [(r[a], r[b]) for r in df.select(a, b).collect()]


def test_query_against_brute_force(spark, sf_dir, documents):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    wanted = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0)
              for d, n, h, i in brute(pairs(documents, "doc_id", "text"), pairs(benchmark, "item_id", "text"))]
    result = op2_decontamination(spark, sf_dir)
    assert ordered(map(tuple, result.drop("longest_match").collect())) == ordered(wanted)
    assert any(r[5] for r in wanted)


def test_short_items_blocks_and_odd_rows(spark, odd_documents):
    items = [(1, "the dog"), (1, "the dog"), (None, "GATO"), (2, None), (3, "..."), (4, " ".join(f"w{k}" for k in range(500, 540))),
             (5, "cat sat on the mat and looked at the dog the cat sat on the mat and looked at"), (6, "w7 w8 w9 nowhere")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    wanted = ordered(brute(pairs(odd_documents, "doc_id", "text"), items))
    assert ordered(got(search(odd_documents, benchmark))) == wanted
    assert ordered(got(search(odd_documents, benchmark, block_bytes=60))) == wanted
    kept = decontaminated(odd_documents, benchmark)
    assert kept.schema == odd_documents.schema and kept.count() == sum(h == 0 for _, _, h, _ in wanted)
    assert search(odd_documents.limit(0), benchmark).count() == 0
    assert all(r[2] == 0 for r in got(search(odd_documents, benchmark.limit(0))))


def test_random_texts_and_longest_match(spark):
    draw = random.Random(3)
    letters = "abcd"
    docs = [(k, " ".join(draw.choice(letters) for _ in range(draw.randrange(0, 120)))) for k in range(150)]
    items = [(k, " ".join(draw.choice(letters) for _ in range(draw.randrange(1, 16)))) for k in range(25)]
    items.append((99, docs[7][1]))
    result = search(spark.createDataFrame(docs, "doc_id long, text string"),
                    spark.createDataFrame(items, "item_id long, text string"), window=4)
    assert ordered(got(result)) == ordered(brute(docs, items, 4))
    for r in result.collect():
        if r["hits"]["n_hit"]:
            own, text = words(r["text"]), dict(items)[int(r["hits"]["longest_item"])]
            match = own[r["hits"]["longest_at"]:r["hits"]["longest_at"] + r["hits"]["longest"]]
            assert f" {' '.join(match)} " in f" {text} "
    whole = result.filter(F.col("doc_id") == 7).first()
    assert whole["hits"]["longest"] == len(words(docs[7][1]))


def test_suffix_array_order():
    rng = np.random.default_rng(2)
    sequence = rng.integers(0, 3, 300).astype(np.int64)
    index = build_index([("a", b"x y z")])
    from wellops.llm.decontamination import _keys
    order = suffix_array(_keys(sequence, 5, 4), np.flatnonzero(sequence), 5, 400)
    suffixes = [sequence[p:].tolist() for p in order]
    assert suffixes == sorted(suffixes) and index.per_key >= 5
