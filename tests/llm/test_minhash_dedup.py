from __future__ import annotations

import random

import numpy as np

from wellops.llm import minhash_dedup
from wellops.llm.minhash_dedup import Settings, deduplicated, joined_components, near_duplicates, op7_minhash_dedup


def shingles(text):
    words = (text or "").encode().lower().split()
    size = max(1, min(3, len(words)))
    return {b" ".join(words[k:k + size]) for k in range(len(words) - size + 1)} if words else set()


def brute(rows, percent=85):
    """(doc_id, text) -> size of the set and smallest id reachable, per row."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                shared = len(a & b)
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    root[find(i)] = find(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(i)] = min(doc_id, smallest.get(find(i), doc_id))
    return [(doc_id, len(sets[i]), smallest[find(i)] if doc_id is not None else None,
             doc_id is not None and smallest[find(i)] == doc_id) for i, (doc_id, _) in enumerate(rows)]


def same(result, rows):
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, result.collect()), key=key) == sorted(brute(rows), key=key)


def test_query_against_brute_force(spark, sf_dir, documents):
    same(op7_minhash_dedup(spark, sf_dir), [(r["doc_id"], r["text"]) for r in documents.collect()])


def test_odd_documents(spark, odd_documents):
    same(near_duplicates(odd_documents), [(r["doc_id"], r["text"]) for r in odd_documents.collect()])
    assert near_duplicates(odd_documents.limit(0)).count() == 0
    once = deduplicated(odd_documents)
    assert once.schema == odd_documents.schema
    assert sorted(r["doc_id"] for r in once.collect()) == [1, 2, 3, 4, 5, 6, 7, 8, 9]


def family(seed, copies, edits, words=150, first=0):
    """A text and copies of it, each with words replaced at random: many pairs lie just below the limit."""
    draw = random.Random(seed)
    base = [f"b{seed}x{draw.randrange(10**6)}" for _ in range(words)]
    rows = [(first + copies, " ".join(base))]
    for k in range(copies):
        own = list(base)
        for _ in range(draw.randrange(1, edits)):
            own[draw.randrange(words)] = f"e{draw.randrange(10**6)}"
        rows.append((first + k, " ".join(own)))
    return rows


def test_family_that_no_hub_joins(spark):
    rows = family(1, 150, 9) + family(2, 40, 14, first=1000) + family(3, 3, 3, first=2000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(near_duplicates(docs), rows)
    same(near_duplicates(docs, Settings(block=16)), rows)


def test_gatherings_compared_whole_or_table_by_table(spark, tmp_path, monkeypatch):
    rows = family(1, 150, 9) + family(2, 40, 14, first=1000) + family(3, 3, 3, first=2000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(minhash_dedup, "discard", lambda *_: None)
    taken = {}
    for most in (0, 10**6):
        monkeypatch.setattr(minhash_dedup, "_ROWS_A_TABLE_ROW", most)
        same(near_duplicates(docs, Settings(block=16), folder=f"{tmp_path}/run-{most}"), rows)
        read = {name: spark.read.parquet(f"{tmp_path}/run-{most}/{name}") for name in ("costly", "members", "met")}
        taken[most] = {name: df.count() for name, df in read.items()}
        # A class is in one gathering at most.
        assert read["members"].select("cls").distinct().count() == taken[most]["members"] <= taken[most]["met"]
    assert taken[0]["costly"] > 0 == taken[10**6]["costly"]


def test_copies_and_shared_passages(spark):
    draw = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(k, "exact copy of one text " * 4) for k in range(60)]
    rows += [(100 + k, passage + " " + " ".join(f"q{draw.randrange(10**6)}" for _ in range(30))) for k in range(60)]
    same(near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), rows)


def test_components_joined_by_exact_intersections():
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**63, 400, dtype=np.uint64)
    sets = [np.unique(np.concatenate([draw.permutation(base)[:300 + 8 * (k % 7)], draw.integers(0, 2**63, 5 * (k % 5), dtype=np.uint64)]))
            for k in range(40)] + [np.array([7], np.uint64)]
    component = [bytes([k % 9]) for k in range(40)] + [b"z"]
    for percent in (50, 60, 70, 85):
        root = {c: c for c in component}

        def find(c, root=root):
            while root[c] != c:
                c = root[c]
            return c

        for i, a in enumerate(sets):
            for j in range(i):
                shared = len(np.intersect1d(a, sets[j]))
                if 100 * shared >= percent * (len(a) + len(sets[j]) - shared):
                    root[find(component[i])] = find(component[j])
        wanted = {frozenset(c for c in root if find(c) == r) for r in map(find, root)}
        for columns in (2048, 37):
            minhash_dedup._COLUMNS_AT_ONCE = columns
            forest = joined_components(component, sets, percent)
            minhash_dedup._COLUMNS_AT_ONCE = 2048
            part = {c: c for c in component}
            for u, v in forest:
                low, high = part[u], part[v]
                assert low != high  # a forest: no pair twice
                part = {c: low if p == high else p for c, p in part.items()}
            assert {frozenset(c for c in part if part[c] == r) for r in part.values()} == wanted


def test_a_large_family_emits_few_pairs(spark, tmp_path):
    """1,200 texts of one template, 14 of 300 words replaced: what the hubs leave apart leaves its tasks as a forest."""
    draw = random.Random(9)
    base = [f"t{draw.randrange(10**6)}" for _ in range(300)]
    rows = []
    for k in range(1200):
        own = list(base)
        for spot in draw.sample(range(300), 14):
            own[spot] = f"r{draw.randrange(10**9)}"
        rows.append((k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = near_duplicates(docs, folder=str(tmp_path / "run"))
    same(found, rows)


def test_scratch_of_finished_steps_is_removed(spark, documents, tmp_path):
    near_duplicates(documents, folder=str(tmp_path / "run")).count()
    left = {p.name.partition("-")[0] for p in (tmp_path / "run").iterdir()}
    assert {"labelled", "sketches"} <= left <= {"labelled", "sketches", "components", "bridged"}
