from __future__ import annotations

import itertools
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wellops.llm.mixing import encoded, mixed, op4_source_mixing, ordered, plan, route, sized, targets, with_uses


def test_targets_stop_at_three_times_the_size():
    assert targets({"=a": 10, "=b": 10, "=c": 10}, {"=a": 1, "=b": 1, "=c": 2}, 30) == {"=a": 7.5, "=b": 7.5, "=c": 15.0}
    got = targets({"=a": 1, "=b": 100, "=c": 99}, {"=a": 5, "=b": 2, "=c": 1}, 200)
    assert got["=a"] == 3.0 and got["=b"] == pytest.approx(197 * 2 / 3) and sum(got.values()) == pytest.approx(200)
    assert targets({"=a": 0, "": 5}, {"=a": 5, "": 2}, 5) == {"=a": 0.0, "": 5.0}
    assert targets({}, {}, 0) == {}
    assert ordered({"", "=b", "=a", "=", "=B"}) == ["=", "=B", "=a", "=b", ""]


def cheapest(words, quotas, uses=3):
    """Most words routed and the least cost of it, by trying all whole flows."""
    links = [(p, s) for p in sorted(words) for s in p]
    best = (0, 0)
    for flow in itertools.product(*[range(uses * words[p] + 1) for p, _ in links]):
        into, out = Counter(), Counter()
        for (p, s), n in zip(links, flow):
            into[s] += n
            out[p] += n
        if any(into[s] > quotas[s] for s in into) or any(out[p] > uses * words[p] for p in out):
            continue
        cost = sum(max(0, min(n - k * words[p], words[p])) * k for p, n in out.items() for k in range(1, uses))
        best = max(best, (sum(flow), -cost))
    return best


@pytest.mark.parametrize("words,quotas", [
    ({("=a",): 2, ("=a", "=b"): 1, ("=b",): 1}, {"=a": 3, "=b": 4}),
    ({("=a", "=b"): 2, ("=b", "=c"): 1}, {"=a": 2, "=b": 3, "=c": 2}),
    ({("=a",): 1, ("=a", "=b"): 2}, {"=a": 1, "=b": 6}),
])
def test_flow_is_largest_and_cheapest(words, quotas):
    flows = route(words, {k: float(v) for k, v in quotas.items()})
    out = {p: sum(f.values()) for p, f in flows.items()}
    cost = sum(max(0, min(n - k * words[p], words[p])) * k for p, n in out.items() for k in range(1, 3))
    assert (sum(out.values()), -cost) == cheapest(words, quotas)
    for s in quotas:
        assert sum(f.get(s, 0) for f in flows.values()) <= quotas[s]


def test_query(spark, sf_dir, documents):
    rows = op4_source_mixing(spark, sf_dir).collect()
    again = op4_source_mixing(spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again)) and len(rows) == documents.count()
    docs = {r["doc_id"]: (r["text"], r["source"]) for r in documents.collect()}
    size = {k: len((t or "").encode().split()) for k, (t, _) in docs.items()}
    by_source = Counter()
    for k, (_, s) in docs.items():
        by_source[s] += size[k]
    names = sorted((s for s in by_source if s is not None)) + [s for s in by_source if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    wanted = targets({s: n for s, n in by_source.items()}, weight, sum(by_source.values()))
    taken = Counter()
    for r in rows:
        source = docs[r["doc_id"]][1]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by_source[source]
        assert r["target"] == pytest.approx(wanted[source], rel=1e-12)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[source] += r["taken"]
    for source, n in taken.items():
        # Whole documents only: no document is left that would come nearer, so half of the largest is the most.
        largest = max(size[k] for k, (_, s) in docs.items() if s == source)
        assert abs(n - wanted[source]) <= 0.5 + largest / 2


def test_overlapping_sources(spark):
    rows = [(k, f"word{k} " * (20 + k % 7), ["x"] if k % 3 == 0 else ["x", "y"] if k % 3 == 1 else ["y", None, "y"])
            for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    sizes = sized(docs, F.transform("sources", encoded)).select("doc_id", "_pattern", "_size", "_hash").cache()
    mix = plan(sizes, {"=x": 8.0, "=y": 1.0, "": 1.0})
    assert set(mix.flows) == {("=x",), ("=x", "=y"), ("", "=y")}
    total, got = sum(20 + k % 7 for k in range(300)), Counter()
    for flow in mix.flows.values():
        for s, n in flow.items():
            got[s] += n
    assert all(abs(got[s] - min(t, got[s])) <= 1 for s, (_, t) in mix.sources.items())
    used = with_uses(sizes, mix).groupBy("_pattern").agg(F.sum(F.col("uses") * F.col("_size")).alias("n")).collect()
    for r in used:
        flow = sum(mix.flows[tuple(r["_pattern"].split("\x00"))].values())
        assert abs(r["n"] - flow) <= 0.02 * total
    with pytest.raises(ValueError, match="patterns"):
        plan(sizes, max_patterns=2)


def test_odd_documents(spark, odd_documents):
    out = mixed(odd_documents)
    assert out.schema == odd_documents.schema
    uses = Counter(r["doc_id"] for r in out.collect())
    assert max(n for k, n in uses.items() if k != 7) <= 3 and uses[7] <= 9
    assert mixed(odd_documents.limit(0)).count() == 0


def _used(sizes, mix):
    return sorted(map(tuple, with_uses(sizes, mix).select("doc_id", "_pattern", "_size", "uses").collect()))


def test_many_patterns_by_tables_give_the_same_mix(spark):
    """More sources than the driver takes, one with a third of all documents, one nameless, one without words."""
    rows = [(k, "word " * (5 + k * 7 % 31) if k % 40 != 39 else "", None if k % 40 == 1 else "empty" if k % 40 == 39 else
             "hot" if k % 3 == 0 else f"s{k % 40}") for k in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = sized(docs, F.array(encoded(F.col("source")))).select("doc_id", "_pattern", "_size", "_hash")
    few, many = plan(sizes), plan(sizes, max_patterns=3)
    assert not many.sources and len(few.sources) > 20
    assert {r["source"]: (r["source_size"], pytest.approx(r["target"], rel=1e-12)) for r in many.quotas.collect()} == few.sources
    assert _used(sizes, many) == _used(sizes, few)
    weights = {s: 1.0 + k % 4 for k, s in enumerate(sorted(few.sources))}
    assert _used(sizes, plan(sizes, weights, 9_000, max_patterns=3)) == _used(sizes, plan(sizes, weights, 9_000))


def test_overlapping_patterns_among_many(spark):
    rows = [(k, "word " * (3 + k % 11), [f"s{k % 30}", "both"] if k % 30 < 2 else [f"s{k % 30}"]) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    sizes = sized(docs, F.transform("sources", encoded)).select("doc_id", "_pattern", "_size", "_hash")
    few, many = plan(sizes), plan(sizes, max_patterns=10)
    assert set(many.flows) == {p for p in few.flows if "=both" in p}
    assert _used(sizes, many) == _used(sizes, few)
