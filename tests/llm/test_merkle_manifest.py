from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from wellops.llm.merkle_manifest import Segment, height_of, manifest, op12_merkle_manifest, place


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k:k + 16]) for k in range(0, len(out[-1]), 16)])
    return out


def siblings(tree, index):
    """Per level below the root: the digests before and after the node's own."""
    out = []
    for nodes in tree[:-1]:
        first = index // 16 * 16
        out.append((nodes[first:index], nodes[index + 1:first + 16]))
        index //= 16
    return out


def brute(rows):
    """The manifest of (doc_id, source, lang, n_chars, text) rows, straight from the definition."""
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r, leaf(r)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        by_source[source].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[source] = levels([own for _, own in by_source[source]])
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for k, source in enumerate(order):
        for i, (row, own) in enumerate(by_source[source]):
            path = siblings(trees[source], i) + siblings(top, k)
            doc_id, text = row[0], row[4]
            digest = own
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and text is not None:
                lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                digest = leaf((*row[:4], lower))
            for before, after in path:
                digest = h(*before, digest, *after)
            proof = h(*[d for before, after in path for d in before + after])
            out.append((doc_id, own, trees[source][-1][0], top[-1][0], proof, digest, digest == top[-1][0]))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, digest int, n int, run int"


def test_query_against_the_definition(spark, sf_dir, documents):
    got = op12_merkle_manifest(spark, sf_dir)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = result(got)
    assert rows == brute([tuple(r) for r in documents.select(*COLUMNS).collect()])
    assert {r[-1] for r in rows} == {True, False}


def test_odd_documents(spark, odd_documents):
    assert result(manifest(odd_documents)) == brute([tuple(r) for r in odd_documents.select(*COLUMNS).collect()])
    assert manifest(odd_documents.limit(0)).count() == 0
    one = odd_documents.filter("doc_id = 4")
    assert result(manifest(one)) == brute([tuple(r) for r in one.select(*COLUMNS).collect()])


def made(spark, sizes, seed=3):
    rng, rows = random.Random(seed), []
    for source, n in sizes.items():
        for k in range(n):
            rows.append((rng.choice([None, 7, k, k, k, k]), source, "en", k, f"Text {k % 5}" if k % 7 else None, "x", 1, 2, 3))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_trees_of_every_shape(spark):
    sizes = {None: 17, "": 1, "a": 16, "B": 257, "b": 256, "é": 33, "𝄞": 2, "＠": 5, **{f"s{k}": 1 + k % 3 for k in range(30)}}
    rows = made(spark, sizes)
    assert result(manifest(rows)) == brute([tuple(r) for r in rows.select(*COLUMNS).collect()])


@pytest.mark.parametrize("levels_at_once", [1, 2])
def test_several_rounds(spark, levels_at_once):
    """Builders of fewer levels give the same tree in more rounds; the hot source takes most rows."""
    rows = made(spark, {"hot": 4_200, None: 40, "x": 300, **{f"s{k}": 2 for k in range(20)}})
    wanted = brute([tuple(r) for r in rows.select(*COLUMNS).collect()])
    assert result(manifest(rows, levels=levels_at_once)) == wanted
    assert result(manifest(rows)) == wanted


def test_places_follow_from_sizes():
    for n in (1, 2, 15, 16, 17, 255, 256, 257, 300):
        levels_above = height_of(n)
        leaves = [hashlib.sha256(bytes([k % 256, k // 256])).digest() for k in range(n)]
        segment = Segment.built(leaves, levels_above)
        tree = levels([d.hex() for d in leaves])
        assert len(segment.nodes) // 32 == sum(map(len, tree))
        for height, nodes in enumerate(tree):
            assert [segment.node(height, k).hex() for k in range(len(nodes))] == nodes
        places = sorted(place(height, k, n, levels_above) for height, nodes in enumerate(tree) for k in range(len(nodes)))
        assert places == list(range(len(places)))
