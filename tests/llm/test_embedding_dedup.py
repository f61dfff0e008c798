from __future__ import annotations

import numpy as np

from wellops.llm.embedding_dedup import Settings, _Side, ego_join, near_duplicates, op1_embedding_dedup


def brute(rows, limit=0.98):
    """(vec_id, links, component, kept) of rows of (vec_id, embedding, label)."""
    ok = [i is not None and v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v)
          and any(v) for i, v, label in rows]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, (_, v, label) in enumerate(rows):
        for b in range(a):
            if ok[a] and ok[b] and label == rows[b][2] and len(v) == len(rows[b][1]):
                x, y = np.array(v, float), np.array(rows[b][1], float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= limit:
                    links[a] += 1
                    links[b] += 1
                    root[find(a)] = find(b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, links[k], None if i is None else least[find(k)], i is not None and i == least[find(k)])
            for k, (i, _, _) in enumerate(rows)]


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


SCHEMA = "vec_id long, embedding array<double>, label int, copies long, component string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, "x") for r in rows], SCHEMA)


def test_query_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert ordered(op1_embedding_dedup(spark, sf_dir).collect()) == ordered(brute(rows))


def test_clusters_copies_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows, k = [], 0
    for label in (0, 1, None):
        for _ in range(6):
            centre = rng.standard_normal(12)
            for _ in range(12):
                spread = rng.choice([0.0, 0.03, 0.06, 0.1])
                rows.append((k, (centre + spread * rng.standard_normal(12)).tolist(), label))
                k += 7
    rows += [(2, rows[0][1], 0), (1, rows[0][1], 0), (1, rows[0][1], 0), (3, [x * 1e-200 for x in rows[0][1]], 0),
             (5, None, 0), (6, [], 0), (8, [0.0] * 12, 0), (9, [float("nan")] + [1.0] * 11, 0), (10, [None] + [1.0] * 11, 0),
             (11, [float("inf")] + [1.0] * 11, 0), (12, rows[0][1][:5], 0), (13, rows[0][1][:5], 0), (None, rows[0][1], 0),
             (15, [1e300] * 12, 0), (16, [1e308] * 12, 0), (17, [-0.0] * 11 + [1.0], 1), (18, [0.0] * 11 + [2.0], 1)]
    wanted = ordered(brute(rows))
    assert ordered(near_duplicates(frame(spark, rows)).collect()) == wanted
    assert ordered(near_duplicates(frame(spark, rows).repartition(5), Settings(block=8, leaf=2, directions=2)).collect()) == wanted
    assert near_duplicates(frame(spark, rows).limit(0)).count() == 0
    assert near_duplicates(frame(spark, rows[-12:-9])).count() == 3


def test_recursive_join_counts_every_link():
    rng = np.random.default_rng(4)
    unit = rng.standard_normal((200, 6))
    unit[:150] = unit[0] + 0.1 * unit[:150]
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    unit = unit[np.lexsort(np.floor(unit[:, :2].T * 5))]
    how = Settings(min_cosine=0.97, leaf=4, directions=2)

    def side(part):
        return _Side(part.tolist(), [1] * len(part), unit[part, :2].tobytes(), unit[part].tobytes())

    linked = unit @ unit.T >= 0.97
    np.fill_diagonal(linked, False)
    whole = side(np.arange(200))
    ego_join(whole, whole, True, how)
    assert whole.links.tolist() == linked.sum(axis=1).tolist()
    a, b = side(np.arange(90)), side(np.arange(90, 200))
    edges = ego_join(a, b, False, how)
    assert a.links.tolist() == linked[:90, 90:].sum(axis=1).tolist()
    assert b.links.tolist() == linked[90:, :90].sum(axis=1).tolist()
    assert edges
