import numpy as np

from hydromart.llm import embeddings as M


def brute(rows, cosine=0.93):
    ok = [v is not None and i is not None and label is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v)
          and any(v) for i, v, label in rows]
    unit = [np.array(v, float) / np.linalg.norm(v) if good else None for (_, v, _), good in zip(rows, ok)]
    n, links, root = len(rows), [0] * len(rows), list(range(len(rows)))
    pairs = [(a, b) for a in range(n) for b in range(n) if a != b and ok[a] and ok[b] and rows[a][2] == rows[b][2]
             and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine]
    for a, _ in pairs:
        links[a] += 1
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    group = {}
    for r, (i, _, _) in zip(root, rows):
        group.setdefault(r, []).append(i)
    return sorted(((i, k, min(x for x in group[r] if x is not None) if i is not None else None)
                   for (i, _, _), k, r in zip(rows, links, root)), key=repr)


def cases(n=120, dim=16, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim)).astype(np.float32)
    rows = [(i, base[i].tolist(), i % 3) for i in range(n)]
    rows += [(1000 + i, (base[i % 20] + rng.normal(0, 0.15, dim)).astype(np.float32).tolist(), (i % 20) % 3) for i in range(60)]
    rows += [(2000 + i, base[0].tolist(), 0) for i in range(25)]  # copies of one vector
    rows += [(3000, (3 * base[1]).tolist(), 1), (3001, base[1].tolist(), None), (3002, None, 1), (3003, [0.0] * dim, 1),
             (3004, [float("nan")] * dim, 1), (3005, [None] + base[1][1:].tolist(), 1), (3006, [float("inf")] * dim, 1),
             (3007, [], 1), (3008, base[1][:8].tolist(), 1), (3009, base[1].tolist(), 2), (3010, base[2].tolist(), 2),
             (3010, base[2].tolist(), 2), (None, base[1].tolist(), 1)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


def run(df, **kw):
    return sorted((tuple(r) for r in M.near_vectors(df, **kw).collect()), key=repr)


def test_one_leaf_is_exact(spark):
    rows = cases()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "2 AS low", "3 AS code", "4 AS d1").repartition(3)
    assert run(df) == brute(rows)


def test_forest_recall(spark):
    rows = cases(600)
    want = brute(rows)
    got = run(spark.createDataFrame(rows, SCHEMA), leaf=40)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))  # no false link, none counted twice
    assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want)
    assert sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.97 * len(want)


def test_dense_cluster_recall(spark):
    rng = np.random.default_rng(1)
    centre = rng.standard_normal(32)
    rows = [(i, (centre + rng.normal(0, 0.05, 32)).tolist(), 0) for i in range(200)]
    rows += [(1000 + i, rng.standard_normal(32).tolist(), 0) for i in range(200)]
    got, want = run(spark.createDataFrame(rows, SCHEMA), leaf=150), brute(rows)
    assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want)
    assert [g[2] for g in got] == [w[2] for w in want]


def test_clusters_larger_than_a_leaf_are_exact(spark):
    rng = np.random.default_rng(5)
    dim = 64
    unit = lambda n: (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(rng.standard_normal((n, dim)))
    spread = unit(3)
    x = np.concatenate([np.repeat(spread[:1], 1200, 0) + 0.22 * unit(1200),  # pairs around the link angle
                        np.repeat(spread[1:2], 500, 0) + 0.1 * unit(500),  # all link
                        np.repeat(spread[:1] + 0.3 * unit(1), 400, 0) + 0.25 * unit(400),  # overlaps the first
                        unit(300)]).astype(np.float32)
    order = rng.permutation(len(x))
    rows = [(int(i), x[o].tolist(), 7) for i, o in enumerate(order)] + [(9000 + i, x[order[i]].tolist(), 7) for i in range(20)]
    y = np.array([r[1] for r in rows], np.float64)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    near = y @ y.T >= 0.93
    np.fill_diagonal(near, False)
    want = dict(zip([r[0] for r in rows], near.sum(axis=1).tolist()))
    for kw in ({"leaf": 64}, {"leaf": 64, "block": 300}):  # block: many pairs of blocks
        got = run(spark.createDataFrame(rows, SCHEMA), **kw)
        assert {g[0]: g[1] for g in got} == want
    label = np.arange(len(rows))
    while True:
        low = np.minimum(label, np.where(near, label[None, :], len(rows)).min(axis=1))
        if (low == label).all():
            break
        label = low
    assert {g[0]: g[2] for g in got} == {r[0]: rows[k][0] for r, k in zip(rows, label)}


def test_empty_table(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_very_large_and_very_small_vectors(spark):
    """Cosine does not depend on length, up to the ends of the double range."""
    rows = [(1, [1e200, 1e200], 0), (2, [1e200, 1.01e200], 0), (3, [1e-200, 0.0], 0), (4, [2e-200, 0.0], 0), (5, [1.0, 0.0], 0),
            (6, [5e-324, 0.0], 0), (7, [1.7e308, -1.7e308], 0), (8, [1e-300, -1e-300], 0)]
    got = run(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert got == [(1, 1, 1), (2, 1, 1), (3, 3, 3), (4, 3, 3), (5, 3, 3), (6, 3, 3), (7, 1, 7), (8, 1, 7)]


def test_lengths_beyond_the_forests_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "FORESTS", 1)
    long = cases(90, dim=16)
    short = [(i + 5000 if i is not None else None, None if v is None else v[:6], k) for i, v, k in cases(90, dim=6, seed=9)]
    rows = [r for r in long + short if r[1] is None or len(r[1]) in (6, 16)]
    got = run(spark.createDataFrame(rows, SCHEMA), leaf=20, block=16)
    want = brute(rows)
    few = {i for i, v, _ in rows if v is not None and len(v) == 16}
    assert [g for g in got if g[0] not in few] == [w for w in want if w[0] not in few]
