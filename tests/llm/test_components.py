import random

from hydromart.llm.common import Scratch
from hydromart.llm.components import components


def brute(edges):
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_components(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, 1001 + i) for i in range(80)]
    mixed = [(rng.randrange(2000, 2060), rng.randrange(2000, 2060)) for _ in range(40)]
    edges = chain + star + mixed + [(5, 5), (-3, 2)] + chain[:5]
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test"))
    want = {k: v for k, v in brute([e for e in edges if e[0] != e[1]]).items()}
    assert {r.node: r.component for r in got.collect()} == want


def test_no_edges(spark):
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long"), Scratch(spark, "test")).count() == 0
