"""Connected components of an edge table by alternating star contractions.

Every round is two aggregations with map-side minima and two joins on the node; the edge table is
written after each round. No neighbour list is ever gathered, so a node linked with a third of
all others is only a skewed join side (split by AQE) and one running minimum.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydromart.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    return (both.join(low, both.a == low.u).where("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    low = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = (down.join(low, down.a == low.u).where("b <> m")
             .select(F.col("b").alias("a"), F.col("m").alias("b")))
    return moved.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``: component is the smallest reachable node.

    Loops and repeated edges are allowed; null ends are ignored; no edges give no rows.
    """
    # few edges come from many tasks: rebalanced, they are a few files instead of one for each task
    current = scratch.write(edges.select("a", "b").where("a <> b").hint("rebalance"), f"{name}_0")
    last, turn = None, 0
    while True:
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state[0] == 0 or state == last:
            break
        last, turn = state, turn + 1
        current = scratch.write(_small_star(_large_star(current)), f"{name}_{turn}")
        scratch.drop(f"{name}_{turn - 1}")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def fold_links(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Merge links (i, j) into the running minimum labels of one task's rows."""
    while len(i):
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            break
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
    return label
