"""Embedding near-dedup by a forest of random-projection trees with spill overlap.

Equal vectors of one label collapse into a class first, so a vector held by a third of all rows
forms no pairs. Trees are fitted on a bounded sample of classes: every node projects on a random
direction and splits at the median; vectors near the median (``SPILL`` of the sample on either
side) go both ways. Every class is routed through every tree, as deep as its label needs to get
leaves of about ``LEAF`` vectors; a label that fits one leaf uses no splits. Inside a leaf all
vectors are compared exactly in double precision. A pair that shares several leaves is counted in
the first of them only, so counts add up without a table of pairs, and each leaf returns a
spanning forest of its links.

Median splits cut through a group of near vectors that is larger than a leaf, so such groups never
meet the trees. Where the sample of a label is dense, centres are set; a vector that links with its
nearest centre is core there and leaves the forest. A vector that links with a core one is at most
two link angles from that core's centre, so each group also gets its visitors from that range, and
all its pairs are compared exactly, in pairs of blocks of ``BLOCK`` vectors that are tasks of their own.
Vectors within half the link angle of a centre all link with each other and are counted by their
sum. A pair of two cores counts at the lower centre.

The result is exact for labels of up to ``LEAF`` distinct vectors and for all pairs with a core
vector; for the others the recall of links is that of the forest (measured in the tests and the
README), and no false link is ever reported.

Defined results: a row whose id, label or vector is null, or whose vector is empty, zero or holds
null or non-finite components, links with nothing and is its own component; vectors of different
length do not link; repeated rows are separate vectors that link with each other; different
vectors under one ``vec_id`` end in one component; an empty table gives no rows; columns other
than ``vec_id``, ``embedding`` and ``label`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydromart.llm.common import Scratch, partitions
from hydromart.llm.components import components, fold_links

COSINE = 0.93
TREES = 6
SPILL = 0.15
LEAF = 1024
SAMPLE = 32768  # classes that the trees are fitted on, at most
SAMPLE_LEAF = 32  # sampled classes in a leaf, at least
SEED = 20240
DENSE_SAMPLE = 8192  # classes of one label that centres are looked for in, at most
DENSE_LEAST = 4  # sampled neighbours of a dense vector, at least
FORESTS = 64  # vector lengths that get trees; labels of further lengths are compared in pairs of blocks
BLOCK = 8192  # vectors of a dense group that are compared with one other block in one task


def unit_rows(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components would leave the range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Forest:
    """Directions and thresholds of all inner nodes, as heaps: children of node i are 2 i + 1, 2 i + 2."""

    def __init__(self, sample: np.ndarray, depth: int, trees: int = TREES, spill: float = SPILL):
        nodes = (1 << depth) - 1
        self.depth, self.trees = depth, trees
        rng = np.random.default_rng(SEED)
        self.direction = rng.standard_normal((trees, nodes, sample.shape[1] if len(sample) else 0))
        self.low, self.high = np.zeros((trees, nodes)), np.zeros((trees, nodes))
        for tree in range(trees):
            inside = {0: np.arange(len(sample))}
            for node in range(nodes):
                rows = inside.pop(node)
                at = sample[rows] @ self.direction[tree, node]
                if len(at):
                    self.low[tree, node], self.high[tree, node] = np.quantile(at, [0.5 - spill, 0.5 + spill])
                left, right = self._sides(tree, node, at)
                inside[2 * node + 1], inside[2 * node + 2] = rows[left], rows[right]

    def _sides(self, tree: int, node: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.low[tree, node], self.high[tree, node]
        return at <= high, (at >= low if low < high else at > low)

    def leaves(self, x: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, code): the leaves of every row; rows with ``levels`` 0 are in one leaf of one tree."""
        size = (1 << (self.depth + 1)) - 1
        flat = np.flatnonzero(levels == 0)
        rows, codes = [flat], [np.zeros(len(flat), np.int64)]
        for tree in range(self.trees):
            front = [(0, 0, np.flatnonzero(levels > 0))]
            while front:
                node, level, inside = front.pop()
                if not len(inside):
                    continue
                done = levels[inside] == level
                rows.append(inside[done])
                codes.append(np.full(int(done.sum()), 1 + tree * size + node))
                inside = inside[~done]
                if len(inside):
                    left, right = self._sides(tree, node, x[inside] @ self.direction[tree, node])
                    front += [(2 * node + 1, level + 1, inside[left]), (2 * node + 2, level + 1, inside[right])]
        return np.concatenate(rows), np.concatenate(codes)


def leaf_links(x: np.ndarray, weight: np.ndarray, codes: np.ndarray, code: int, cosine: float = COSINE,
               block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) per vector of a leaf: weights of the linked vectors that no earlier leaf counts, forest label.

    ``codes`` holds each vector's leaves, padded with -1.
    """
    n = len(x)
    links, label = np.zeros(n, np.int64), np.arange(n)
    earlier = np.where((codes >= 0) & (codes < code), codes, -1)
    earlier = earlier[:, (earlier >= 0).any(axis=0)] if n else earlier
    for at in range(0, n, block):
        i, j = np.nonzero(x[at:at + block] @ x[at:].T >= cosine)
        i, j = i + at, j + at
        keep = i < j
        i, j = i[keep], j[keep]
        label = fold_links(label, i, j)
        for part in range(0, len(i), 50_000):
            a, b = i[part:part + 50_000], j[part:part + 50_000]
            if earlier.shape[1]:
                one = earlier[a]
                seen = ((one[:, :, None] == earlier[b][:, None, :]) & (one[:, :, None] >= 0)).any(axis=(1, 2))
                a, b = a[~seen], b[~seen]
            np.add.at(links, a, weight[b])
            np.add.at(links, b, weight[a])
    return links, label


def dense_centres(x: np.ndarray, size: int, leaf: int = LEAF, cosine: float = COSINE) -> np.ndarray:
    """Centres of the groups in a label of ``size`` vectors that may outgrow a leaf, from its sample ``x``."""
    x = x[:DENSE_SAMPLE]
    near = np.concatenate([(x[at:at + 512] @ x.T >= cosine).sum(axis=1) - 1 for at in range(0, len(x), 512)])
    near = np.where(near >= max(DENSE_LEAST, leaf / 2 * len(x) / size), near, -1)
    centres = []
    while len(x) and near.max() >= 0:
        best = int(near.argmax())
        centre = x[best]
        for _ in range(3):  # towards the middle of the group
            inside = x @ centre >= cosine
            if not inside.any():
                break
            mean = x[inside].mean(axis=0)
            centre = mean / np.linalg.norm(mean)
        covered = x @ centre >= cosine
        if not covered[best]:
            centre = x[best]
            covered = x @ centre >= cosine
            covered[best] = True
        near[covered] = -1
        centres.append(centre)
    return np.array(centres).reshape(-1, x.shape[1])


def homes(x: np.ndarray, centres: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(cosines with all centres, the nearest centre that links or -1) per vector."""
    at = x @ centres.T
    best = at.argmax(axis=1)
    return at, np.where(at[np.arange(len(x)), best] >= cosine, best, -1)


def groups_of(x: np.ndarray, centres: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, centre, core, inner): the dense groups of every vector, as core or as visitor."""
    at, home = homes(x, centres, cosine)
    reach = 2 * cosine * cosine - 1 if cosine > 0 else -1.0  # two link angles
    number = np.arange(len(centres))
    core = home[:, None] == number
    visits = (at >= reach - 1e-6) & ((home[:, None] < 0) | (home[:, None] > number))
    row, centre = np.nonzero(core | visits)
    inner = core & (at >= np.sqrt((1 + cosine) / 2) + 1e-9)  # half the link angle
    return row, centre, core[row, centre], inner[row, centre]


def _fold_mask(label: np.ndarray, i: np.ndarray, j: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Merge the links ``mask`` between rows i and j; one link for each row and column a round."""
    while True:
        open_ = mask & (label[i][:, None] != label[j][None, :])
        rows, cols = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
        if not len(rows):
            return label
        label = fold_links(label, np.concatenate([i[rows], i[open_[:, cols].argmax(axis=0)]]),
                           np.concatenate([j[open_[rows].argmax(axis=1)], j[cols]]))


def block_links(x: np.ndarray, weight: np.ndarray, core: np.ndarray, inner: np.ndarray, one: np.ndarray, other: np.ndarray,
                cosine: float = COSINE, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(links, root) per vector, from the pairs between rows ``one`` and ``other`` (the same rows, or none in common).

    A pair needs a core vector; pairs of two inner ones are counted elsewhere.
    """
    links, label, same = np.zeros(len(x)), np.arange(len(x)), np.array_equal(one, other)
    for at in range(0, len(one), step):
        i, j = one[at:at + step], other[at:] if same else other
        mask = x[i] @ x[j].T >= cosine
        mask &= (core[i][:, None] | core[j][None, :]) & ~(inner[i][:, None] & inner[j][None, :])
        if same:
            mask &= np.arange(len(j))[None, :] > np.arange(len(i))[:, None]
        links[i] += mask.astype(np.float64) @ weight[j]
        links[j] += weight[i] @ mask.astype(np.float64)
        label = _fold_mask(label, i, j, mask)
    return links.astype(np.int64), label


def _valid():
    good = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & F.coalesce(good & F.exists("embedding", lambda v: v != 0), F.lit(False)))


def near_vectors(vectors: DataFrame, cosine: float = COSINE, leaf: int = LEAF, trees: int = TREES,
                 sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embeddings")
    key = [F.col("label"), F.size("embedding").alias("dim"), F.xxhash64("embedding").alias("d1"),
           F.xxhash64(F.lit("second"), "embedding").alias("d2")]
    rows = vectors.select("vec_id", "embedding", "label").where(_valid()).select("vec_id", "embedding", *key)
    classes = (rows.groupBy("label", "dim", "d1", "d2")
               .agg(F.min("vec_id").alias("low"), F.count("*").alias("n"), F.first("embedding").alias("embedding")))
    classes = scratch.write(classes, "classes")
    sizes = scratch.write(classes.groupBy("label", "dim").agg(F.count("*").alias("size")), "sizes")
    deepest = int(np.log2(max(1, sample // SAMPLE_LEAF)))
    level = F.least(F.lit(deepest), F.greatest(F.lit(0), F.ceil(F.log2(F.col("size") / leaf)).cast("int")))
    sizes = sizes.withColumn("levels", level).withColumn("lab", F.xxhash64("label"))  # equal hashes only share centres
    need = (sizes.groupBy("dim").agg(F.max("levels").alias("depth")).where("depth > 0")
            .orderBy("dim").limit(FORESTS + 1).collect())  # vector lengths that need trees
    depth = {r.dim: r.depth for r in need[:FORESTS]}
    grown = (F.col("levels") == 0) | F.col("dim").isin(list(depth))  # true for all labels but those of further lengths
    forests, centres = {}, {}
    for dim, d in depth.items():
        chosen = (classes.where(F.col("dim") == dim).join(sizes, ["label", "dim"]).orderBy(F.xxhash64("low"), "low").limit(sample)
                  .select("lab", "size", "levels", "embedding"))
        held = [(r.lab, r.size if r.levels else 0, unit_rows([r.embedding])[0].astype(np.float32)) for r in chosen.toLocalIterator()]
        x, labs, size = unit_rows([h[2] for h in held]), np.array([h[0] for h in held]), np.array([h[1] for h in held])
        rest = np.ones(len(x), bool)
        for lab in np.unique(labs[size > 0]):
            own = np.flatnonzero((labs == lab) & (size > 0))
            if len(own) > DENSE_LEAST and len(found := dense_centres(x[own], int(size[own].max()), leaf, cosine)):
                centres[int(lab), dim] = found
                rest[own] = homes(x[own], found, cosine)[1] < 0
        forests[dim] = Forest(x[rest] if rest.any() else x, d, trees)
    # at most 64 forests of sample / SAMPLE_LEAF nodes a tree, with fewer centres than sampled vectors
    sent = spark.sparkContext.broadcast((forests, centres))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                dims, levels, labs = (part.column(c).to_numpy() for c in (1, 5, 6))
                for dim in np.unique(dims):
                    inside = np.flatnonzero(dims == dim)
                    own = part.take(pa.array(inside))
                    forest = sent.value[0].get(int(dim))
                    if forest is None:
                        row, code = np.arange(len(inside)), np.zeros(len(inside), np.int64)
                    else:
                        x = unit_rows(own.column(4).to_pylist())
                        rest = np.ones(len(x), bool)  # cores of dense groups leave the forest
                        for lab in np.unique(labs[inside]):
                            if (found := sent.value[1].get((int(lab), int(dim)))) is not None:
                                at_lab = np.flatnonzero(labs[inside] == lab)
                                rest[at_lab] = homes(x[at_lab], found, cosine)[1] < 0
                        inside, own, x = inside[rest], own.filter(pa.array(rest)), x[rest]
                        row, code = forest.leaves(x, levels[inside])
                    order = np.argsort(row, kind="stable")
                    row, code = row[order], code[order]
                    cuts = np.searchsorted(row, np.arange(len(inside) + 1))
                    lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(code))
                    for low in range(0, len(row), 4096):  # a row is repeated for each of its leaves
                        take = pa.array(row[low:low + 4096])
                        yield pa.RecordBatch.from_arrays(
                            [*[own.column(c).take(take) for c in range(5)], pa.array(code[low:low + 4096]), lists.take(take)],
                            names=["label", "dim", "low", "n", "embedding", "code", "codes"])

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    routed = (classes.join(sizes.where(grown), ["label", "dim"])
              .select("label", "dim", "low", "n", "embedding", "levels", "lab")
              .mapInArrow(route, f"label {kinds['label']}, dim int, low {kinds['low']}, n long, "
                                 f"embedding {kinds['embedding']}, code long, codes array<long>"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = pdf["codes"].tolist()
        codes = np.full((len(pdf), max(map(len, lists))), -1, np.int64)
        for i, own in enumerate(lists):
            codes[i, :len(own)] = own
        low = pdf["low"].to_numpy()
        links, root = leaf_links(unit_rows(pdf["embedding"].tolist()), pdf["n"].to_numpy(), codes,
                                 int(pdf["code"].iat[0]), cosine)
        out = pd.DataFrame({"a": low, "b": low[root], "links": links})
        return out[(out.a != out.b) | (out.links > 0)]

    found = scratch.write(routed.repartition(4 * partitions(spark), "label", "dim", "code").groupBy("label", "dim", "code")
                          .applyInPandas(compare, f"a {kinds['low']}, b {kinds['low']}, links long"), "found")
    if centres:
        found = found.unionByName(_dense_links(classes, sizes, sent, scratch, cosine, block))
    if len(need) > FORESTS:
        plain = (classes.join(sizes.where(~grown), ["label", "dim"])
                 .select("label", "dim", "low", "n", "embedding", F.lit(-1).cast("long").alias("centre"),
                         F.lit(True).alias("core"), F.lit(False).alias("inside")))
        found = found.unionByName(scratch.write(_block_pairs(plain, cosine, block), "plain_links"))
    counts = found.groupBy(F.col("a").alias("low")).agg(F.sum("links").alias("links"))
    roots = components(found.select("a", "b"), scratch).select(F.col("node").alias("low"), "component")
    settled = (classes.select("label", "dim", "d1", "d2", "low", "n").join(counts, "low", "left").join(roots, "low", "left")
               .select("label", "dim", "d1", "d2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                       F.coalesce("component", "low").alias("component_id")))
    every = vectors.select("vec_id", "embedding", "label").withColumn("ok", _valid())
    keyed = every.select("vec_id", *[F.when(F.col("ok"), k).alias(n) for k, n in zip(key, ("label", "dim", "d1", "d2"))])
    return (keyed.join(settled, ["label", "dim", "d1", "d2"], "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id")))


def _dense_links(classes: DataFrame, sizes: DataFrame, sent, scratch: Scratch, cosine: float, block: int) -> DataFrame:
    """(a, b, links) of all pairs with a core vector of a dense group."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                dims, labs = part.column(1).to_numpy(), part.column(5).to_numpy()
                for lab, dim in set(zip(labs.tolist(), dims.tolist())):
                    centres = sent.value[1].get((lab, dim))
                    if centres is None:
                        continue
                    own = part.take(pa.array(np.flatnonzero((labs == lab) & (dims == dim))))
                    row, centre, core, inner = groups_of(unit_rows(own.column(4).to_pylist()), centres, cosine)
                    for low in range(0, len(row), 4096):
                        cut = slice(low, low + 4096)
                        take = pa.array(row[cut])
                        yield pa.RecordBatch.from_arrays(
                            [*[own.column(c).take(take) for c in range(5)], pa.array(centre[cut]), pa.array(core[cut]), pa.array(inner[cut])],
                            names=["label", "dim", "low", "n", "embedding", "centre", "core", "inside"])

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    group = ["label", "dim", "centre"]
    dense = (classes.join(sizes.where("levels > 0"), ["label", "dim"]).select("label", "dim", "low", "n", "embedding", "lab")
             .mapInArrow(place, f"label {kinds['label']}, dim int, low {kinds['low']}, n long, embedding {kinds['embedding']}, "
                                "centre long, core boolean, inside boolean"))
    dense = scratch.write(dense, "dense")
    inside = dense.where("inside")
    sums = inside.groupBy(*group).agg(F.min("low").alias("lead"), F.sum("n").alias("sum"))
    alike = (inside.select(*group, "low", "n").join(sums, group)
             .select(F.col("low").alias("a"), F.col("lead").alias("b"), (F.col("sum") - F.col("n")).alias("links")))
    return scratch.write(_block_pairs(dense, cosine, block).unionByName(alike), "dense_links")


def _block_pairs(dense: DataFrame, cosine: float, block: int) -> DataFrame:
    """(a, b, links) of the pairs with a core vector inside every (label, dim, centre), dealt in pairs of blocks."""
    group = ["label", "dim", "centre"]
    low_kind = dense.schema["low"].dataType.simpleString()
    blocks = dense.groupBy(*group).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("low", "embedding"), F.col("blocks")).cast("int")
    dealt = (dense.join(blocks, group).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*group, "low", "n", "embedding", "core", "inside", "own", F.least("own", "other").alias("p"),
                     F.greatest("own", "other").alias("q")))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        first = (pdf["own"] == pdf["p"]).to_numpy()
        one = np.flatnonzero(first)
        other = one if pdf["p"].iat[0] == pdf["q"].iat[0] else np.flatnonzero(~first)
        low = pdf["low"].to_numpy()
        links, root = block_links(unit_rows(pdf["embedding"].tolist()), pdf["n"].to_numpy(np.float64), pdf["core"].to_numpy(bool),
                                  pdf["inside"].to_numpy(bool), one, other, cosine)
        out = pd.DataFrame({"a": low, "b": low[root], "links": links})
        return out[(out.a != out.b) | (out.links > 0)]

    keys = [*group, "p", "q"]
    return (dealt.repartition(4 * partitions(dense.sparkSession), *keys).groupBy(*keys)
            .applyInPandas(compare, f"a {low_kind}, b {low_kind}, links long"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return near.withColumn("kept", F.col("vec_id") == F.col("component_id"))


OP3_SQL = """
WITH RECURSIVE valid AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
      AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b
      ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (
    SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), degree AS (SELECT a, count(*) AS n FROM links GROUP BY a
), lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, least(e.vec_id, coalesce(l.low, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(l.low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN degree d ON d.a = e.vec_id LEFT JOIN lowest l ON l.a = e.vec_id
"""
